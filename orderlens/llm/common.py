"""Word rules shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from functools import wraps

import pyarrow
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed by the result contracts: a word is a run of anything but these six characters.
# They are also exactly the characters at which Python's ``bytes.split()`` breaks.
BREAKS = " \t\n\x0b\x0c\r"
BREAK_PATTERN = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in order; an empty array for NULL."""
    pieces = F.split(F.coalesce(text, F.lit("")), BREAK_PATTERN)
    return F.array_remove(pieces, "")


def word_count(text: Column) -> Column:
    """Number of words, without keeping the words."""
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_crc32(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; that of no bytes for NULL."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def literal_longs(values: list[int]) -> Column:
    """An array constant, folded once by the optimizer however long it is."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_BATCH_ROWS = 1_000


def short_batches(spark: SparkSession) -> None:
    """From now on at most so many rows travel to Python at once: texts of 10,000 rows are held several
    times over, by the JVM (whose buffers stay) and by the worker. Smaller settings stay."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= MOST_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, MOST_BATCH_ROWS)


def hand_back() -> None:
    """Return freed memory of this process to the system, as far as its C library can."""
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def handing_back(work):
    """A task function over batches that leaves no freed memory behind in its reused Python worker."""

    @wraps(work)
    def run(batches):
        try:
            yield from work(batches)
        finally:
            hand_back()

    return run
