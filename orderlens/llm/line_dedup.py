"""Line dedup by content-defined chunks of lines.

Each line is hashed; a rolling hash over the last ``ROLL`` line hashes ends a chunk where it is 0
modulo ``DIVISOR``. Boundaries depend only on the lines around them, so a passage that is shifted
or embedded elsewhere falls into the same chunks again. A passage of few lines may hold no two
boundaries, so there is a second, finest scale with a boundary after every line that holds a word, where a chunk is
``MIN_LINES`` such lines in a row with the blank lines between them. A chunk of either scale, of at
least ``MIN_LINES`` lines that hold a word, that occurs more than once in all documents is removed everywhere but at
its first occurrence (smallest id, then position); occurrences are equal only when all their bytes
are. Overlapping chunks extend each other, so a repeated passage goes from its first line to its last. Every removed
line has an equal one earlier, and the earliest stays.

Chunks are first counted by a digest, without their text. Only repeated ones travel with their bytes, which
form the group key, and groups reduce to their first occurrence with map-side combine, so a passage in
a third of all documents is no hot group.

Edge cases: NULL text stays NULL with no lines; an empty text is one empty line; texts of one line have
no multi-line chunk and stay; rows that repeat id and text are one document and are treated alike, which
keeps the first occurrence in each of them; NULL ids sort last; an empty table gives an empty result; other
columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm import packed
from orderlens.llm.common import handing_back

ROLL = 3
DIVISOR = 4
MIN_LINES = 2
_PIECE_BYTES = 8 << 20


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Index after the last line of each chunk."""
    hashes = packed.word_hashes(lines)
    rolled = hashes.copy()
    for back in range(1, ROLL):
        rolled[back:] += hashes[:-back] * np.uint64(2 * back + 1) if len(hashes) > back else 0
    cut = np.flatnonzero(packed.scrambled(rolled) % np.uint64(DIVISOR) == 0) + 1
    ends = cut.tolist()
    if not ends or ends[-1] != len(lines):
        ends.append(len(lines))
    return ends


def chunks(text: bytes) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk between two boundaries."""
    ends = chunk_ends(text.split(b"\n"))
    return list(zip([0, *ends[:-1]], ends))


def spans(lines: list[bytes]) -> list[tuple[int, int]]:
    """The line ranges that are compared: chunks of both scales with enough lines that hold a word."""
    full = [at for at, line in enumerate(lines) if line.strip()]
    held = np.zeros(len(lines) + 1, np.int64)
    held[np.array(full, np.int64) + 1] = 1
    held = np.cumsum(held)
    ends = chunk_ends(lines)
    found = {(low, high) for low, high in zip([0, *ends[:-1]], ends) if held[high] - held[low] >= MIN_LINES}
    step = MIN_LINES - 1
    found.update((low, high + 1) for low, high in zip(full, full[step:]))
    return sorted(found)


@handing_back
def _emit(batches) -> Iterator[pd.DataFrame]:
    """Digest and place of every range."""
    columns = ["row", "doc", "first", "past", "digest"]
    for frame in batches:
        rows = []
        for row, doc, text in zip(frame["row"], frame["doc"], frame["text"]):
            lines = text.split(b"\n")
            for low, high in spans(lines):
                digest = hashlib.blake2b(b"\n".join(lines[low:high]), digest_size=16).digest()
                rows.append((row, doc, low, high, digest))
            if len(rows) > 20_000:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        yield pd.DataFrame(rows, columns=columns)


@handing_back
def _emit_bytes(batches) -> Iterator[pd.DataFrame]:
    """Bytes of the ranges whose digests repeat."""
    columns = ["row", "doc", "first", "past", "chunk"]
    for frame in batches:
        rows, size = [], 0
        for row, doc, text, again in zip(frame["row"], frame["doc"], frame["text"], frame["again"]):
            lines = text.split(b"\n")
            for span in again:
                body = b"\n".join(lines[span["first"] : span["past"]])
                rows.append((row, doc, span["first"], span["past"], body))
                size += len(body)
                if size > _PIECE_BYTES:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns)


@handing_back
def _cut(batches) -> Iterator[pd.DataFrame]:
    columns = ["doc", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines", "kept"]
    for frame in batches:
        rows = []
        for doc, text, removed in zip(frame["doc"], frame["text"], frame["removed"]):
            if text is None:
                rows.append((doc, 0, 0, 0, 0, None))
                continue
            gone = removed if removed is not None else ()
            lines = text.split(b"\n")
            lost = {at for span in gone for at in range(span["first"], span["past"])}
            kept = [line for at, line in enumerate(lines) if at not in lost]
            body = b"\n".join(kept).decode()
            rows.append((doc, len(lines), len(spans(lines)), len(gone), len(lost), body))
        yield pd.DataFrame(rows, columns=columns)


def row_key() -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.concat_ws(
        "|", F.md5(text), F.col("text").isNull().cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    )


def removals(docs: DataFrame, stage) -> DataFrame:
    """(row, removed): the ranges of lines (first, past) that a document loses.

    All joins are merge joins by hint, so the plan is the same at every size of the input.
    """
    texts = docs.filter("text is not null").select(
        row_key().alias("row"),
        F.col("doc_id").cast("string").alias("doc"),
        F.col("text").cast("binary").alias("text"),
    )
    ranges = stage(
        texts.mapInPandas(_emit, "row string, doc string, first int, past int, digest binary"), "line-ranges"
    )
    # What is joined back is written first, so that a hot key can be split in the join.
    repeated = stage(
        ranges.groupBy("digest")
        .agg(F.min("row").alias("one"), F.max("row").alias("other"), F.min("first").alias("low"), F.max("first").alias("high"))
        .filter((F.col("one") != F.col("other")) | (F.col("low") != F.col("high")))
        .select(F.col("digest").alias("again")),
        "repeated-ranges",
    )
    spread = (
        ranges.select("row", "first", "past", "digest")
        .join(repeated.hint("merge"), F.col("digest") == F.col("again"), "left_semi")
        .groupBy(F.col("row").alias("of"))
        .agg(F.collect_set(F.struct("first", "past")).alias("again"))
    )
    once = texts.join(spread.hint("merge"), F.col("row") == F.col("of"))
    held = stage(
        once.select("row", "doc", "text", "again").mapInPandas(
            _emit_bytes, "row string, doc string, first int, past int, chunk binary"
        ),
        "range-texts",
    ).withColumn("number", F.col("doc").cast(docs.schema["doc_id"].dataType))
    place = F.struct(F.col("number").isNull().alias("unknown"), "number", "row", "first")
    firsts = stage(
        held.groupBy("chunk").agg(F.min(place).alias("kept")).select(F.col("chunk").alias("bytes"), "kept"),
        "first-ranges",
    )
    return (
        held.join(firsts.hint("merge"), F.col("chunk") == F.col("bytes"))
        .filter((F.col("row") != F.col("kept.row")) | (F.col("first") != F.col("kept.first")))
        .groupBy("row")
        .agg(F.collect_set(F.struct("first", "past")).alias("removed"))
    )


def dedup_lines(docs: DataFrame, stage) -> DataFrame:
    """doc_id, counts of lines and chunks before and of what is removed, and the remaining ``text``.

    ``stage`` writes a table once and returns its reader.
    """
    lost = stage(removals(docs, stage), "chunk-removals").withColumnRenamed("row", "of")
    keyed = docs.select(
        row_key().alias("row"),
        F.col("doc_id").cast("string").alias("doc"),
        F.col("text").cast("binary").alias("text"),
    ).join(lost.hint("merge"), F.col("row") == F.col("of"), "left")
    schema = (
        "doc string, n_lines long, n_chunks long, n_removed_chunks long, n_removed_lines long, kept string"
    )
    return keyed.select("doc", "text", "removed").mapInPandas(_cut, schema).select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "n_lines",
        "n_chunks",
        "n_removed_chunks",
        "n_removed_lines",
        F.col("kept").alias("text"),
    )
