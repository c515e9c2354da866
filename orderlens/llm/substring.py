"""Substring dedup by super-k-mers.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash of the ``MER``-word runs
inside it, so equal windows have equal minimisers, and consecutive windows with the same minimiser
form a super-k-mer. The steps:

1. Every super-k-mer sends only its minimiser to the minimiser's bucket. One that occurs once
   in all documents (and once in its own text) cannot hold a repeated window and is done.
2. The others travel as one packed string (their words, once) to the bucket of their minimiser,
   where the windows of a bucket are sorted and counted word for word: hashes choose where
   windows meet, bytes decide. A minimiser with more than ``HOT`` super-k-mers is divided by window.
3. The covered word ranges go back to the texts, which drop those words.

Equal texts are one text with a count (by MD5); if the count is above one, all their windows
repeat. So a large group of copies is one owner of postings.

Edge cases: NULL text has no words; texts shorter than a window lose nothing; repeated rows are copies of
each other; a window that overlaps itself further on (periodic text) counts; an empty table gives an
empty result; the id may be NULL or repeat, it is only carried; other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import packed

WINDOW = 35
MER = 8
HOT = 50_000
_SEEN = 200_000


def window_minimisers(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``MER``-word run, and the smallest one in each window."""
    runs = packed.runs_of_words(hashes, MER)
    width, span, least = WINDOW - MER + 1, 1, runs
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return runs, (np.minimum(least[:-rest], least[rest:]) if rest else least)


def super_k_mers(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimiser, first window, number of windows, and whether the minimiser recurs in the text."""
    runs, least = window_minimisers(packed.word_hashes(tokens))
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    length = np.diff(np.append(first, len(least)))
    ordered = np.sort(runs)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    return least[first], first, length, np.isin(least[first], twice)


def _send_minimisers(buckets: int):
    def send(batches) -> Iterator[pd.DataFrame]:
        postings, seen = packed.Postings(buckets), set()
        for frame in batches:
            for key, text in zip(frame["key"], frame["text"]):
                if key in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(key)
                tokens = text.split()
                if len(tokens) < WINDOW:
                    continue
                value, first, length, recurs = super_k_mers(tokens)
                more = np.stack([first, length, recurs], axis=1).astype(np.int32)
                postings.add(bytes(key), value, more)
                if postings.full():
                    yield pd.DataFrame(postings.flush(), columns=["bucket", "blob"])
        if postings.size:
            yield pd.DataFrame(postings.flush(), columns=["bucket", "blob"])

    return send


def _meet_minimisers(batches) -> Iterator[pd.DataFrame]:
    """Super-k-mers whose minimiser occurs elsewhere, with the number of its occurrences."""
    for _, rows in packed.by_key(batches, "bucket", ["blob"]):
        value, owner, owners, more = packed.gather([blob for (blob,) in rows])
        order = np.lexsort((more[:, 0], owner, value))
        value, owner, more = value[order], owner[order], more[order]
        fresh = np.ones(len(value), bool)
        fresh[1:] = (
            (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]) | (more[1:, 0] != more[:-1, 0])
        )
        value, owner, more = value[fresh], owner[fresh], more[fresh]
        group = np.cumsum(np.concatenate(([True], value[1:] != value[:-1]))) - 1
        shared = np.bincount(group)[group]
        kept = (shared > 1) | (more[:, 2] == 1)
        yield pd.DataFrame(
            {
                "of_key": [owners[one] for one in owner[kept]],
                "value": value[kept].view(np.int64),
                "first": more[kept, 0],
                "windows": more[kept, 1],
                "hot": shared[kept] > HOT,
            }
        )


def _send_strings(batches) -> Iterator[pd.DataFrame]:
    """Packed strings of the super-k-mers that were asked for."""
    seen: set[bytes] = set()
    columns = ["place", "key", "first", "packed"]
    for frame in batches:
        rows = []
        for key, text, asked in zip(frame["key"], frame["text"], frame["asked"]):
            if key in seen:
                continue
            if len(seen) >= _SEEN:
                seen.clear()
            seen.add(key)
            tokens = text.split()
            for one in asked:
                first, windows = one["first"], one["windows"]
                if not one["hot"]:
                    string = b" ".join(tokens[first : first + windows + WINDOW - 1])
                    rows.append((one["value"], key, first, string))
                    continue
                for at in range(first, first + windows):
                    string = b" ".join(tokens[at : at + WINDOW])
                    place = int.from_bytes(hashlib.md5(string).digest()[:8], "big", signed=True)
                    rows.append((place, key, at, string))
            if len(rows) >= 20_000:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        yield pd.DataFrame(rows, columns=columns)


def _count_windows(batches) -> Iterator[pd.DataFrame]:
    """Word ranges covered by windows that occur at least twice in their bucket."""
    found = []
    for _, rows in packed.by_key(batches, "place", ["key", "first", "packed"]):
        held = []
        for (key, first), string in {(row[0], row[1]): row[2] for row in rows}.items():
            tokens = string.split(b" ")
            ends = np.cumsum([len(token) + 1 for token in tokens]) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            count = len(tokens) - WINDOW + 1
            windows = [
                string[a:b] for a, b in zip(starts[:count].tolist(), ends[WINDOW - 1 :].tolist())
            ]
            held.append((key, first, windows))
        ordered = sorted(window for _, _, windows in held for window in windows)
        twice = {one for one, other in zip(ordered, ordered[1:]) if one == other}
        for key, first, windows in held if twice else ():
            at = [place for place, window in enumerate(windows) if window in twice]
            low = None
            for place, after in zip(at, at[1:] + [None]):
                low = place if low is None else low
                if after != place + 1:
                    found.append((key, first + low, first + place + WINDOW))
                    low = None
        if len(found) >= 20_000:
            yield pd.DataFrame(found, columns=["of_key", "start", "stop"])
            found = []
    yield pd.DataFrame(found, columns=["of_key", "start", "stop"])


def _drop_words(with_text: bool):
    def drop(batches) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for doc, text, copies, ranges in zip(
                frame["doc"], frame["text"], frame["copies"], frame["ranges"]
            ):
                tokens = text.split()
                keep = np.ones(len(tokens), bool)
                if copies > 1 and len(tokens) >= WINDOW:
                    keep[:] = False
                for one in ranges if ranges is not None else ():
                    keep[one["start"] : one["stop"]] = False
                kept = b" ".join(token for token, stays in zip(tokens, keep) if stays)
                removed = int(len(keep) - keep.sum())
                shown = kept.decode() if with_text else None
                rows.append((doc, len(tokens), removed, hashlib.sha256(kept).hexdigest(), shown))
            yield pd.DataFrame(
                rows, columns=["doc", "n_words", "n_removed", "kept_sha256", "kept_text"]
            )

    return drop


def remove_repeats(docs: DataFrame, stage, with_text: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and the kept text.

    ``stage`` writes a table once and returns its reader.
    """
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").cast("string").alias("doc"), binary.alias("text")).withColumn(
        "key", F.unhex(F.md5("text"))
    )
    total = texts.agg(F.sum(F.length("text"))).first()[0]
    buckets = packed.bucket_count(total)
    asked = stage(
        texts.select("key", "text")
        .mapInPandas(_send_minimisers(buckets), "bucket int, blob binary")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(
            _meet_minimisers, "of_key binary, value long, first int, windows int, hot boolean"
        )
        .groupBy("of_key")
        .agg(F.collect_list(F.struct("value", "first", "windows", "hot")).alias("asked")),
        "super-k-mers",
    )
    ranges = stage(
        texts.join(asked, F.col("key") == F.col("of_key"))
        .select("key", "text", "asked")
        .mapInPandas(_send_strings, "place long, key binary, first int, packed binary")
        .repartition("place")
        .sortWithinPartitions("place")
        .mapInPandas(_count_windows, "of_key binary, start int, stop int")
        .groupBy("of_key")
        .agg(F.collect_list(F.struct("start", "stop")).alias("ranges")),
        "repeated-ranges",
    )
    copies = texts.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    touched = (
        ranges.withColumn("copies", F.lit(1).cast("long"))
        .unionByName(
            copies.select(
                F.col("key").alias("of_key"),
                F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges"),
                "copies",
            )
        )
        .groupBy("of_key")
        .agg(F.max("copies").alias("copies"), F.max("ranges").alias("ranges"))
    )
    return (
        texts.join(touched, F.col("key") == F.col("of_key"), "left")
        .select("doc", "text", F.coalesce("copies", F.lit(1)).alias("copies"), "ranges")
        .mapInPandas(
            _drop_words(with_text),
            "doc string, n_words long, n_removed long, kept_sha256 string, kept_text string",
        )
        .withColumn("doc", F.col("doc").cast(docs.schema["doc_id"].dataType))
        .withColumnRenamed("doc", "doc_id")
    )
