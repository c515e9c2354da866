"""Sharding by sampled splitters.

1. Draw keys with probability proportional to the size of their record.
2. Weighted quantiles of the sample become range boundaries.
3. Every range is measured exactly. One that holds more than twice its share (a key that
   many records carry, or bad luck) is divided by a second draw over (key, tie), so that
   no task grows with a hot key.
4. Records are partitioned by range and ordered inside it. Exact totals of the earlier
   ranges turn local running sums into global byte offsets, and the shard is the share of
   all bytes in which the middle of a record lies: sizes differ by one record at most.

The driver holds the sample (``SAMPLES_PER_RANGE`` keys a range) and one row per range, at most
``MAX_RANGES`` before division; both are independent of the number of records.

Edge cases: an empty table gives an empty result; NULL keys, ties and sizes count as 0 (sizes as
1 at least); repeated rows share key and tie and take adjacent places; other columns pass through, and
names starting with ``_shard_`` are reserved.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import literal_longs

RANGE_BYTES = 32 << 20
MAX_RANGES = 8192
RANGES_PER_SHARD = 4
SAMPLES_PER_RANGE = 16
OVERFULL = 2.0
_LOWEST = -(1 << 63)


def _chance(seed: int) -> Column:
    """A number in [0, 1) that every rerun draws again for the same key and tie."""
    drawn = F.xxhash64(F.lit(seed), "_shard_key", "_shard_tie")
    return F.shiftrightunsigned(drawn, 11).cast("double") / F.lit(float(1 << 53))


def _sampled(records: DataFrame, per_byte: float, seed: int) -> DataFrame:
    weight = F.greatest(F.col("_shard_size").cast("double"), F.lit(1.0 / per_byte))
    return records.filter(_chance(seed) < F.col("_shard_size") * F.lit(per_byte)).select(
        "_shard_key", "_shard_tie", weight.alias("_shard_weight")
    )


def _quantiles(drawn: list[tuple[tuple[int, int], float]], pieces: int) -> list[tuple[int, int]]:
    """Keys that divide the drawn weight into ``pieces`` equal parts."""
    drawn = sorted(drawn)
    total = sum(weight for _, weight in drawn)
    cuts: list[tuple[int, int]] = []
    seen = 0.0
    for key, weight in drawn:
        if seen >= total * (len(cuts) + 1) / pieces and (not cuts or key > cuts[-1]):
            cuts.append(key)
            if len(cuts) == pieces - 1:
                break
        seen += weight
    return cuts


def _range_of(cuts: list[tuple[int, int]]) -> Column:
    """Number of cuts at or below (key, tie), by binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    keys = literal_longs([key for key, _ in cuts])
    ties = literal_longs([tie for _, tie in cuts])
    steps = [1 << bit for bit in reversed(range(len(cuts).bit_length()))]

    def advance(at: Column, step: Column) -> Column:
        probe = at + step - 1
        key = F.get(keys, probe)
        below = (key < F.col("_shard_key")) | (
            (key == F.col("_shard_key")) & (F.get(ties, probe) <= F.col("_shard_tie"))
        )
        return at + F.when(below, step).otherwise(F.lit(0))

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), advance)


def _measured(records: DataFrame) -> dict[int, tuple[int, int]]:
    rows = (
        records.groupBy("_shard_range")
        .agg(F.sum("_shard_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    return {row["_shard_range"]: (row["bytes"], row["rows"]) for row in rows}


def splitters(records: DataFrame, n_shards: int, seed: int) -> tuple[list[tuple[int, int]], int]:
    """Range boundaries over (key, tie), and the sum of all sizes."""
    total, rows = records.agg(F.sum("_shard_size"), F.count(F.lit(1))).first()
    if not rows:
        return [], 0
    pieces = min(MAX_RANGES, max(n_shards * RANGES_PER_SHARD, -(-total // RANGE_BYTES)))
    share = total / pieces
    per_byte = SAMPLES_PER_RANGE / share
    first = _sampled(records, per_byte, seed).groupBy("_shard_key").agg(
        F.sum("_shard_weight").alias("weight")
    )
    cuts = _quantiles([((row[0], _LOWEST), row[1]) for row in first.collect()], pieces)
    ranged = records.withColumn("_shard_range", _range_of(cuts))
    overfull = {
        number: held
        for number, (held, members) in _measured(ranged).items()
        if held > OVERFULL * share and members > 1
    }
    if overfull:
        inside = F.array_contains(literal_longs(sorted(overfull)), F.col("_shard_range").cast("long"))
        drawn: dict[int, list[tuple[tuple[int, int], float]]] = {}
        for key, tie, weight in _sampled(ranged.filter(inside), per_byte, seed + 1).collect():
            drawn.setdefault(bisect_right(cuts, (key, tie)), []).append(((key, tie), weight))
        for number, sample in drawn.items():
            cuts = cuts + _quantiles(sample, max(1, round(overfull[number] / share)))
        cuts = sorted(set(cuts))
    return cuts, total


def shard(
    records: DataFrame, n_shards: int, key: Column, tie: Column, size: Column, seed: int = 17
) -> DataFrame:
    """``records`` with ``shard`` (0 to n_shards - 1) and ``slot``, its gapless place there."""
    keyed = records.withColumns(
        {
            "_shard_key": F.coalesce(key.cast("long"), F.lit(0)),
            "_shard_tie": F.coalesce(tie.cast("long"), F.lit(0)),
            "_shard_size": F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)),
        }
    )
    narrow = keyed.select("_shard_key", "_shard_tie", "_shard_size")
    cuts, total = splitters(narrow, n_shards, seed)
    bytes_before, rows_before = [0], [0]
    held = _measured(narrow.withColumn("_shard_range", _range_of(cuts)))
    for number in range(len(cuts)):
        size_here, rows_here = held.get(number, (0, 0))
        bytes_before.append(bytes_before[-1] + size_here)
        rows_before.append(rows_before[-1] + rows_here)

    def placed(frame: DataFrame) -> DataFrame:
        inside = Window.partitionBy("_shard_range").orderBy(
            "_shard_key", "_shard_tie", "_shard_size"
        )
        to_here = F.sum("_shard_size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
        start = F.get(literal_longs(bytes_before), F.col("_shard_range"))
        middle_twice = 2 * (start + F.col("_shard_to_here")) - F.col("_shard_size")
        number = F.floor(
            middle_twice.cast("decimal(38,0)") * F.lit(n_shards) / F.lit(max(1, 2 * total))
        ).cast("int")
        return (
            frame.withColumn("_shard_range", _range_of(cuts))
            .withColumn("_shard_to_here", to_here)
            .withColumn(
                "_shard_rank",
                F.get(literal_longs(rows_before), F.col("_shard_range"))
                + F.row_number().over(inside)
                - 1,
            )
            .withColumn("shard", F.least(number, F.lit(n_shards - 1)))
        )

    firsts = {
        row["shard"]: row["first"]
        for row in placed(narrow)
        .groupBy("shard")
        .agg(F.min("_shard_rank").alias("first"))
        .collect()
    }
    first = literal_longs([firsts.get(number, 0) for number in range(n_shards)])
    shown = [name for name in records.columns if name not in ("shard", "slot")]
    return placed(keyed).select(
        *[F.col(f"`{name}`") for name in shown],
        "shard",
        (F.col("_shard_rank") - F.get(first, F.col("shard"))).alias("slot"),
    )


def record_size(text: Column) -> Column:
    """UTF-8 bytes plus an eight-byte length prefix."""
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 8).cast("long")


def shard_documents(docs: DataFrame, n_shards: int, seed: int = 17) -> DataFrame:
    """All documents with their texts; equal texts adjoin unless their range was divided."""
    return shard(
        docs, n_shards, F.xxhash64("text"), F.xxhash64("doc_id"), record_size(F.col("text")), seed
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
