"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are put in a random order that depends on the seed and the document
alone, and the order is cut into blocks. The target says how often the mix runs through a source:
some whole passes and a last one that stops where its word quota is met. The blocks a
source owes the mix are its quota; a tree over the output shards splits the vector of all
quotas exactly (at each node the left half draws its share without replacement), so every shard
gets a fixed number of blocks of each source, and takes disjoint consecutive blocks of the
permutation. A copy belongs to the mix because its block was given to a shard: copies, words taken
and the layout of the mixed rows all follow from the shards. Inside a shard, documents are ordered by a
second random number, and consecutive slices of that order are written by different tasks.

Running sums are over one block, and offsets over one row per block, so a source that
holds a third of all rows is no hot group. The driver holds one row per source.

Edge cases: NULL text has size 0; NULL is a source of its own and sorts last; an empty table
gives an empty result; repeated rows are drawn on their own, side by side in the permutation.
Other columns pass through, but those that this operator adds replace columns of the same name; names
starting with ``_mix_`` are reserved.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.scratch import stage

WEIGHTS = (5, 2, 1)
MIX_PERCENT = 150
MAX_PASSES = 2
BLOCK_WORDS = 50_000
MAX_BLOCKS = 1 << 20
MIX_SHARDS = 64
SLICE_WORDS = 1_000_000
_BITS = 60
_ADDED = ("size", "source_size", "target", "copies", "mix_shards", "mix_order", "mix_slice")


def targets(sizes: list[int], weights: list[int], percent: int = MIX_PERCENT, passes: int = MAX_PASSES) -> list[Fraction]:
    """Words the mix wants of each source.

    The whole is ``percent`` of all sizes, shared by weight. A source above ``passes`` times
    its size stops there and the excess is shared among the others until none is above.
    """
    wanted = Fraction(percent * sum(sizes), 100)
    open_sources = set(range(len(sizes)))
    out = [Fraction(0)] * len(sizes)
    while open_sources:
        total = sum(weights[at] for at in open_sources)
        level = wanted / total
        above = {at for at in open_sources if level * weights[at] > passes * sizes[at]}
        if not above:
            for at in open_sources:
                out[at] = level * weights[at]
            break
        for at in above:
            out[at] = Fraction(passes * sizes[at])
            wanted -= out[at]
        open_sources -= above
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard; rows are shards, columns sum to ``quotas``."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def divide(low: int, high: int, owed: np.ndarray) -> None:
        if high - low == 1:
            out[low] = owed
            return
        middle = (low + high) // 2
        share = int(owed.sum()) * (middle - low) // (high - low)
        drawn = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(
            owed, share, method="marginals"
        )
        divide(low, middle, drawn)
        divide(middle, high, owed - drawn)

    divide(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def _random(seed: int, purpose: str, doc_id: Column, size: Column) -> Column:
    """A 60-bit number drawn by document; any engine with MD5 draws the same."""
    text = F.concat_ws("|", F.lit(f"{purpose}{seed}"), F.coalesce(doc_id.cast("string"), F.lit("-")), size.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("long")


_SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("_mix_source", T.StringType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("_mix_passes", T.IntegerType()),
        T.StructField("_mix_left", T.DoubleType()),
        T.StructField("_mix_blocks", T.LongType()),
    ]
)
_CUT_SCHEMA = "_mix_cut_source string, _mix_cuts array<bigint>"


def _sources(spark: SparkSession, sizes: list[tuple[str | None, int]], percent: int) -> DataFrame:
    """One row per source: size, target, whole passes, words of the last pass, blocks."""
    ordered = sorted(sizes, key=lambda row: (row[0] is None, row[0] or ""))
    weights = [WEIGHTS[at % len(WEIGHTS)] for at in range(len(ordered))]
    rows = []
    for (source, size), target in zip(ordered, targets([n for _, n in ordered], weights, percent)):
        blocks = max(1, min(MAX_BLOCKS, -(-size // BLOCK_WORDS)))
        passes = int(target // size) if size else 0
        rows.append((source, size, float(target), passes, float(target - passes * size), blocks))
    return spark.createDataFrame(rows, _SOURCE_SCHEMA)


def _placed(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Documents with their source's row, their random number and their block."""
    random = _random(seed, "place", F.col("doc_id"), F.col("size"))
    block = F.shiftright(F.shiftright("_mix_random", _BITS - 40) * F.col("_mix_blocks"), 40)
    return (
        sized.join(sources, F.col("source").eqNullSafe(F.col("_mix_source")))
        .withColumn("_mix_random", random)
        .withColumn("_mix_block", block)
    )


def _cuts(spark: SparkSession, offsets: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """One row per source: where in its sequence of blocks each output shard ends."""
    owed = (
        offsets.join(sources, F.col("_mix_of").eqNullSafe(F.col("_mix_source")))
        .groupBy("_mix_of")
        .agg(
            (
                F.max(F.col("_mix_passes") * F.col("_mix_blocks"))
                + F.max(
                    F.when(F.col("_mix_before") < F.col("_mix_left"), F.col("_mix_number") + 1)
                    .otherwise(F.lit(0))
                )
            ).alias("owed")
        )
        .collect()
    )
    owed.sort(key=lambda row: (row["_mix_of"] is None, row["_mix_of"] or ""))
    ends = split_quotas([row["owed"] for row in owed], MIX_SHARDS, seed).cumsum(axis=0)
    rows = [(row["_mix_of"], [int(end) for end in ends[:, at]]) for at, row in enumerate(owed)]
    return spark.createDataFrame(rows, _CUT_SCHEMA)


def mix(docs: DataFrame, size: Column, seed: int = 29, percent: int = MIX_PERCENT) -> DataFrame:
    """``docs`` with the plan of the mix.

    Adds ``size``, ``source_size``, ``target``, ``copies`` (how often the document is taken, at
    most ``MAX_PASSES``), ``mix_shards`` (the output shard of each copy), ``mix_order`` (sorts the
    documents of a shard) and ``mix_slice`` (numbers stretches of that order of about ``SLICE_WORDS``
    words). Documents whose blocks the tree gives to no shard have no copies.
    """
    spark = docs.sparkSession
    narrow = stage(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("size")).collect()
    sources = _sources(spark, [(row["source"], row["size"]) for row in sizes], percent)
    mixed_words = sum(row["size"] for row in sizes) * percent // 100
    slices = max(1, min(MAX_BLOCKS, -(-mixed_words // (MIX_SHARDS * SLICE_WORDS))))
    earlier = Window.partitionBy("_mix_source").orderBy("_mix_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = stage(
        _placed(narrow, sources, seed)
        .groupBy("_mix_source", "_mix_block")
        .agg(F.sum("size").alias("_mix_size"))
        .select(
            F.col("_mix_source").alias("_mix_of"),
            F.col("_mix_block").alias("_mix_number"),
            F.coalesce(F.sum("_mix_size").over(earlier), F.lit(0)).alias("_mix_before"),
        ),
        "mix-blocks",
    )
    cuts = _cuts(spark, offsets, sources, seed)
    inside = Window.partitionBy("_mix_source", "_mix_block").orderBy(
        "_mix_random", "doc_id", "size"
    ).rowsBetween(Window.unboundedPreceding, 0)
    names = [name for name in docs.columns if name not in _ADDED]
    sized = docs.select(*[F.col(f"`{name}`") for name in names], size.alias("size"))
    placed = (
        _placed(sized, sources, seed)
        .withColumn("_mix_to_here", F.sum("size").over(inside))
        .join(
            offsets,
            F.col("_mix_source").eqNullSafe(F.col("_mix_of"))
            & (F.col("_mix_block") == F.col("_mix_number")),
        )
        .join(cuts, F.col("_mix_source").eqNullSafe(F.col("_mix_cut_source")))
    )
    middle_twice = 2 * (F.col("_mix_before") + F.col("_mix_to_here")) - F.col("size")
    last_pass = (middle_twice <= 2 * F.col("_mix_left")).cast("int")
    passes = F.when(F.col("size") > 0, F.col("_mix_passes") + last_pass).otherwise(F.lit(0))

    def shard_of(number: Column) -> Column:
        unit = number * F.col("_mix_blocks") + F.col("_mix_block")
        return F.size(F.filter("_mix_cuts", lambda cut: cut <= unit))

    numbers = F.slice(F.array(*[F.lit(at) for at in range(MAX_PASSES)]), 1, passes)
    given = F.filter(F.transform(numbers, shard_of), lambda number: number < MIX_SHARDS)
    order = _random(seed, "order", F.col("doc_id"), F.col("size"))
    return placed.withColumns({"mix_shards": given, "mix_order": order}).select(
        *[F.col(f"`{name}`") for name in names],
        "size",
        "source_size",
        "target",
        F.size("mix_shards").alias("copies"),
        "mix_shards",
        "mix_order",
        F.shiftright(F.shiftright("mix_order", _BITS - 40) * F.lit(slices), 40).alias("mix_slice"),
    )


def laid_out(planned: DataFrame) -> DataFrame:
    """One row per copy, by ``mix_shard`` and slice over the tasks, in the order of the shard inside each."""
    copies = planned.withColumn("mix_shard", F.explode("mix_shards"))
    return copies.repartition("mix_shard", "mix_slice").sortWithinPartitions("mix_shard", "mix_order")


def mixed_documents(docs: DataFrame, size: Column, seed: int = 29, percent: int = MIX_PERCENT) -> DataFrame:
    """The rows of the mix, as the splitting tree lays them out; with the columns of ``docs`` only."""
    whole = docs.select(
        "doc_id", "source", size.alias("_mix_words"), F.struct("*").alias("_mix_document")
    )
    return laid_out(mix(whole, F.col("_mix_words"), seed, percent)).select("_mix_document.*")


def write_mix(planned: DataFrame, columns: list[str], path: str) -> None:
    """One folder per output shard, shuffled inside each file."""
    laid_out(planned).select(*columns, "mix_shard").write.partitionBy("mix_shard").parquet(path)
