"""Global order, running totals and exact medians without a single-task window.

Each function range-partitions on a total order, stages the result so that block
numbers stay fixed, and combines one small row per block. The number of blocks is the
number of shuffle partitions, which bounds everything that is broadcast here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.scratch import stage

# ``monotonically_increasing_id`` is documented as block number << 33 | row in block.
_BLOCK_BITS = 33


def _before_block(blocks: DataFrame, names: list[str]) -> DataFrame:
    """Exclusive running sum of ``names`` over the block totals, one row per block."""
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.select(
        "_block",
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in names
        ],
    )


def global_rank(frame: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Add the 1-based position of each row in a total order.

    The input is staged first: choosing the range bounds reads it once and the shuffle
    reads it again, and neither should repeat the work behind it.
    """
    ordered = stage(frame, "unranked").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(ordered.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    placed = placed.withColumn("_block", F.shiftright("_place", _BLOCK_BITS))
    sizes = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("rows"))
    offsets = _before_block(sizes, ["rows"])
    within = F.col("_place").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), "_block")
        .withColumn(rank, F.col("_before_rows") + within + 1)
        .drop("_block", "_place", "_before_rows")
    )


def running_totals(frame: DataFrame, order: list[Column], names: list[str]) -> DataFrame:
    """Add inclusive running sums of ``names`` (as ``cum_<name>``) in a total order.

    ``frame`` should already be aggregated to one row per distinct order value.
    """
    ranged = frame.repartitionByRange(*order).withColumn(
        "_block", F.spark_partition_id().cast("long")
    )
    placed = stage(ranged, "running")
    totals = placed.groupBy("_block").agg(*[F.sum(name).alias(name) for name in names])
    offsets = _before_block(totals, names)
    up_to_here = (
        Window.partitionBy("_block")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(F.broadcast(offsets), "_block")
        .select(
            *frame.columns,
            *[
                (F.col(f"_before_{name}") + F.sum(name).over(up_to_here)).alias(f"cum_{name}")
                for name in names
            ],
        )
    )


def running_totals_by(
    frame: DataFrame, group: str, order: list[Column], names: list[str]
) -> DataFrame:
    """The same within each ``group``, however large a group is.

    Blocks are ranges over (group, order), so a group may span many blocks and a block may hold
    many groups; one small row per (group, block) carries the totals before it.
    """
    placed = stage(
        frame.repartitionByRange(F.col(group), *order).withColumn(
            "_block", F.spark_partition_id().cast("long")
        ),
        "running",
    )
    earlier = (
        Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy(group, "_block").agg(*[F.sum(name).alias(name) for name in names])
    offsets = totals.select(
        F.col(group).alias("_of_group"),
        F.col("_block").alias("_of_block"),
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in names
        ],
    )
    up_to_here = (
        Window.partitionBy("_block", group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col(group).eqNullSafe(F.col("_of_group")) & (F.col("_block") == F.col("_of_block"))
    return placed.join(offsets, same).select(
        *frame.columns,
        *[
            (F.col(f"_before_{name}") + F.sum(name).over(up_to_here)).alias(f"cum_{name}")
            for name in names
        ],
    )


def grouped_median(frame: DataFrame, group: str, value: str, result: str) -> DataFrame:
    """Exact median of ``value`` per group, whatever the size of a group.

    Values collapse to (group, value, frequency) with map-side combine; only the one
    or two blocks of a group that contain its middle positions are searched in order.
    At most two rows per group pick those blocks; adaptive execution decides how they join.
    """
    frequencies = (
        frame.filter(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("rows"))
        .repartitionByRange(group, value)
        .withColumn("_block", F.spark_partition_id().cast("long"))
    )
    placed = stage(frequencies, "frequencies")
    blocks = placed.groupBy(group, "_block").agg(F.sum("rows").alias("rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("_size")
    middle = (
        blocks.withColumn("_before_rows", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
        .withColumn("_size", F.sum("rows").over(whole))
        .withColumn("_low", F.floor((size + 1) / 2).cast("long"))
        .withColumn("_high", (F.floor(size / 2) + 1).cast("long"))
        .filter(
            (F.col("_before_rows") < F.col("_high"))
            & (F.col("_before_rows") + F.col("rows") >= F.col("_low"))
        )
        .select(group, "_block", "_before_rows", "_low", "_high")
    )
    upto = (
        Window.partitionBy(group, "_block")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    last = F.col("_before_rows") + F.sum("rows").over(upto)
    located = (
        placed.join(middle, [group, "_block"])
        .withColumn("_last_position", last)
        .withColumn("_first_position", F.col("_last_position") - F.col("rows") + 1)
    )
    at_low = F.col("_low").between(F.col("_first_position"), F.col("_last_position"))
    at_high = F.col("_high").between(F.col("_first_position"), F.col("_last_position"))
    return located.groupBy(group).agg(
        (
            (F.max(F.when(at_low, F.col(value))) + F.max(F.when(at_high, F.col(value))))
            / F.lit(2.0)
        ).alias(result)
    )


_RANGES = 512


def exact_medians(frame: DataFrame, names: list[str]) -> dict[str, float]:
    """Exact median of each column over its values; columns without a value are left out.

    A selection for all columns at once: each pass counts the values of a column that lie in its
    current range, split into equal steps, and keeps the step that holds the middle. Only counts per
    step are shuffled, and the driver sees at most ``_RANGES`` rows per column, however many rows
    there are. The ends of a step are values that occur, so each pass parts the least from the
    greatest and the search ends. NaN counts as missing.
    """
    values = [F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")) for name in names]
    ends = frame.agg(
        *[F.struct(F.count(v), F.min(v), F.max(v)).alias(str(at)) for at, v in enumerate(values)]
    ).first()
    # Per column: rows before the range, its ends, and the two middle positions.
    open_ranges = {
        at: (0, low, high, (rows + 1) // 2, rows // 2 + 1)
        for at, (rows, low, high) in enumerate(ends)
        if rows
    }
    found: dict[str, float] = {}
    while True:
        for at, (_, low, high, _, _) in list(open_ranges.items()):
            if low == high:
                found[names[at]] = low
                del open_ranges[at]
        if not open_ranges:
            return found

        def bound(which: int) -> Column:
            edges = [open_ranges[at][which] if at in open_ranges else None for at in range(len(names))]
            return F.get(F.array(*[F.lit(edge).cast("double") for edge in edges]), F.col("at"))

        # Columns whose median is found are not read again.
        pieces = [F.struct(F.lit(at).alias("at"), values[at].alias("value")) for at in open_ranges]
        counts = (
            frame.select(F.explode(F.array(*pieces)).alias("one"))
            .select("one.*")
            .filter((F.col("value") >= bound(1)) & (F.col("value") <= bound(2)))
            .withColumn(
                "step",
                F.least(
                    F.floor((F.col("value") - bound(1)) / (bound(2) - bound(1)) * _RANGES),
                    F.lit(_RANGES - 1),
                ),
            )
            .groupBy("at", "step")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
            .orderBy("at", "step")
            .collect()
        )
        narrowed: dict[int, tuple] = {}
        passed = {at: state[0] for at, state in open_ranges.items()}
        below: dict[int, float] = {}
        for at, _, rows, low, high in counts:
            before, first, second = passed[at], *open_ranges[at][3:]
            passed[at] = before + rows
            if before < first <= passed[at] and second <= passed[at]:
                narrowed[at] = (before, low, high, first, second)
            elif before < first <= passed[at]:
                below[at] = high
            elif before < second <= passed[at]:
                # The middle falls between two steps: the ends of both are the middle values.
                found[names[at]] = (below[at] + low) / 2.0
        open_ranges = narrowed
