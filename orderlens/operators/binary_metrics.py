"""Discrimination, calibration and capacity metrics of a probability column.

Scores collapse to one row per distinct value before anything is ordered. Equal scores
therefore form one threshold, and a score shared by many rows is no hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens import config as fixed
from orderlens.operators.ranking import global_rank, running_totals, running_totals_by
from orderlens.operators.ranking_metrics import EPSILON
from orderlens.scratch import stage


def score_curve(frame: DataFrame, label: str, score: str) -> DataFrame:
    """(score, rows, positives) with running totals from the highest score down."""
    collapsed = frame.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label).cast("long")).alias("positives"),
    )
    return running_totals(collapsed, [F.col("score").desc()], ["rows", "positives"])


def average_precision_column() -> Column:
    """Sum over thresholds of precision weighted by the recall gained there."""
    precision = F.col("cum_positives") / F.col("cum_rows")
    return F.coalesce(
        F.try_divide(F.sum(F.col("positives") * precision), F.sum("positives")), F.lit(0.0)
    )


def roc_auc_column() -> Column:
    """Chance that a positive outranks a negative, half for ties; NULL for one class.

    Pair counts go through decimals: they exceed 64 bits long before rows do.
    """
    negatives = (F.col("rows") - F.col("positives")).cast("decimal(20,0)")
    cum_negatives = (F.col("cum_rows") - F.col("cum_positives")).cast("decimal(20,0)")
    # Twice the pairs lost or tied per threshold, to stay in whole numbers.
    positives = F.col("positives").cast("decimal(18,0)")
    lost = F.sum((positives * (2 * (cum_negatives - negatives) + negatives)).cast("double"))
    pairs = F.sum("positives").cast("double") * F.sum(F.col("rows") - F.col("positives")).cast(
        "double"
    )
    return F.when(pairs > 0, F.lit(1.0) - F.try_divide(lost, F.lit(2.0) * pairs))


def brier_column(label: str, score: str) -> Column:
    return F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0)))


def log_loss_column(label: str, score: str) -> Column:
    own = F.when(F.col(label) == 1, F.col(score)).otherwise(F.lit(1.0) - F.col(score))
    clipped = F.greatest(F.least(own, F.lit(1.0 - EPSILON)), F.lit(EPSILON))
    return F.avg(-F.log(clipped))


def top_share(
    frame: DataFrame, curve: DataFrame, label: str, score: str, ties: list[str]
) -> DataFrame:
    """Recall and lift within the best-scored fifth, ``ties`` deciding equal scores.

    The curve settles every score above the cut. Only rows that share the score at the
    cut are ordered individually.
    """
    sizes = curve.agg(
        F.sum("rows").alias("total"), F.sum("positives").alias("total_positives")
    ).withColumn(
        "wanted",
        F.greatest(
            F.lit(1), F.ceil(F.lit(fixed.TOP_SHARE) * F.col("total").cast("double"))
        ).cast("long"),
    )
    wanted = sizes.select("wanted").scalar()
    cut = curve.filter(
        (F.col("cum_rows") >= wanted) & (F.col("cum_rows") - F.col("rows") < wanted)
    ).select(
        "score",
        (F.col("cum_positives") - F.col("positives")).alias("above"),
        (wanted - (F.col("cum_rows") - F.col("rows"))).alias("remaining"),
    )
    cut = stage(cut, "cut")
    at_cut = frame.filter(F.col(score) == cut.select("score").scalar()).select(label, *ties)
    ranked = global_rank(at_cut, [F.col(name) for name in ties], "tie_rank")
    from_ties = ranked.filter(F.col("tie_rank") <= cut.select("remaining").scalar()).agg(
        F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0)).alias("captured_ties")
    )
    captured = (from_ties.scalar() + cut.select("above").scalar()).cast("double")
    base = F.try_divide(F.col("total_positives").cast("double"), F.col("total").cast("double"))
    return sizes.select(
        F.coalesce(
            F.try_divide(captured, F.col("total_positives").cast("double")), F.lit(0.0)
        ).alias("recall_at_top_20pct"),
        F.coalesce(
            F.try_divide(F.try_divide(captured, F.col("wanted").cast("double")), base), F.lit(0.0)
        ).alias("lift_at_top_20pct"),
    )


def binary_metrics(frame: DataFrame, label: str, score: str, ties: list[str]) -> DataFrame:
    """All binary metrics, one row."""
    curve = stage(score_curve(frame, label, score), "curve")
    discrimination = curve.agg(
        average_precision_column().alias("average_precision"), roc_auc_column().alias("roc_auc")
    )
    calibration = frame.agg(
        brier_column(label, score).alias("brier_score"),
        log_loss_column(label, score).alias("log_loss"),
    )
    capacity = top_share(frame, curve, label, score, ties)
    row = F.struct(*[F.col(c) for c in ("average_precision", "roc_auc")])
    quality = F.struct(*[F.col(c) for c in ("brier_score", "log_loss")])
    return capacity.select(
        discrimination.select(row).scalar().alias("curve"),
        calibration.select(quality).scalar().alias("quality"),
        "recall_at_top_20pct",
        "lift_at_top_20pct",
    ).select("curve.*", "quality.*", "recall_at_top_20pct", "lift_at_top_20pct")


def binary_metrics_by(
    frame: DataFrame, group: str, label: str, score: str, ties: list[str]
) -> DataFrame:
    """All binary metrics of each group, one row a group; no group meets in one task.

    Scores collapse to one row per (group, value), running totals cross blocks, and only rows that
    share the score at their group's cut are placed one by one.
    """
    collapsed = frame.groupBy(group, F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col(label).cast("long")).alias("positives"),
    )
    curve = stage(
        running_totals_by(collapsed, group, [F.col("score").desc()], ["rows", "positives"]), "curves"
    )
    sizes = curve.groupBy(group).agg(
        F.sum("rows").alias("total"),
        F.sum("positives").alias("total_positives"),
        average_precision_column().alias("average_precision"),
        roc_auc_column().alias("roc_auc"),
    )
    wanted = F.greatest(
        F.lit(1), F.ceil(F.lit(fixed.TOP_SHARE) * F.col("total").cast("double"))
    ).cast("long")
    sizes = stage(
        sizes.withColumn("wanted", wanted).withColumnRenamed(group, "_of_group"), "group-sizes"
    )
    cut = curve.join(sizes, F.col(group).eqNullSafe(F.col("_of_group"))).filter(
        (F.col("cum_rows") >= F.col("wanted"))
        & (F.col("cum_rows") - F.col("rows") < F.col("wanted"))
    )
    cut = cut.select(
        "_of_group",
        F.col("score").alias("_cut"),
        (F.col("cum_positives") - F.col("positives")).alias("_above"),
        (F.col("wanted") - (F.col("cum_rows") - F.col("rows"))).alias("_remaining"),
    )
    cut = stage(cut, "group-cuts")
    tied = frame.join(
        cut, F.col(group).eqNullSafe(F.col("_of_group")) & (F.col(score) == F.col("_cut"))
    ).select(
        F.col(group).alias("_tied_group"),
        F.col(label).cast("long").alias("_label"),
        "_remaining",
        F.lit(1).cast("long").alias("_one"),
        *ties,
    )
    placed = running_totals_by(tied, "_tied_group", [F.col(name) for name in ties], ["_one"])
    captured = (
        placed.filter(F.col("cum__one") <= F.col("_remaining"))
        .groupBy("_tied_group")
        .agg(F.sum("_label").alias("_captured"))
    )
    calibration = frame.groupBy(F.col(group).alias("_seen_group")).agg(
        F.avg(F.col(score).cast("double")).alias("average_score"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
        brier_column(label, score).alias("brier_score"),
        log_loss_column(label, score).alias("log_loss"),
    )
    joined = (
        calibration.join(sizes, F.col("_seen_group").eqNullSafe(F.col("_of_group")))
        .join(
            cut.select(F.col("_of_group").alias("_cut_group"), "_above"),
            F.col("_seen_group").eqNullSafe(F.col("_cut_group")),
            "left",
        )
        .join(captured, F.col("_seen_group").eqNullSafe(F.col("_tied_group")), "left")
    )
    top = (F.coalesce("_above", F.lit(0)) + F.coalesce("_captured", F.lit(0))).cast("double")
    positives = F.col("total_positives").cast("double")
    base = F.try_divide(positives, F.col("total").cast("double"))
    return joined.select(
        F.col("_seen_group").alias(group),
        F.col("total").alias("snapshots"),
        "average_precision",
        "roc_auc",
        "brier_score",
        "log_loss",
        F.coalesce(F.try_divide(top, positives), F.lit(0.0)).alias("recall_at_top_20pct"),
        F.coalesce(
            F.try_divide(F.try_divide(top, F.col("wanted").cast("double")), base), F.lit(0.0)
        ).alias("lift_at_top_20pct"),
        "average_score",
        "observed_rate",
        (F.col("average_score") - F.col("observed_rate")).alias("calibration_gap"),
    )
