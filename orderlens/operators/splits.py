"""Chronological splits and the leakage audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import RunConfig

SPLITS = ("train", "validation", "test")


def split_of(config: RunConfig) -> Column:
    """Split by score date; with ``purge_days`` the rows whose labels reach into the
    next split belong to none (NULL). The default purges nothing."""
    day = F.col("score_date")
    validation = F.lit(config.validation_start).cast("date")
    test = F.lit(config.test_start).cast("date")
    purged = (
        (day < validation) & (day >= F.date_sub(validation, config.purge_days))
    ) | ((day < test) & (day >= F.date_sub(test, config.purge_days)))
    return F.when(purged, F.lit(None).cast("string")).otherwise(
        F.when(day < validation, SPLITS[0]).when(day < test, SPLITS[1]).otherwise(SPLITS[2])
    )


def split_by_time(
    snapshots: DataFrame, config: RunConfig
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows; an empty split is an error."""
    parts = tuple(snapshots.filter(split_of(config) == name) for name in SPLITS)
    if any(part.isEmpty() for part in parts):
        raise RuntimeError("At least one chronological split is empty")
    return parts


def split_counts(snapshots: DataFrame, config: RunConfig) -> DataFrame:
    """Rows, labeled rows, positives and date range per split."""
    return snapshots.groupBy(split_of(config).alias("split")).agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.count("next_category").alias("category_labeled"),
        F.sum(F.col("purchase_within_30d").cast("long")).alias("purchases_within_30d"),
        F.min("score_date").alias("first_score_date"),
        F.max("score_date").alias("last_score_date"),
    )


def leakage_audit(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of two snapshot tables that are not shared; both counts 0 when nothing leaks.

    One multiset comparison: every distinct row is counted up for one table and down
    for the other, so each table is computed once.
    """
    columns = before.columns
    net = (
        before.withColumn("_side", F.lit(1))
        .unionByName(after.select(*columns).withColumn("_side", F.lit(-1)))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("_net"))
    )
    return net.agg(
        F.coalesce(F.sum(F.greatest(F.col("_net"), F.lit(0))), F.lit(0)).alias("vanished_rows"),
        F.coalesce(F.sum(F.greatest(-F.col("_net"), F.lit(0))), F.lit(0)).alias("new_rows"),
    )
