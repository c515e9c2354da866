"""Scorers without a fit. Class probabilities are arrays in class-list order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import config as fixed
from orderlens.functions import expressions as E

Classes = list[str] | tuple[str, ...]


def class_table(spark: SparkSession, classes: Classes) -> DataFrame:
    """(class_index, category), one row per class of the list."""
    rows = [
        F.struct(F.lit(index).alias("class_index"), F.lit(name).alias("category"))
        for index, name in enumerate(classes)
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def popularity_table(labels: DataFrame, label: str, classes: Classes) -> DataFrame:
    """Share of each class among the labels that belong to the class list."""
    rows = F.col("listed")
    return (
        _collected_counts(labels, label, classes)
        .select("total", F.explode("listed").alias("listed"))
        .select(
            rows["class_index"].alias("class_index"),
            rows["category"].alias("category"),
            rows["orders"].alias("orders"),
            _share(rows["orders"], F.col("total")).alias("probability"),
        )
    )


def popularity_vector(labels: DataFrame, label: str, classes: Classes) -> Column:
    """The same shares as one array column, in class order; attaches to any frame."""
    return (
        _collected_counts(labels, label, classes)
        .select(F.transform("listed", lambda row: _share(row["orders"], F.col("total"))))
        .scalar()
    )


def _collected_counts(labels: DataFrame, label: str, classes: Classes) -> DataFrame:
    """One row: how often each class occurs, in class order, and the total.

    Only classes of the list are collected, so the map has at most that many entries.
    """
    counted = (
        labels.filter(F.col(label).isin(*classes))
        .groupBy(F.col(label).alias("category"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .agg(
            F.map_from_entries(F.collect_list(F.struct("category", "orders"))).alias("counts"),
            F.sum("orders").alias("total"),
        )
    )
    listed = [
        F.struct(
            F.lit(index).alias("class_index"),
            F.lit(name).alias("category"),
            F.coalesce(F.try_element_at("counts", F.lit(name)), F.lit(0)).alias("orders"),
        )
        for index, name in enumerate(classes)
    ]
    return counted.select(F.array(*listed).alias("listed"), "total")


def _share(orders: Column, total: Column) -> Column:
    return F.try_divide(orders.cast("double"), total.cast("double"))


def last_category_probabilities(
    snapshots: DataFrame, base: str, classes: Classes, result: str = "probabilities"
) -> DataFrame:
    """Blend the popularity array ``base`` with the last category and normalise.

    A last category outside the class list receives no weight. The class list is part
    of the schema, so the expression is unrolled and needs neither join nor explode.
    """
    weights = [
        F.lit(fixed.POPULARITY_WEIGHT) * F.element_at(base, index + 1)
        + F.when(F.col("last_category") == name, F.lit(fixed.LAST_CATEGORY_WEIGHT)).otherwise(0.0)
        for index, name in enumerate(classes)
    ]
    total = sum(weights[1:], weights[0])
    return snapshots.withColumn(result, F.array(*[weight / total for weight in weights]))


def with_cadence_readiness(snapshots: DataFrame, result: str = "readiness") -> DataFrame:
    return snapshots.withColumn(
        result, E.cadence_readiness(F.col("cadence_progress"), F.col("order_momentum"))
    )
