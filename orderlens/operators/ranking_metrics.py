"""Quality of ranked class probabilities (arrays in class-list order).

Ranks come from the row's own array, so nothing is exploded and nothing is shuffled
beyond the final one-row aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import expressions as E
from orderlens.operators.baselines import class_table

Classes = list[str] | tuple[str, ...]
# Fixed value: spacing of float64 at 1, the clip used by the log loss.
EPSILON = 2.0**-52


def true_class_rank(position: Column, probabilities: Column) -> Column:
    """1 + number of classes ahead: a larger probability, or an equal one listed earlier."""
    own = F.element_at(probabilities, position)
    ahead = F.filter(
        probabilities,
        lambda p, index: (p > own) | ((p == own) & (index + 1 < position)),
    )
    return F.size(ahead) + 1


def with_true_rank(
    frame: DataFrame, label: str, probabilities: str, classes: Classes
) -> DataFrame:
    """Add ``true_rank``, ``true_probability`` and ``squared_error`` per row.

    A label outside the class list is an error, raised when the row is evaluated.
    """
    position = E.class_position(F.col(label), classes)
    checked = F.when(position.isNotNull(), position).otherwise(
        F.raise_error(F.concat(F.lit("Label outside the class list: "), F.col(label))).cast("int")
    )
    squares = F.aggregate(
        F.transform(
            probabilities,
            lambda p, index: F.pow(
                p - F.when(index + 1 == F.col("true_position"), 1.0).otherwise(0.0), F.lit(2.0)
            ),
        ),
        F.lit(0.0),
        lambda total, x: total + x,
    )
    return (
        frame.withColumn("true_position", checked)
        .withColumn("true_rank", true_class_rank(F.col("true_position"), F.col(probabilities)))
        .withColumn("true_probability", F.element_at(probabilities, F.col("true_position")))
        .withColumn("squared_error", squares)
        .drop("true_position")
    )


def hit_rate(k: int) -> Column:
    return F.avg((F.col("true_rank") <= k).cast("double"))


def reciprocal_rank() -> Column:
    return F.avg(F.lit(1.0) / F.col("true_rank"))


def log_loss() -> Column:
    clipped = F.greatest(F.least(F.col("true_probability"), F.lit(1.0 - EPSILON)), F.lit(EPSILON))
    return F.avg(-F.log(clipped))


def brier() -> Column:
    return F.avg("squared_error")


def metric_columns() -> list[Column]:
    return [
        hit_rate(1).alias("top_1_hit_rate"),
        hit_rate(2).alias("top_2_hit_rate"),
        hit_rate(3).alias("top_3_hit_rate"),
        reciprocal_rank().alias("mean_reciprocal_rank"),
        log_loss().alias("log_loss"),
        brier().alias("multiclass_brier_score"),
    ]


def category_metrics(
    frame: DataFrame, label: str, probabilities: str, classes: Classes
) -> DataFrame:
    """All ranking and probability metrics in one pass, one row."""
    return with_true_rank(frame, label, probabilities, classes).agg(*metric_columns())


def per_category_recall(
    frame: DataFrame, label: str, probabilities: str, classes: Classes
) -> DataFrame:
    """Support and recall for every class; recall is NULL where support is 0."""
    measured = (
        with_true_rank(frame, label, probabilities, classes)
        .groupBy(F.col(label).alias("category"))
        .agg(
            F.count(F.lit(1)).alias("support"),
            hit_rate(1).alias("top_1_recall"),
            hit_rate(3).alias("top_3_recall"),
        )
    )
    listed = class_table(frame.sparkSession, classes)
    return listed.join(measured, "category", "left").select(
        "category",
        F.coalesce("support", F.lit(0)).alias("support"),
        "top_1_recall",
        "top_3_recall",
    )
