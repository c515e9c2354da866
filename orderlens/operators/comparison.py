"""Candidates side by side, selection, and evaluation on the untouched test split."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import RunConfig
from orderlens.operators import baselines
from orderlens.operators.binary_metrics import binary_metrics
from orderlens.operators.models import (
    MODEL_NAMES,
    FittedClassifier,
    fit_classifier,
    prepare_training,
)
from orderlens.operators.ranking_metrics import category_metrics
from orderlens.operators.snapshots import feature_columns
from orderlens.scratch import stage

CATEGORY_LABEL = "next_category"
READINESS_LABEL = "purchase_within_30d"
CATEGORY_METRICS = (
    "top_1_hit_rate",
    "top_2_hit_rate",
    "top_3_hit_rate",
    "mean_reciprocal_rank",
    "log_loss",
    "multiclass_brier_score",
)
READINESS_METRICS = (
    "average_precision",
    "roc_auc",
    "brier_score",
    "log_loss",
    "recall_at_top_20pct",
    "lift_at_top_20pct",
)
TIES = ["score_date", "customer_id"]


def side_by_side(*steps: Callable) -> list:
    """Results of independent steps: the short passes of one fit leave cores that another can use."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [started.result() for started in [pool.submit(step) for step in steps]]


def _named(metrics: DataFrame, candidate: str, columns: tuple[str, ...]) -> DataFrame:
    return metrics.select(F.lit(candidate).alias("candidate"), *columns)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def category_labeled(snapshots: DataFrame) -> DataFrame:
    return snapshots.filter(F.col(CATEGORY_LABEL).isNotNull())


def with_category_baselines(train: DataFrame, rows: DataFrame, config: RunConfig) -> DataFrame:
    """Add ``popularity`` and ``last_category_blend`` arrays learned from ``train`` labels."""
    popular = baselines.popularity_vector(
        category_labeled(train), CATEGORY_LABEL, config.categories
    )
    return baselines.last_category_probabilities(
        rows.withColumn("popularity", popular),
        "popularity",
        config.categories,
        "last_category_blend",
    )


def category_baselines(train: DataFrame, rows: DataFrame, config: RunConfig) -> DataFrame:
    """Metrics of both category baselines on labeled ``rows``."""
    scored = with_category_baselines(train, category_labeled(rows), config)
    return _union(
        [
            _named(
                category_metrics(scored, CATEGORY_LABEL, column, config.categories),
                candidate,
                CATEGORY_METRICS,
            )
            for candidate, column in (
                ("popularity_baseline", "popularity"),
                ("last_category_baseline", "last_category_blend"),
            )
        ]
    )


def readiness_metrics(scored: DataFrame, candidate: str) -> DataFrame:
    metrics = binary_metrics(scored, READINESS_LABEL, "readiness", TIES)
    return _named(metrics, candidate, READINESS_METRICS)


def readiness_baseline(rows: DataFrame) -> DataFrame:
    return readiness_metrics(baselines.with_cadence_readiness(rows), "cadence_rule_baseline")


def category_metrics_of(
    model: FittedClassifier, rows: DataFrame, candidate: str, config: RunConfig
) -> DataFrame:
    scored = model.aligned(category_labeled(rows), config.categories)
    return _named(
        category_metrics(scored, CATEGORY_LABEL, "probabilities", config.categories),
        candidate,
        CATEGORY_METRICS,
    )


def readiness_metrics_of(model: FittedClassifier, rows: DataFrame, candidate: str) -> DataFrame:
    """Scores are staged first: a tree ensemble is evaluated once, not per metric."""
    scored = model.positive(rows).select(*TIES, READINESS_LABEL, "readiness")
    return readiness_metrics(stage(scored, "readiness"), candidate)


def category_comparison(train: DataFrame, validation: DataFrame, config: RunConfig) -> DataFrame:
    """One metric row per category candidate, baselines first."""
    frames = [category_baselines(train, validation, config)]
    data = prepare_training(train, feature_columns(train), CATEGORY_LABEL, binary=False)
    for name in MODEL_NAMES:
        model = fit_classifier(name, data, config)
        frames.append(category_metrics_of(model, validation, name, config))
    return stage(_union(frames), "category-comparison")


def readiness_comparison(train: DataFrame, validation: DataFrame, config: RunConfig) -> DataFrame:
    """One metric row per readiness candidate, the baseline first."""
    frames = [readiness_baseline(validation)]
    data = prepare_training(train, feature_columns(train), READINESS_LABEL, binary=True)
    for name in MODEL_NAMES:
        model = fit_classifier(name, data, config)
        frames.append(readiness_metrics_of(model, validation, name))
    return stage(_union(frames), "readiness-comparison")


def _best(comparison: DataFrame, quality: str, control: str) -> DataFrame:
    return (
        comparison.filter(F.col("candidate").isin(*MODEL_NAMES))
        .orderBy(F.col(quality).desc(), F.col(control).asc(), "candidate")
        .limit(1)
        .select("candidate")
    )


def select_category_model(comparison: DataFrame) -> DataFrame:
    """Best fitted candidate by top-3 hit rate, then log loss, then name."""
    return _best(comparison, "top_3_hit_rate", "log_loss")


def select_readiness_model(comparison: DataFrame) -> DataFrame:
    """Best fitted candidate by average precision, then Brier score, then name."""
    return _best(comparison, "average_precision", "brier_score")


def model_comparison(category: DataFrame, readiness: DataFrame) -> DataFrame:
    """Both tables in one; a metric that a task lacks is NULL."""
    return category.withColumn("task", F.lit("next_category")).unionByName(
        readiness.withColumn("task", F.lit("purchase_readiness_30d")), allowMissingColumns=True
    )
