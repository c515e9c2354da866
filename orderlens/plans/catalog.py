"""Named queries over the given tables. Each takes (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.config import RunConfig
from orderlens.functions import expressions as E
from orderlens.operators import (
    activation,
    baselines,
    binary_metrics,
    comparison,
    content_scan,
    contract,
    models,
    monitoring,
    provenance,
    ranking_metrics,
    snapshots,
    splits,
)
from orderlens.plans import score_job, train_job
from orderlens.scratch import new_path, stage
from orderlens.sources import derived, files
from orderlens.sources.tables import TRANSACTION_COLUMNS, read_table, transactions

Query = Callable[[SparkSession, str], DataFrame]

# Run parameters for the dates and categories of the given tables.
RUN = RunConfig(
    snapshot_start="1997-01-01",
    snapshot_end="2001-05-01",
    validation_start="2000-01-01",
    test_start="2000-09-01",
    scoring_date="2001-06-01",
    categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
)
# A date of the labeled grid: 23 steps of 28 days after its start.
AUDIT_DATE = "1998-10-07"
SCAN_PATTERNS = {
    **content_scan.DEFAULT_PATTERNS,
    "e-mail address": "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}",
    "token assignment": "token = \"[^\"]+\"",
    "dotted quad": "\\b[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\b",
}
LABEL = comparison.CATEGORY_LABEL
BOUGHT = comparison.READINESS_LABEL
KEYS = snapshots.KEYS

_staged: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stage a table that many queries read the first time a session needs it."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _staged:
        _staged[key] = build()
    return _staged[key]


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """The transaction table, the input of every operator."""
    return _once(
        spark, folder, "orders", lambda: stage(transactions(spark, folder), "transactions")
    )


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    """The labeled snapshot table, the input of splits, models and metrics.

    It is written where its rows arise: moving every wide row to the file of its date would cost
    more than its readers save, as the training split alone takes most of the dates.
    """
    return _once(
        spark,
        folder,
        "labeled",
        lambda: stage(snapshots.labeled_snapshots(orders(spark, folder), RUN), "snapshots"),
    )


def published(frame: DataFrame) -> DataFrame:
    """Result columns in the types of the SQL check: BIGINT, DOUBLE to six decimals."""

    def shown(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return F.round(F.col(field.name), 6).alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return frame.select(*[shown(field) for field in frame.schema.fields])


def _text(spark: SparkSession, folder: str) -> DataFrame:
    return derived.dirty_text(orders(spark, folder))


def _snapshot_columns(*names: str) -> Query:
    """Selected features of the labeled grid, computed from the transactions."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return snapshots.labeled_snapshots(orders(spark, folder), RUN).select(*KEYS, *names)

    return run


def _split(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return labeled(spark, folder).filter(splits.split_of(RUN) == name)


def _validation_blend(spark: SparkSession, folder: str) -> DataFrame:
    """Category-labeled validation rows scored by the last-category baseline."""
    return comparison.with_category_baselines(
        _split(spark, folder, "train"),
        comparison.category_labeled(_split(spark, folder, "validation")),
        RUN,
    ).select(*KEYS, LABEL, "last_category", "popularity", "last_category_blend")


def _validation_readiness(spark: SparkSession, folder: str) -> DataFrame:
    """Validation rows scored by the cadence rule.

    Scores are rounded to nine decimals: the exponential of two engines may differ in
    the last bit, which would turn one threshold into two.
    """
    return baselines.with_cadence_readiness(_split(spark, folder, "validation")).select(
        *KEYS, BOUGHT, F.round("readiness", 9).alias("readiness")
    )


def _ranked(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_metrics.with_true_rank(
        _validation_blend(spark, folder), LABEL, "last_category_blend", RUN.categories
    )


def _curve(spark: SparkSession, folder: str) -> DataFrame:
    return binary_metrics.score_curve(_validation_readiness(spark, folder), BOUGHT, "readiness")


def _top_share(spark: SparkSession, folder: str) -> DataFrame:
    rows = _validation_readiness(spark, folder)
    curve = stage(binary_metrics.score_curve(rows, BOUGHT, "readiness"), "curve")
    return binary_metrics.top_share(rows, curve, BOUGHT, "readiness", comparison.TIES)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return score_job.split_history(orders(spark, folder), RUN.scoring_date)[0]


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    history = _history(spark, folder)
    scoring = snapshots.scoring_snapshot(history, RUN.scoring_date, RUN)
    popular = baselines.popularity_vector(history, "category", RUN.categories)
    return baselines.with_cadence_readiness(
        baselines.last_category_probabilities(
            scoring.withColumn("popularity", popular), "popularity", RUN.categories
        )
    ).select(*KEYS, "probabilities", "readiness")


def _queue(spark: SparkSession, folder: str) -> DataFrame:
    return score_job.baseline_queue(_history(spark, folder), RUN.scoring_date, RUN)


# --- sources, contract checks, sinks -------------------------------------------------


def scan_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "transactions-csv")
    files.write_csv(derived.as_text(orders(spark, folder)), path)
    return contract.typed(contract.cleaned(files.read_transactions_csv(spark, path)))


def contract_projection(spark: SparkSession, folder: str) -> DataFrame:
    return files.contract_projection(orders(spark, folder))


def contract_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    checked = contract.with_violations(_text(spark, folder))
    return checked.select(
        *TRANSACTION_COLUMNS, F.concat_ws(",", "violations").alias("violations")
    )


def contract_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return contract.quarantine(_text(spark, folder))[0]


def provenance_report(spark: SparkSession, folder: str) -> DataFrame:
    report = provenance.provenance_report(
        derived.manifests(read_table(spark, folder, "customer"))
    )
    return report.groupBy("position", "rule").agg(
        F.count(F.lit(1)).alias("manifests"), F.count_if(~F.col("passed")).alias("failed")
    )


def dataset_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return contract.dataset_fingerprint(
        derived.as_text(orders(spark, folder)), list(TRANSACTION_COLUMNS)
    )


def history_split(spark: SparkSession, folder: str) -> DataFrame:
    before, ignored = score_job.split_history(orders(spark, folder), RUN.scoring_date)
    sides = before.select(F.lit("history").alias("side"), "category", "order_date").unionByName(
        ignored.select(F.lit("ignored").alias("side"), "category", "order_date")
    )
    return sides.groupBy("side", "category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def input_summary(spark: SparkSession, folder: str) -> DataFrame:
    table = orders(spark, folder)
    eligible = snapshots.scoring_snapshot(table, RUN.scoring_date, RUN)
    report = contract.contract_report(derived.as_text(table))
    passed = report.filter("violations = 0").agg(F.count(F.lit(1))).scalar()
    return score_job.input_summary(table, eligible, RUN.scoring_date, passed)


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots to Parquet by score date and to CSV, both read back and summarised."""
    columns = [*KEYS, "last_category", "orders_365d", "total_margin_365d", "cadence_progress"]
    table = labeled(spark, folder).select(*columns)
    parquet, text = new_path(spark, "sink-parquet"), new_path(spark, "sink-csv")
    files.write_snapshots(table, parquet)
    files.write_csv(table, text)
    schema = (
        "customer_id string, score_date date, last_category string, orders_365d long, "
        "total_margin_365d double, cadence_progress double"
    )
    both = spark.read.schema(schema).parquet(parquet).select(
        F.lit("parquet").alias("format"), *columns
    ).unionByName(
        files.read_csv(spark, text, schema).select(F.lit("csv").alias("format"), *columns)
    )
    return both.groupBy("format", "score_date").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("orders_365d").alias("orders_365d"),
        F.sum(E.money("total_margin_365d")).cast("double").alias("total_margin_365d"),
        F.max("cadence_progress").alias("largest_progress"),
        F.count_distinct("last_category").alias("last_categories"),
    )


def run_metadata(spark: SparkSession, folder: str) -> DataFrame:
    table = orders(spark, folder)
    text = derived.as_text(table)
    manifests = provenance.provenance_fields(
        derived.manifests(read_table(spark, folder, "customer")).filter(
            F.col("file") == "manifest-1"
        )
    )
    metadata = score_job.run_metadata(
        RUN.scoring_date,
        contract.dataset_fingerprint(text, text.columns),
        manifests,
        input_summary(spark, folder),
    )
    path = new_path(spark, "run-metadata")
    files.write_json(metadata, path)
    return spark.read.schema(metadata.schema).json(path).select(
        "mode",
        "schema_version",
        "score_date",
        F.col("input_fingerprint.rows").alias("fingerprint_rows"),
        F.col("input_fingerprint.digest_sum").alias("digest_sum"),
        F.element_at("provenance.source_name", 1).alias("source_name"),
        F.col("input_summary.historical_rows").alias("historical_rows"),
        F.col("input_summary.eligible_customers").alias("eligible_customers"),
        F.col("policy.category_relevance").alias("category_relevance"),
        F.col("policy.priority_share").alias("priority_share"),
        F.col("policy.review_share").alias("review_share"),
    )


def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return train_job.dataset_summary(orders(spark, folder), labeled(spark, folder), RUN)


# --- features and labels -------------------------------------------------------------


def category_features_long(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.category_features(orders(spark, folder), RUN)


_WIDE = [
    f"{name.lower()}_{kind}"
    for name in RUN.categories
    for kind in ("orders_365d", "share_365d", "recency_days")
]


def labeled_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.labeled_snapshots(orders(spark, folder), RUN)


def scoring_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.scoring_snapshot(orders(spark, folder), RUN.scoring_date, RUN)


def leakage_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Orders from a date on are altered: neither snapshot may notice.

    The labeled grid is audited at a date in its middle, where its windows do pass over
    later orders. The control alters the orders before that date and must be noticed.
    """
    table = orders(spark, folder)
    labels = ("purchase_within_30d", "next_category", "days_to_next_purchase")

    def altered(rows) -> DataFrame:
        def changed(name: str, other) -> Column:
            return F.when(rows, other).otherwise(F.col(name))

        return table.withColumns(
            {
                "category": changed("category", F.lit("CHANGED")),
                "order_value": changed("order_value", F.col("order_value") * 7),
                "used_discount": changed("used_discount", 1 - F.col("used_discount")),
                "region": changed("region", F.lit("CHANGED")),
            }
        )

    def scoring(orders_: DataFrame) -> DataFrame:
        return snapshots.scoring_snapshot(orders_, RUN.scoring_date, RUN)

    def at_grid_date(orders_: DataFrame) -> DataFrame:
        grid = snapshots.labeled_snapshots(orders_, RUN)
        return grid.filter(F.col("score_date") == F.lit(AUDIT_DATE).cast("date")).drop(*labels)

    def from_date(day: str) -> Column:
        return F.col("order_date") >= F.lit(day).cast("date")

    cases = (
        ("scoring_future", scoring, from_date(RUN.scoring_date)),
        ("labeled_future", at_grid_date, from_date(AUDIT_DATE)),
        ("labeled_past_control", at_grid_date, ~from_date(AUDIT_DATE)),
    )
    audits = [
        splits.leakage_audit(view(table), view(altered(rows))).withColumn("audit", F.lit(name))
        for name, view, rows in cases
    ]
    return audits[0].unionByName(audits[1]).unionByName(audits[2])


def leakage_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.leakage_by_date(orders(spark, folder), RUN)


# --- baselines -----------------------------------------------------------------------


def popularity_baseline(spark: SparkSession, folder: str) -> DataFrame:
    train = comparison.category_labeled(_split(spark, folder, "train"))
    return baselines.popularity_table(train, LABEL, RUN.categories).select(
        "category", "orders", "probability"
    )


def popularity_from_history(spark: SparkSession, folder: str) -> DataFrame:
    return baselines.popularity_table(
        _history(spark, folder), "category", RUN.categories
    ).select("category", "orders", "probability")


def last_category_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return _validation_blend(spark, folder).select(
        *KEYS,
        "last_category",
        *[
            F.element_at("last_category_blend", index + 1).alias(f"p_{name.lower()}")
            for index, name in enumerate(RUN.categories)
        ],
    )


def cadence_readiness(spark: SparkSession, folder: str) -> DataFrame:
    return baselines.with_cadence_readiness(
        snapshots.labeled_snapshots(orders(spark, folder), RUN)
    ).select(*KEYS, "readiness")


# --- fitted models -------------------------------------------------------------------


def _features(spark: SparkSession, folder: str) -> list[str]:
    return snapshots.feature_columns(labeled(spark, folder))


def preprocess_numeric(spark: SparkSession, folder: str) -> DataFrame:
    """Fitted median, mean and deviation of each feature over the training rows.

    Customers whose id ends in 7 lose their values, so that imputation has work to do.
    """
    features = models.numeric_names(_features(spark, folder))
    known = ~F.col("customer_id").endswith("7")
    train = _split(spark, folder, "train").withColumns(
        {name: F.when(known, F.col(name)) for name in features}
    )
    fitted = models.fit_preprocessing(train, features)
    medians, scale = fitted.stages[1].medians, fitted.stages[3]
    rows = [
        (name, float(medians[name]), float(scale.mean[at]), float(scale.std[at]))
        for at, name in enumerate(features)
    ]
    table = spark.createDataFrame(rows, "feature string, median double, average double, deviation double")
    return table.select(
        "feature", *[F.round(name, 4).alias(name) for name in ("median", "average", "deviation")]
    )


def preprocess_categorical(spark: SparkSession, folder: str) -> DataFrame:
    """Set one-hot slots per row: one per categorical feature, none for unseen values."""
    features = models.categorical_names(_features(spark, folder))
    train = _split(spark, folder, "train")
    fitted = models.Pipeline(stages=models.categorical_stages(features)).fit(train)
    unseen = _split(spark, folder, "validation").withColumn(
        "region", F.when(F.col("region") == "ASIA", "NOWHERE").otherwise(F.col("region"))
    )
    active = F.aggregate(
        models.vector_to_array("categorical"), F.lit(0.0), lambda total, x: total + x
    )
    return (
        fitted.transform(unseen)
        .groupBy((F.col("region") == "NOWHERE").alias("has_unseen"), active.alias("active_slots"))
        .agg(F.count(F.lit(1)).alias("snapshots"))
    )


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return models.class_weights(_split(spark, folder, "train"), BOUGHT)


def _fitted(spark: SparkSession, folder: str, name: str, label: str, binary: bool):
    data = models.prepare_training(
        _split(spark, folder, "train"), _features(spark, folder), label, binary
    )
    return models.fit_classifier(name, data, RUN)


def boosting_rounds(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out loss of every boosting round tried, and the round where the ensemble is cut."""
    labeled(spark, folder)

    def rounds(task: str, label: str, binary: bool) -> list[tuple]:
        model = _fitted(spark, folder, "gradient_boosting", label, binary)
        return [(task, *row) for row in models.boosting_rounds(model)]

    category, readiness = comparison.side_by_side(
        lambda: rounds("next_category", LABEL, False),
        lambda: rounds("purchase_readiness_30d", BOUGHT, True),
    )
    rows = category + readiness
    schema = "task string, class string, round long, held_out_loss double, rounds_kept long"
    return spark.createDataFrame(rows, schema)


def _readiness_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        model = _fitted(spark, folder, name, BOUGHT, binary=True)
        return model.positive(_split(spark, folder, "validation")).select(
            *KEYS, BOUGHT, "readiness"
        )

    return run


def _category_scores(spark: SparkSession, folder: str, name: str) -> DataFrame:
    model = _fitted(spark, folder, name, LABEL, binary=False)
    rows = comparison.category_labeled(_split(spark, folder, "validation"))
    return model.aligned(rows, RUN.categories)


def _category_query(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return _category_scores(spark, folder, name).select(
            *KEYS,
            LABEL,
            *[
                F.element_at("probabilities", index + 1).alias(f"p_{c.lower()}")
                for index, c in enumerate(RUN.categories)
            ],
        )

    return run


def aligned_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    """Probabilities against a class order that also lists a class never trained on."""
    model = _fitted(spark, folder, "logistic_regression", LABEL, binary=False)
    order = ["ABSENT", *reversed(RUN.categories)]
    scored = model.aligned(_split(spark, folder, "validation"), order)
    total = F.aggregate("probabilities", F.lit(0.0), lambda acc, p: acc + p)
    return scored.select(
        *KEYS,
        F.element_at("probabilities", 1).alias("p_absent"),
        F.round(total, 6).alias("row_total"),
    )


def category_comparison_baselines(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.category_baselines(
        _split(spark, folder, "train"), _split(spark, folder, "validation"), RUN
    )


def readiness_comparison_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.readiness_metrics(
        _validation_readiness(spark, folder), "cadence_rule_baseline"
    )


def category_test_baselines(spark: SparkSession, folder: str) -> DataFrame:
    known = _split(spark, folder, "train").unionByName(_split(spark, folder, "validation"))
    return comparison.category_baselines(known, _split(spark, folder, "test"), RUN)


def _compared(spark: SparkSession, folder: str, task: str) -> DataFrame:
    """Candidate metrics of one task; the fits behind them are shared by five queries."""
    build = {
        "category": comparison.category_comparison,
        "readiness": comparison.readiness_comparison,
    }[task]
    return _once(
        spark,
        folder,
        f"{task}-comparison",
        lambda: build(_split(spark, folder, "train"), _split(spark, folder, "validation"), RUN),
    )


def _both_compared(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Candidate metrics of the category task and of the readiness task."""
    labeled(spark, folder)
    return comparison.side_by_side(
        lambda: _compared(spark, folder, "category"), lambda: _compared(spark, folder, "readiness")
    )


def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.model_comparison(*_both_compared(spark, folder))


def select_model(spark: SparkSession, folder: str) -> DataFrame:
    category, readiness = _both_compared(spark, folder)
    return (
        comparison.select_category_model(category)
        .withColumn("task", F.lit("next_category"))
        .unionByName(
            comparison.select_readiness_model(readiness).withColumn(
                "task", F.lit("purchase_readiness_30d")
            )
        )
    )


def test_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    chosen = {row["task"]: row["candidate"] for row in select_model(spark, folder).collect()}
    return train_job.evaluate_on_test(
        labeled(spark, folder), chosen["next_category"], chosen["purchase_readiness_30d"], RUN
    )[2]


def model_gates(spark: SparkSession, folder: str) -> DataFrame:
    """Does the best fitted candidate improve on the baseline of its task?"""
    by_category, by_readiness = _both_compared(spark, folder)
    category = monitoring.model_gate(
        by_category, "top_3_hit_rate", "last_category_baseline", models.MODEL_NAMES
    )
    readiness = monitoring.model_gate(
        by_readiness, "average_precision", "cadence_rule_baseline", models.MODEL_NAMES
    )
    return category.withColumn("task", F.lit("next_category")).unionByName(
        readiness.withColumn("task", F.lit("purchase_readiness_30d"))
    )


def train_job_query(spark: SparkSession, folder: str) -> DataFrame:
    result = train_job.run_training(orders(spark, folder), RUN)
    paths = train_job.write_training(result, RUN, new_path(spark, "training"))
    return files.read_csv(
        spark, paths["activation_summary"], activation_summary_schema()
    ).withColumns(
        {
            "category_model": F.lit(result.category_model),
            "readiness_model": F.lit(result.readiness_model),
        }
    )


def activation_summary_schema() -> str:
    return (
        "capacity_tier string, recommended_category string, customers long, "
        "average_readiness double, average_category_probability double, "
        "average_action_score double"
    )


# --- metrics -------------------------------------------------------------------------


def true_class_rank(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(spark, folder).select(*KEYS, LABEL, "true_rank")


def top_k_hit_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked(spark, folder).agg(
        *[ranking_metrics.hit_rate(k).alias(f"top_{k}_hit_rate") for k in (1, 2, 3)]
    )


def _ranking_metric(name: str, column: Callable[[], Column]) -> Query:
    return lambda spark, folder: _ranked(spark, folder).agg(column().alias(name))


def category_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_metrics.category_metrics(
        _validation_blend(spark, folder), LABEL, "last_category_blend", RUN.categories
    )


def per_category_recall(spark: SparkSession, folder: str) -> DataFrame:
    return ranking_metrics.per_category_recall(
        _validation_blend(spark, folder), LABEL, "last_category_blend", RUN.categories
    )


def average_precision(spark: SparkSession, folder: str) -> DataFrame:
    return _curve(spark, folder).agg(
        binary_metrics.average_precision_column().alias("average_precision")
    )


def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return _curve(spark, folder).agg(binary_metrics.roc_auc_column().alias("roc_auc"))


def binary_brier_logloss(spark: SparkSession, folder: str) -> DataFrame:
    return _validation_readiness(spark, folder).agg(
        binary_metrics.brier_column(BOUGHT, "readiness").alias("brier_score"),
        binary_metrics.log_loss_column(BOUGHT, "readiness").alias("log_loss"),
    )


def recall_at_top20(spark: SparkSession, folder: str) -> DataFrame:
    return _top_share(spark, folder).select("recall_at_top_20pct")


def lift_at_top20(spark: SparkSession, folder: str) -> DataFrame:
    return _top_share(spark, folder).select("lift_at_top_20pct")


def binary_metrics_query(spark: SparkSession, folder: str) -> DataFrame:
    return binary_metrics.binary_metrics(
        _validation_readiness(spark, folder), BOUGHT, "readiness", comparison.TIES
    )


# --- activation ----------------------------------------------------------------------


def category_median_margin(spark: SparkSession, folder: str) -> DataFrame:
    return activation.median_margins(_history(spark, folder))


def top3_categories(spark: SparkSession, folder: str) -> DataFrame:
    return activation.top_categories(
        _scored(spark, folder), "probabilities", RUN.categories
    ).select(
        *KEYS, "recommended_category", "category_probability", "second_category", "third_category"
    )


def action_score(spark: SparkSession, folder: str) -> DataFrame:
    ranked = activation.top_categories(_scored(spark, folder), "probabilities", RUN.categories)
    margins = activation.median_margins(_history(spark, folder))
    return activation.with_action_score(ranked, margins, "readiness").select(
        *KEYS,
        "recommended_category",
        "purchase_readiness_30d",
        "category_probability",
        "expected_category_margin",
        "action_score",
    )


def _queue_columns(*names: str) -> Query:
    return lambda spark, folder: _queue(spark, folder).select(*names)


def score_job_query(spark: SparkSession, folder: str) -> DataFrame:
    """The whole scoring job on files: CSV and manifest in, queue files out."""
    root = new_path(spark, "score-job")
    files.write_csv(derived.as_text(orders(spark, folder)), f"{root}/transactions")
    manifest = derived.manifests(read_table(spark, folder, "customer")).filter(
        F.col("file") == "manifest-1"
    )
    manifest.select("manifest").write.text(f"{root}/provenance")
    paths = score_job.score_supplied_history(
        spark, f"{root}/transactions", f"{root}/provenance", RUN.scoring_date, root
    )
    return files.read_csv(spark, paths["recommendations"], files.QUEUE_SCHEMA)


# --- scans and review conditions -----------------------------------------------------


def sensitive_findings(spark: SparkSession, folder: str) -> DataFrame:
    return content_scan.findings(
        read_table(spark, folder, "documents"), "text", ["doc_id"], SCAN_PATTERNS
    )


def sensitive_by_label(spark: SparkSession, folder: str) -> DataFrame:
    return content_scan.findings_by_label(
        read_table(spark, folder, "documents"), "text", ["source", "lang"], SCAN_PATTERNS
    )


def transaction_quality(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.transaction_quality(orders(spark, folder), RUN.categories)


def metrics_by_score_month(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.metrics_by_score_month(
        _validation_blend(spark, folder), LABEL, "last_category_blend", RUN.categories
    )


def readiness_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.readiness_by_score_month(
        _validation_readiness(spark, folder), BOUGHT, "readiness", comparison.TIES
    )


def quality_decline(spark: SparkSession, folder: str) -> DataFrame:
    """The decline condition for both tasks, from the published metrics of the validation months."""
    readiness = monitoring.decline_by_month(
        published(readiness_by_month(spark, folder)),
        ["average_precision", "roc_auc", "lift_at_top_20pct"],
        ["brier_score"],
    )
    category = monitoring.decline_by_month(
        published(metrics_by_score_month(spark, folder)),
        ["top_3_hit_rate", "mean_reciprocal_rank"],
        ["log_loss"],
    )
    return readiness.withColumn("task", F.lit("purchase_readiness_30d")).unionByName(
        category.withColumn("task", F.lit("next_category"))
    )


def coverage_gap(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.coverage_gap(per_category_recall(spark, folder))


def calibration_table(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.calibration_table(
        _validation_readiness(spark, folder), BOUGHT, "readiness"
    )


QUERIES: dict[str, Query] = {
    "scan_transactions": scan_transactions,
    "contract_projection": contract_projection,
    "contract_identifiers": lambda s, d: contract.identifier_issues(_text(s, d)),
    "contract_violations": lambda s, d: contract.null_counts(_text(s, d)),
    "contract_duplicate_orders": lambda s, d: contract.duplicate_orders(_text(s, d)),
    "contract_category_casefold": lambda s, d: contract.casefold_clashes(_text(s, d)),
    "contract_dates": lambda s, d: contract.date_issues(_text(s, d)),
    "contract_numerics": lambda s, d: contract.numeric_issues(_text(s, d)),
    "contract_report": lambda s, d: contract.contract_report(_text(s, d)),
    "contract_quarantine": contract_quarantine,
    "contract_accepted": contract_accepted,
    "provenance_report": provenance_report,
    "dataset_fingerprint": dataset_fingerprint,
    "history_split": history_split,
    "input_summary": input_summary,
    "sink_roundtrip": sink_roundtrip,
    "run_metadata": run_metadata,
    "dataset_summary": dataset_summary,
    "score_date_grid": lambda s, d: snapshots.score_date_grid(orders(s, d), RUN),
    "eligible_customers": _snapshot_columns(),
    "asof_last_order": _snapshot_columns(
        "acquisition_channel", "region", "last_category", "last_order_value", "last_order_margin"
    ),
    "recency_tenure": _snapshot_columns("recency_days", "customer_tenure_days"),
    "order_counts": _snapshot_columns(
        "orders_lifetime", "orders_365d", "orders_90d", "orders_30d"
    ),
    "order_momentum": _snapshot_columns("order_momentum"),
    "monetary_365d": _snapshot_columns("average_order_value_365d", "total_margin_365d"),
    "behaviour_shares": _snapshot_columns("discount_share_365d", "weekend_share_365d"),
    "category_diversity": _snapshot_columns("category_diversity_365d"),
    "favourite_category": _snapshot_columns(
        "favorite_category", "favorite_category_share_365d"
    ),
    "gap_stats": _snapshot_columns("average_gap_days", "gap_variability_days"),
    "cadence_progress": _snapshot_columns("cadence_progress"),
    "lifecycle_segment": _snapshot_columns("lifecycle_segment"),
    "calendar_features": _snapshot_columns("score_month", "score_quarter"),
    "category_features_long": category_features_long,
    "category_features_wide": _snapshot_columns(*_WIDE),
    "forward_labels": _snapshot_columns(*snapshots.LABELS),
    "labeled_snapshots": labeled_snapshots,
    "scoring_snapshot": scoring_snapshot,
    "temporal_split_counts": lambda s, d: splits.split_counts(labeled(s, d), RUN),
    "leakage_audit": leakage_audit,
    "leakage_by_date": leakage_by_date,
    "popularity_baseline": popularity_baseline,
    "popularity_from_history": popularity_from_history,
    "last_category_baseline": last_category_baseline,
    "cadence_readiness": cadence_readiness,
    "preprocess_numeric": preprocess_numeric,
    "preprocess_categorical": preprocess_categorical,
    "class_weights": class_weights,
    "readiness_lr": _readiness_query("logistic_regression"),
    "category_lr": _category_query("logistic_regression"),
    "readiness_gbt": _readiness_query("gradient_boosting"),
    "category_gbt": _category_query("gradient_boosting"),
    "boosting_rounds": boosting_rounds,
    "aligned_probabilities": aligned_probabilities,
    "category_comparison_baselines": category_comparison_baselines,
    "category_comparison": lambda s, d: _compared(s, d, "category"),
    "readiness_comparison_baseline": readiness_comparison_baseline,
    "readiness_comparison": lambda s, d: _compared(s, d, "readiness"),
    "select_model": select_model,
    "test_evaluation": test_evaluation,
    "category_test_baselines": category_test_baselines,
    "model_comparison": model_comparison,
    "model_gates": model_gates,
    "true_class_rank": true_class_rank,
    "top_k_hit_rate": top_k_hit_rate,
    "mean_reciprocal_rank": _ranking_metric(
        "mean_reciprocal_rank", ranking_metrics.reciprocal_rank
    ),
    "category_log_loss": _ranking_metric("log_loss", ranking_metrics.log_loss),
    "multiclass_brier": _ranking_metric("multiclass_brier_score", ranking_metrics.brier),
    "category_metrics": category_metrics,
    "per_category_recall": per_category_recall,
    "average_precision": average_precision,
    "roc_auc": roc_auc,
    "binary_brier_logloss": binary_brier_logloss,
    "recall_at_top20": recall_at_top20,
    "lift_at_top20": lift_at_top20,
    "binary_metrics": binary_metrics_query,
    "category_median_margin": category_median_margin,
    "top3_categories": top3_categories,
    "action_score": action_score,
    "queue_rank": _queue_columns("customer_id", "action_score", "queue_rank"),
    "capacity_tiers": _queue_columns("customer_id", "queue_rank", "capacity_tier"),
    "activation_queue": _queue,
    "activation_summary": lambda s, d: activation.activation_summary(_queue(s, d)),
    "activation_mix": lambda s, d: activation.activation_mix(_queue(s, d)),
    "priority_mix": lambda s, d: activation.priority_mix(_queue(s, d)),
    "queue_top30": lambda s, d: activation.queue_head(_queue(s, d)),
    "score_job": score_job_query,
    "train_job": train_job_query,
    "sensitive_findings": sensitive_findings,
    "sensitive_by_label": sensitive_by_label,
    "transaction_quality": transaction_quality,
    "metrics_by_score_month": metrics_by_score_month,
    "readiness_by_month": readiness_by_month,
    "quality_decline": quality_decline,
    "coverage_gap": coverage_gap,
    "priority_concentration": lambda s, d: monitoring.priority_concentration(_queue(s, d)),
    "calibration_table": calibration_table,
}


def queries() -> dict[str, Query]:
    """Every registered query with its result columns in published types."""
    return {
        name: (lambda spark, folder, run=run: published(run(spark, folder)))
        for name, run in QUERIES.items()
    }
