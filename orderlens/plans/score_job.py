"""Score a supplied history: contract gate, snapshot, baselines, queue, files."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens import config as fixed
from orderlens.config import RunConfig
from orderlens.operators import activation, baselines, contract, provenance, snapshots
from orderlens.scratch import stage
from orderlens.sources import files
from orderlens.sources.files import ContractError

EVALUATION_BOUNDARY = (
    "Scores come from two rules over the supplied orders; nothing was trained on them and "
    "their quality has not been measured."
)


def checked_score_date(score_date: str | date) -> str:
    """ISO text of a plain date; a time of day or a zone is an error."""
    if isinstance(score_date, datetime):
        if score_date.tzinfo is not None or score_date.time() != datetime.min.time():
            raise ContractError("The score date is a day: a time of day or a time zone is not allowed")
        score_date = score_date.date()
    if isinstance(score_date, date):
        return score_date.isoformat()
    try:
        return date.fromisoformat(score_date).isoformat()
    except (TypeError, ValueError) as error:
        raise ContractError("The score date cannot be read as a day (YYYY-MM-DD)") from error


def split_history(transactions: DataFrame, score_date: str) -> tuple[DataFrame, DataFrame]:
    """(orders strictly before the score date, ignored orders)."""
    before = F.col("order_date") < F.lit(score_date).cast("date")
    return transactions.filter(before), transactions.filter(~before)


def class_list(history: DataFrame) -> list[str]:
    """Sorted categories of the history; they name columns, so the driver holds them."""
    names = [row[0] for row in history.select("category").distinct().orderBy("category").collect()]
    if not names:
        raise ContractError("The history is empty: every order is on or after the score date")
    if len(names) < 3:
        raise ContractError("The history has fewer than three categories")
    return names


def baseline_queue(history: DataFrame, score_date: str, config: RunConfig) -> DataFrame:
    """Queue from the cadence rule and the smoothed last category."""
    classes = config.categories
    scoring = snapshots.scoring_snapshot(history, score_date, config).select(
        *snapshots.KEYS, "last_category", "cadence_progress", "order_momentum"
    )
    popular = baselines.popularity_vector(history, "category", classes)
    scored = baselines.with_cadence_readiness(
        baselines.last_category_probabilities(
            scoring.withColumn("popularity", popular), "popularity", classes
        )
    )
    return activation.activation_queue(
        scored, "probabilities", "readiness", classes, activation.median_margins(history)
    )


def input_summary(
    transactions: DataFrame, eligible: DataFrame, score_date: str, checks_passed: int
) -> DataFrame:
    """Row counts of one scoring run; customers are counted over all rows."""
    before = F.col("order_date") < F.lit(score_date).cast("date")
    counts = transactions.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(before).alias("historical_rows"),
        F.count_if(~before).alias("ignored_on_or_after_score_date"),
    )
    customers = transactions.agg(F.count_distinct("customer_id")).scalar()
    categories = transactions.filter(before).agg(F.count_distinct("category")).scalar()
    return counts.select(
        "*",
        customers.alias("customers"),
        eligible.agg(F.count(F.lit(1))).scalar().alias("eligible_customers"),
        categories.alias("categories"),
        F.lit(checks_passed).cast("long").alias("checks_passed"),
    )


def run_metadata(
    score_date: str, fingerprint: DataFrame, manifests: DataFrame, summary: DataFrame
) -> DataFrame:
    """One nested row that identifies the run and its policy."""
    review_share = round(fixed.REVIEW_SHARE - fixed.PRIORITY_SHARE, 10)
    return summary.select(
        F.lit("supplied_input_scoring").alias("mode"),
        F.lit(contract.SCHEMA_VERSION).alias("schema_version"),
        F.lit(score_date).alias("score_date"),
        fingerprint.select(F.struct("*")).scalar().alias("input_fingerprint"),
        manifests.agg(F.sort_array(F.collect_list(F.struct("*")))).scalar().alias("provenance"),
        F.struct("*").alias("input_summary"),
        F.struct(
            F.lit("smoothed_last_category_baseline").alias("category_relevance"),
            F.lit("cadence_rule_baseline").alias("purchase_readiness"),
            F.lit(fixed.PRIORITY_SHARE).alias("priority_share"),
            F.lit(review_share).alias("review_share"),
        ).alias("policy"),
        F.lit(EVALUATION_BOUNDARY).alias("evaluation_boundary"),
    )


def score_supplied_history(
    spark: SparkSession,
    transactions_path: str,
    provenance_path: str,
    score_date: str | date,
    output_root: str,
) -> dict[str, str]:
    """Run the job and return the paths of the written tables.

    The manifest is checked before any transaction is read, and nothing is written
    unless every rule of the contract holds.
    """
    manifest = provenance.require_provenance(files.read_provenance(spark, provenance_path))
    # The text is parsed once; every check then reads only the columns it needs.
    raw = stage(files.read_transactions_csv(spark, transactions_path), "supplied")
    transactions, checks_passed = contract.require_valid(raw)
    day = checked_score_date(score_date)
    transactions = stage(transactions, "transactions")
    history, _ = split_history(transactions, day)
    config = RunConfig(categories=tuple(class_list(history)), scoring_date=day)
    queue = stage(baseline_queue(history, day, config), "queue")
    snapshots.require_rows(queue, "No customer has enough recent history to be scored")
    paths = {
        "recommendations": f"{output_root}/reports/recommendations",
        "activation_summary": f"{output_root}/reports/activation_summary",
        "run_metadata": f"{output_root}/reports/run_metadata",
    }
    files.write_csv(queue, paths["recommendations"])
    files.write_csv(activation.activation_summary(queue), paths["activation_summary"])
    metadata = run_metadata(
        day,
        contract.dataset_fingerprint(raw, raw.columns),
        manifest,
        input_summary(transactions, queue, day, checks_passed),
    )
    files.write_json(metadata, paths["run_metadata"])
    return paths
