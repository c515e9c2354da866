import json
from datetime import datetime, timezone

import pytest
from brute_force import CLASSES, COLUMNS, random_orders
from pyspark.sql import functions as F

from orderlens.config import RunConfig
from orderlens.operators import comparison, models, snapshots
from orderlens.plans import catalog, score_job, train_job
from orderlens.sources import derived, files
from orderlens.sources.files import ContractError
from test_contract import MANIFEST

DAY = "2024-03-01"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(random_orders(21, customers=25), COLUMNS).cache()


def supply(table, tmp_path, manifest=MANIFEST):
    files.write_csv(derived.as_text(table), str(tmp_path / "transactions"))
    (tmp_path / "manifest.json").write_text(json.dumps(manifest, indent=2))
    return str(tmp_path / "transactions"), str(tmp_path / "manifest.json")


def run(spark, table, tmp_path, day=DAY, manifest=MANIFEST):
    transactions, provenance = supply(table, tmp_path, manifest)
    return score_job.score_supplied_history(
        spark, transactions, provenance, day, str(tmp_path / "out")
    )


def queue_of(spark, paths):
    return files.read_csv(spark, paths["recommendations"], files.QUEUE_SCHEMA).orderBy("queue_rank")


def test_scoring_job_end_to_end(spark, history, tmp_path):
    paths = run(spark, history, tmp_path)
    queue = queue_of(spark, paths).collect()
    eligible = snapshots.scoring_snapshot(
        history, DAY, RunConfig(categories=CLASSES)
    ).count()
    assert len(queue) == eligible > 5
    assert [r["queue_rank"] for r in queue] == list(range(1, eligible + 1))
    summary = spark.read.option("header", True).csv(paths["activation_summary"])
    assert sum(int(r["customers"]) for r in summary.collect()) == eligible
    metadata = spark.read.json(paths["run_metadata"]).first()
    counts = metadata["input_summary"]
    assert counts["input_rows"] == history.count()
    assert counts["historical_rows"] + counts["ignored_on_or_after_score_date"] == history.count()
    assert counts["eligible_customers"] == eligible
    assert counts["checks_passed"] == 22
    assert metadata["provenance"][0]["source_name"] == MANIFEST["source_name"]
    assert metadata["input_fingerprint"]["rows"] == history.count()
    text = json.dumps(metadata.asDict(recursive=True))
    for metric in ("hit_rate", "roc_auc", "average_precision", "log_loss"):
        assert metric not in text


def test_future_row_with_a_new_category_changes_nothing(spark, history, tmp_path):
    before = history.filter(F.col("order_date") < DAY)
    future = spark.createDataFrame(
        [("zz1", "c001", datetime(2024, 9, 1).date(), "Brandnew", 9.0, 1.0, 0, "web", "north")],
        COLUMNS,
    )
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir()
    second.mkdir()
    plain = run(spark, before, first)
    extended = run(spark, before.unionByName(future), second)
    assert queue_of(spark, plain).collect() == queue_of(spark, extended).collect()
    counts = spark.read.json(extended["run_metadata"]).first()["input_summary"]
    assert counts["ignored_on_or_after_score_date"] == 1


def test_gate_fails_closed(spark, history, tmp_path):
    with pytest.raises(ContractError, match="identifiers_pseudonymized"):
        run(spark, history, tmp_path, manifest=MANIFEST | {"identifiers_pseudonymized": False})
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize(
    "value",
    [
        "2024-03-01T00:00:00",
        "2024-03-01 10:00",
        "soon",
        None,
        datetime(2024, 3, 1, 5),
        datetime(2024, 3, 1, tzinfo=timezone.utc),
    ],
)
def test_score_date_must_be_a_plain_date(value):
    with pytest.raises(ContractError):
        score_job.checked_score_date(value)


def test_score_date_forms():
    assert score_job.checked_score_date(DAY) == DAY
    assert score_job.checked_score_date(datetime(2024, 3, 1)) == DAY
    assert score_job.checked_score_date(datetime(2024, 3, 1).date()) == DAY


def test_history_needs_rows_and_three_categories(history):
    empty, _ = score_job.split_history(history, "1990-01-01")
    with pytest.raises(ContractError, match="history is empty"):
        score_job.class_list(empty)
    with pytest.raises(ContractError, match="three"):
        score_job.class_list(history.filter(F.col("category").isin("Books", "Music")))


def test_class_weights(spark):
    table = spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "y int")
    assert {r["label"]: r["weight"] for r in models.class_weights(table, "y").collect()} == {
        1: 2.0,
        0: pytest.approx(8 / 12),
    }


def learnable(spark):
    rows = [
        (
            float(i % 7) if i % 11 else None,
            ("left", "right", None)[i % 3],
            int(i % 7 > 3),
            ("A", "B", "C")[i % 3] if i % 5 else None,
            f"c{i:03d}",
            datetime(2024, 1, 1 + i % 28).date(),
        )
        for i in range(400)
    ]
    return spark.createDataFrame(
        rows,
        "cadence_progress double, region string, y int, next_category string, "
        "customer_id string, score_date date",
    )


FEATURES = ["cadence_progress", "region"]


@pytest.mark.parametrize("name", models.MODEL_NAMES)
def test_fitted_models_learn_and_align(spark, name):
    table = learnable(spark)
    config = RunConfig(boosting_rounds=3, boosting_min_leaf=5, categories=("A", "B", "C"))
    ready = models.fit_classifier(name, models.prepare_training(table, FEATURES, "y", True), config)
    means = {
        r["y"]: r["p"]
        for r in ready.positive(table).groupBy("y").agg(F.avg("readiness").alias("p")).collect()
    }
    assert means[1] > means[0] + 0.1
    data = models.prepare_training(table, FEATURES, "next_category", False)
    assert data.labels == ["A", "B", "C"]
    ranked = models.fit_classifier(name, data, config).aligned(table, ["new", "C", "B", "A"])
    for row in ranked.select("probabilities").collect():
        assert row[0][0] == 0.0
        assert sum(row[0]) == pytest.approx(1.0)
    unseen = table.withColumn("region", F.lit("elsewhere"))
    assert ready.positive(unseen).filter("readiness is null").count() == 0


def test_unknown_model_name(spark):
    data = models.TrainingSet(None, None, [], 0, True)
    with pytest.raises(ValueError, match="Unknown model"):
        models.fit_classifier("forest", data, RunConfig())


def test_selection_ignores_baselines_and_breaks_ties(spark):
    lr, gb = models.MODEL_NAMES
    category = spark.createDataFrame(
        [("last_category_baseline", 0.9, 0.1), (lr, 0.5, 1.2), (gb, 0.5, 1.3)],
        "candidate string, top_3_hit_rate double, log_loss double",
    )
    assert comparison.select_category_model(category).first()[0] == lr
    readiness = spark.createDataFrame(
        [("cadence_rule_baseline", 0.9, 0.0), (lr, 0.5, 0.2), (gb, 0.5, 0.2)],
        "candidate string, average_precision double, brier_score double",
    )
    assert comparison.select_readiness_model(readiness).first()[0] == gb


def test_training_job_end_to_end(spark, tmp_path):
    table = spark.createDataFrame(random_orders(22, customers=40), COLUMNS)
    config = RunConfig(
        snapshot_start="2022-06-01",
        snapshot_end="2024-04-01",
        validation_start="2023-06-01",
        test_start="2023-12-01",
        scoring_date=DAY,
        categories=CLASSES,
        boosting_rounds=2,
        logistic_iterations=20,
    )
    listed = table.filter(F.col("category").isin(*CLASSES))
    result = train_job.run_training(listed, config)
    assert result.category_model in models.MODEL_NAMES
    assert result.readiness_model in models.MODEL_NAMES
    paths = train_job.write_training(result, config, str(tmp_path / "run"))
    table = spark.read.option("header", True).csv(paths["model_comparison"])
    assert table.count() == 7
    document = spark.read.json(paths["metrics"]).first().asDict(recursive=True)
    for task in ("category_test", "readiness_test"):
        for name, value in document[task].items():
            if name not in ("log_loss", "multiclass_brier_score", "lift_at_top_20pct"):
                assert 0.0 <= value <= 1.0, name
    assert document["selected_category_model"] == result.category_model
    by_name = {row["candidate"]: row for row in result.category_comparison.collect()}
    chosen = by_name[result.category_model]
    assert document["category_validation"] == pytest.approx(
        {name: chosen[name] for name in comparison.CATEGORY_METRICS}
    )
    assert set(document["readiness_validation"]) == set(comparison.READINESS_METRICS)
    written = spark.read.parquet(paths["snapshots"])
    assert written.count() == result.snapshots.count() == document["dataset"]["snapshots"]
    assert document["dataset"]["scoring_customers"] == result.queue.count()
    assert result.test_baselines.count() == 2
    assert result.recall.count() == len(CLASSES)


def test_labeled_snapshots_are_staged_where_they_arise(spark, history, monkeypatch):
    """No row moves to a folder of its date, and the staged rows are the computed ones."""
    config = RunConfig(
        snapshot_start="2022-06-01", snapshot_end="2024-04-01", categories=CLASSES
    )
    monkeypatch.setattr(catalog, "orders", lambda *_: history)
    monkeypatch.setattr(catalog, "RUN", config)
    monkeypatch.setattr(catalog, "_staged", {})
    staged = catalog.labeled(spark, "own rows")
    assert not any("score_date=" in path for path in staged.inputFiles())
    expected = snapshots.labeled_snapshots(history, config)
    assert staged.columns == expected.columns and not staged.isEmpty()
    assert staged.exceptAll(expected).isEmpty() and expected.exceptAll(staged).isEmpty()
