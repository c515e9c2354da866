import math
import random

import pytest
from pyspark.sql import functions as F

from orderlens.operators import baselines, binary_metrics, monitoring, ranking_metrics

CLASSES = ("A", "B", "C")
# True ranks 1, 2, 3 and 1.
HAND = [
    ("B", [0.2, 0.5, 0.3]),
    ("A", [0.3, 0.6, 0.1]),
    ("C", [0.5, 0.3, 0.2]),
    ("C", [0.1, 0.1, 0.8]),
]


def ranked_frame(spark, rows):
    return spark.createDataFrame(rows, "truth string, p array<double>")


def test_ranking_metrics_by_hand(spark):
    row = ranking_metrics.category_metrics(
        ranked_frame(spark, HAND), "truth", "p", CLASSES
    ).first()
    assert [row[f"top_{k}_hit_rate"] for k in (1, 2, 3)] == [0.5, 0.75, 1.0]
    assert row["mean_reciprocal_rank"] == pytest.approx((1 + 1 / 2 + 1 / 3 + 1) / 4)
    truth = (0.5, 0.3, 0.2, 0.8)
    assert row["log_loss"] == pytest.approx(-sum(map(math.log, truth)) / 4)
    squares = (0.38, 0.86, 0.98, 0.06)
    assert row["multiclass_brier_score"] == pytest.approx(sum(squares) / 4)


def test_ties_follow_the_class_list(spark):
    rows = [(name, [0.4, 0.4, 0.2]) for name in CLASSES]
    ranks = ranking_metrics.with_true_rank(ranked_frame(spark, rows), "truth", "p", CLASSES)
    assert {r["truth"]: r["true_rank"] for r in ranks.collect()} == {"A": 1, "B": 2, "C": 3}


def test_recall_lists_every_class_and_unknown_labels_fail(spark):
    rows = [("A", [0.7, 0.2, 0.1]), ("A", [0.1, 0.6, 0.3])]
    recall = ranking_metrics.per_category_recall(ranked_frame(spark, rows), "truth", "p", CLASSES)
    assert {tuple(r) for r in recall.collect()} == {
        ("A", 2, 0.5, 1.0),
        ("B", 0, None, None),
        ("C", 0, None, None),
    }
    bad = ranked_frame(spark, [("Z", [0.5, 0.3, 0.2])])
    with pytest.raises(Exception, match="outside the class list"):
        ranking_metrics.category_metrics(bad, "truth", "p", CLASSES).collect()


def expected_binary(rows):
    """rows: (y, p, tie key); textbook definitions over all pairs and thresholds."""
    n, positives = len(rows), sum(y for y, _, _ in rows)
    precision_sum = 0.0
    for threshold in {p for _, p, _ in rows}:
        above = [y for y, p, _ in rows if p >= threshold]
        gained = sum(y for y, p, _ in rows if p == threshold)
        precision_sum += gained / positives * sum(above) / len(above) if positives else 0.0
    won = sum(
        1.0 if p > q else 0.5 if p == q else 0.0
        for y, p, _ in rows
        if y
        for z, q, _ in rows
        if not z
    )
    pairs = positives * (n - positives)
    top = sorted(rows, key=lambda r: (-r[1], r[2]))[: max(1, math.ceil(0.20 * n))]
    hits = sum(y for y, _, _ in top)
    return {
        "average_precision": precision_sum,
        "roc_auc": won / pairs if pairs else None,
        "recall_at_top_20pct": hits / positives if positives else 0.0,
        "lift_at_top_20pct": hits / len(top) / (positives / n) if positives else 0.0,
        "brier_score": sum((p - y) ** 2 for y, p, _ in rows) / n,
    }


def binary(spark, rows):
    frame = spark.createDataFrame(rows, "y int, p double, k long")
    return binary_metrics.binary_metrics(frame, "y", "p", ["k"]).first().asDict()


KNOWN = list(
    zip(
        (1, 1, 0, 1, 0, 0, 0, 0),
        (0.95, 0.85, 0.75, 0.65, 0.45, 0.35, 0.25, 0.05),
        strict=True,
    )
)


@pytest.mark.parametrize("seed", range(4))
def test_binary_metrics_equal_the_definitions(spark, seed):
    rng = random.Random(seed)
    rows = [
        (int(rng.random() < 0.3), 0.5 if rng.random() < 0.4 else round(rng.random(), 2), i)
        for i in range(rng.randint(20, 200))
    ]
    actual = binary(spark, rows)
    for name, value in expected_binary(rows).items():
        assert actual[name] == pytest.approx(value, abs=1e-12), name


def test_binary_metrics_known_answers(spark):
    good = binary(spark, [(y, p, i) for i, (y, p) in enumerate(KNOWN)])
    # Positives stand at places 1, 2 and 4; one of 15 pairs is in the wrong order.
    assert good["average_precision"] == pytest.approx((1 + 1 + 3 / 4) / 3)
    assert good["roc_auc"] == pytest.approx(14 / 15)
    assert good["recall_at_top_20pct"] == pytest.approx(2 / 3)
    assert good["lift_at_top_20pct"] == pytest.approx(8 / 3)
    worse = binary(spark, [(y, 1 - p, i) for i, (y, p) in enumerate(KNOWN)])
    assert worse["average_precision"] == pytest.approx((1 / 5 + 2 / 7 + 3 / 8) / 3)
    assert worse["roc_auc"] == pytest.approx(1 / 15)


def test_one_class_only(spark):
    none = binary(spark, [(0, 0.1 * i, i) for i in range(5)])
    assert none["roc_auc"] is None
    assert none["recall_at_top_20pct"] == none["lift_at_top_20pct"] == 0.0
    every = binary(spark, [(1, 0.1 * i, i) for i in range(5)])
    assert every["roc_auc"] is None and every["average_precision"] == pytest.approx(1.0)


def test_last_category_blend(spark):
    labels = spark.createDataFrame([("A",)] * 2 + [("B",), ("B",), (None,), ("Z",)], "label string")
    base = baselines.popularity_vector(labels, "label", CLASSES)
    rows = spark.createDataFrame([("A",), ("C",), ("Z",)], "last_category string")
    scored = baselines.last_category_probabilities(rows.withColumn("base", base), "base", CLASSES)
    result = {r["last_category"]: r["probabilities"] for r in scored.collect()}
    assert result["A"] == pytest.approx([0.825, 0.175, 0.0])
    assert result["C"] == pytest.approx([0.175, 0.175, 0.65])
    assert result["Z"] == pytest.approx([0.5, 0.5, 0.0])


def test_cadence_readiness(spark):
    rows = spark.createDataFrame([(0.75, 1.0), (2.0, 9.0)], "cadence_progress double, order_momentum double")
    values = [r["readiness"] for r in baselines.with_cadence_readiness(rows).collect()]
    assert values[0] == pytest.approx(0.5)
    assert values[1] == pytest.approx(1 / (1 + math.exp(-(2.1 * 1.25 + 0.5))))


def test_calibration_bins(spark):
    rows = spark.createDataFrame([(0.05, 0), (0.05, 1), (0.95, 1), (1.0, 1)], "p double, y int")
    table = monitoring.calibration_table(rows, "y", "p")
    assert {r["bin"]: (r["snapshots"], r["observed_rate"]) for r in table.collect()} == {
        0: (2, 0.5),
        9: (2, 1.0),
    }


def test_model_gate(spark):
    table = spark.createDataFrame(
        [("base", 0.5), ("m1", 0.4), ("m2", 0.6)], "candidate string, quality double"
    )
    row = monitoring.model_gate(table, "quality", "base", ["m1", "m2"]).first()
    assert (row["best_fitted"], row["baseline"], row["improves"]) == (0.6, 0.5, True)
    assert not monitoring.model_gate(table.filter(F.col("candidate") != "m2"), "quality", "base",
                                     ["m1", "m2"]).first()["improves"]
