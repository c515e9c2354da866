from datetime import date, timedelta

import pytest
from brute_force import (
    CLASSES,
    COLUMNS,
    assert_snapshots,
    labeled_snapshots,
    random_orders,
    scoring_snapshot,
)
from pyspark.sql import functions as F

from orderlens.config import RunConfig
from orderlens.operators import snapshots, splits

CONFIG = RunConfig(
    snapshot_start="2022-06-01",
    snapshot_end="2024-06-01",
    validation_start="2023-06-01",
    test_start="2024-01-01",
    scoring_date="2024-03-01",
    categories=CLASSES,
)


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 400)])
def test_labeled_snapshots_equal_brute_force(spark, seed, hot):
    rows = random_orders(seed, hot=hot)
    expected = labeled_snapshots(rows, date(2022, 6, 1), date(2024, 6, 1))
    assert len(expected) > 100
    assert_snapshots(snapshots.labeled_snapshots(frame(spark, rows), CONFIG), expected)


def test_scoring_snapshot_equals_brute_force(spark):
    rows = random_orders(3, hot=300)
    day = date(2024, 3, 1)
    assert_snapshots(
        snapshots.scoring_snapshot(frame(spark, rows), "2024-03-01", CONFIG),
        scoring_snapshot(rows, day),
    )


def order(number, customer, day, category="Books"):
    return (f"x{number:04d}", customer, day, category, 10.0, 2.0, 0, "web", "north")


def test_boundaries(spark):
    day = date(2024, 3, 1)

    def ago(n):
        return day - timedelta(days=n)

    plans = {
        "kept365": [500, 450, 365],
        "gone366": [500, 450, 366],
        "two": [20, 10],
        "three": [30, 20, 10],
        "sameday": [40, 40, 40],
        "on_the_day": [30, 20, 10, 0],
        "eight_gaps": [10 * n for n in range(1, 10)],
        "nine_gaps": [10 * n for n in range(1, 11)],
        "busy_day": [200, 100] + [50] * 12,
        "edge_windows": [365, 91, 90, 31, 30],
    }
    rows = []
    for customer, offsets in plans.items():
        for offset in offsets:
            rows.append(order(len(rows), customer, ago(offset), CLASSES[len(rows) % 4]))
    result = snapshots.scoring_snapshot(frame(spark, rows), "2024-03-01", CONFIG)
    expected = scoring_snapshot(rows, day)
    assert {c for c, _ in expected} == set(plans) - {"gone366", "two"}
    assert_snapshots(result, expected)


def test_label_horizons(spark):
    config = RunConfig(
        snapshot_start="2024-03-01", snapshot_end="2024-03-01", categories=CLASSES
    )
    day = date(2024, 3, 1)
    rows = []
    for days in (0, 30, 31, 60, 61, 200):
        for back in (30, 20, 10):
            rows.append(order(len(rows), f"n{days:03d}", day - timedelta(days=back)))
        rows.append(order(len(rows), f"n{days:03d}", day + timedelta(days=days), "Music"))
    for back in (30, 20, 10):
        rows.append(order(len(rows), "never", day - timedelta(days=back)))
    result = {
        r["customer_id"]: (r["purchase_within_30d"], r["next_category"], r["days_to_next_purchase"])
        for r in snapshots.labeled_snapshots(frame(spark, rows), config).collect()
    }
    assert result == {
        "n000": (1, "Music", 0),
        "n030": (1, "Music", 30),
        "n031": (0, "Music", 31),
        "n060": (0, "Music", 60),
        "n061": (0, None, None),
        "n200": (0, None, None),
        "never": (0, None, None),
    }


def test_favourite_tie_goes_to_the_earlier_first_order(spark):
    day = date(2024, 3, 1)
    rows = [
        order(1, "c", day - timedelta(days=40), "Tools"),
        order(2, "c", day - timedelta(days=30), "Books"),
        order(3, "c", day - timedelta(days=20), "Books"),
        order(4, "c", day - timedelta(days=10), "Tools"),
    ]
    row = snapshots.scoring_snapshot(frame(spark, rows), "2024-03-01", CONFIG).first()
    assert row["favorite_category"] == "Tools"


def test_future_orders_leave_the_snapshot_unchanged(spark):
    rows = random_orders(5)
    table = frame(spark, rows)
    changed = table.withColumn(
        "category",
        F.when(F.col("order_date") >= "2024-03-01", "Other").otherwise(F.col("category")),
    )
    audit = splits.leakage_audit(
        snapshots.scoring_snapshot(table, "2024-03-01", CONFIG),
        snapshots.scoring_snapshot(changed, "2024-03-01", CONFIG),
    ).first()
    assert (audit["vanished_rows"], audit["new_rows"]) == (0, 0)
    touched = table.withColumn("region", F.lit("moved"))
    audit = splits.leakage_audit(
        snapshots.scoring_snapshot(table, "2024-03-01", CONFIG),
        snapshots.scoring_snapshot(touched, "2024-03-01", CONFIG),
    ).first()
    assert audit["vanished_rows"] == audit["new_rows"] > 0


def test_order_id_is_optional_and_other_columns_are_not(spark):
    rows = random_orders(6, customers=4)
    table = frame(spark, rows)
    with_id = snapshots.scoring_snapshot(table, "2024-03-01", CONFIG)
    without = snapshots.scoring_snapshot(table.drop("order_id"), "2024-03-01", CONFIG)
    assert without.count() == with_id.count()
    with pytest.raises(ValueError, match="region"):
        snapshots.scoring_snapshot(table.drop("region"), "2024-03-01", CONFIG)


def test_two_exchanges_and_no_cross_join(spark, tmp_path):
    path = str(tmp_path / "orders")
    frame(spark, random_orders(7)).write.parquet(path)
    table = spark.read.parquet(path)
    result = snapshots.labeled_snapshots(table, CONFIG)
    plan = result._jdf.queryExecution().executedPlan().toString()
    main = "\n".join(
        line for line in plan.splitlines() if "SinglePartition" not in line
    )
    assert main.count("Exchange hashpartitioning") == 2
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "SortMergeJoin" not in plan


def test_split_counts_and_empty_split(spark):
    rows = random_orders(8)
    labeled = snapshots.labeled_snapshots(frame(spark, rows), CONFIG)
    counts = {r["split"]: r["snapshots"] for r in splits.split_counts(labeled, CONFIG).collect()}
    assert set(counts) == {"train", "validation", "test"}
    assert sum(counts.values()) == labeled.count()
    parts = splits.split_by_time(labeled, CONFIG)
    assert [p.count() for p in parts] == [counts[n] for n in ("train", "validation", "test")]
    late = RunConfig(validation_start="2030-01-01", test_start="2031-01-01", categories=CLASSES)
    with pytest.raises(RuntimeError):
        splits.split_by_time(labeled, late)
    purged = RunConfig(
        validation_start="2023-06-01", test_start="2024-01-01", purge_days=60, categories=CLASSES
    )
    kept = splits.split_by_time(labeled, purged)
    assert kept[0].count() < parts[0].count()
    assert kept[2].count() == parts[2].count()


WINDOW_ENDS = {"state_breaches": ("_LAST_ROW", 1), "year_breaches": ("_LAST_DAY", "40 FOLLOWING")}


def test_lineage_finds_a_broken_window_at_each_date(spark, monkeypatch):
    orders = spark.createDataFrame(random_orders(31, customers=60), COLUMNS)
    config = RunConfig(snapshot_start="2022-06-01", snapshot_end="2024-04-01", categories=CLASSES)
    sound = snapshots.leakage_by_date(orders, config).collect()
    grid = {r["score_date"] for r in snapshots.labeled_snapshots(orders, config).select("score_date").distinct().collect()}
    kinds = ("state_breaches", "gap_breaches", "year_breaches", "label_breaches")
    assert {r["score_date"] for r in sound} == grid and len(grid) > 10
    assert all(r[kind] == 0 for r in sound for kind in kinds)
    assert all(r["latest_read"] < r["score_date"] for r in sound)
    for kind, (name, end) in WINDOW_ENDS.items():
        with monkeypatch.context() as patch:
            patch.setattr(snapshots, name, end)
            broken = snapshots.leakage_by_date(orders, config).collect()
        assert {r["score_date"] for r in broken if r[kind] > 0} == grid, kind


def test_each_category_is_searched_once_per_snapshot(spark):
    """Three features of a category share one search of the categories bought."""
    config = RunConfig(
        snapshot_start="2024-01-01", snapshot_end="2024-06-01", categories=("Books", "Garden", "It's")
    )
    day = date(2024, 1, 5)
    rows = [
        order(number, "c", day + timedelta(days=9 * number), ("Books", "It's", None)[number % 3])
        for number in range(12)
    ]
    table = snapshots.labeled_snapshots(frame(spark, rows), config)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_position(") == len(config.categories)
    last = table.orderBy(F.col("score_date").desc()).first()
    assert last["garden_orders_365d"] == 0 and last["garden_recency_days"] == 400
    assert last["it's_orders_365d"] == sum(
        row[3] == "It's" and row[2] < last["score_date"] for row in rows
    )
    assert last["it's_recency_days"] < 60 and 0 < last["books_share_365d"] < 1
