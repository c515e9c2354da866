import random
from statistics import median

from pyspark.sql import functions as F

from orderlens.operators import ranking


def test_global_rank_is_the_sorted_position(spark):
    rng = random.Random(11)
    rows = [(i, 0.5 if i % 3 == 0 else rng.random()) for i in range(5000)]
    table = spark.createDataFrame(rows, "id long, score double").repartition(7)
    ranked = ranking.global_rank(table, [F.col("score").desc(), F.col("id").asc()], "place")
    expected = {
        row[0]: place for place, row in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)
    }
    assert {r["id"]: r["place"] for r in ranked.collect()} == expected


def test_running_totals(spark):
    rows = [(i, (i * 37) % 1009) for i in range(1009)]
    table = spark.createDataFrame(rows, "n long, score long")
    totals = ranking.running_totals(table, [F.col("score").desc()], ["n"])
    expected, total = {}, 0
    for n, score in sorted(rows, key=lambda r: -r[1]):
        total += n
        expected[score] = total
    assert {r["score"]: r["cum_n"] for r in totals.collect()} == expected


def test_grouped_median_with_a_dominant_group_and_repeated_values(spark):
    rng = random.Random(12)
    rows = [("hot", 7.25)] * 2000
    rows += [("hot", round(rng.uniform(0, 50), 2)) for _ in range(3001)]
    rows += [("even", float(v)) for v in (4, 1, 3, 2)]
    rows += [("one", -3.5), ("nulls", None), ("nulls", 2.0)]
    table = spark.createDataFrame(rows, "label string, amount double").repartition(5)
    result = ranking.grouped_median(table, "label", "amount", "middle")
    expected = {}
    for label, amount in rows:
        if amount is not None:
            expected.setdefault(label, []).append(amount)
    assert {r["label"]: r["middle"] for r in result.collect()} == {
        label: median(values) for label, values in expected.items()
    }
