"""Medians by narrowing ranges, and boosting that keeps its best round."""

import os
import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.config import RunConfig
from orderlens.operators import boosting, models, ranking


@pytest.mark.parametrize("ranges", [2, 3, 512])
def test_medians_of_many_columns(spark, monkeypatch, ranges):
    monkeypatch.setattr(ranking, "_RANGES", ranges)
    dice = random.Random(3)
    columns = {
        "few": [float(dice.randrange(4)) for _ in range(300)],
        "wide": [dice.lognormvariate(0, 6) * dice.choice((-1, 1)) for _ in range(300)],
        "outlier": [1e14, *[dice.random() for _ in range(298)], -1e14],
        "split": [1.0] * 150 + [2.0] * 150,
        "same": [7.5] * 300,
        "gaps": [dice.gauss(0, 1) if dice.random() < 0.3 else None for _ in range(300)],
        "nan": [float("nan")] * 299 + [4.0],
        "none": [None] * 300,
        "two": [None] * 298 + [1.0, 4.0],
    }
    schema = ", ".join(f"{name} double" for name in columns)
    table = spark.createDataFrame(list(zip(*columns.values())), schema)
    expected = {
        name: statistics.median(x for x in values if x is not None and x == x)
        for name, values in columns.items()
        if name != "none"
    }
    assert ranking.exact_medians(table, list(columns)) == pytest.approx(expected, abs=0)
    assert ranking.exact_medians(table.limit(0), list(columns)) == {}


def test_best_round():
    assert models.best_round([], 10, 1e-7) == (0, False)
    # Round 2 is worse than round 1, and round 7 is the best.
    losses = [1.0, 1.1, 0.9, 0.95, 0.94, 0.8, 0.7] + [0.75] * 12
    assert models.best_round(losses, 10, 1e-7) == (7, True)
    assert models.best_round(losses[:16], 10, 1e-7) == (7, False)
    assert models.best_round([1.0] + [1.0 - 1e-9] * 10, 10, 1e-7) == (1, True)
    assert models.best_round([3.0, 2.0, 1.0], 10, 1e-7) == (3, False)


@pytest.fixture(scope="module")
def noisy(spark):
    """A label that follows one feature with much noise, 40 rows a customer."""
    dice = random.Random(9)
    rows = []
    for at in range(4000):
        x = dice.random()
        rows.append((x, dice.random(), int(dice.random() < 0.2 + 0.6 * (x > 0.5)), f"c{at // 40}", date(2024, 1, 1)))
    schema = "cadence_progress double, order_momentum double, y int, customer_id string, score_date date"
    return spark.createDataFrame(rows, schema)


FEATURES = ["cadence_progress", "order_momentum"]


def test_boosting_keeps_its_best_round(noisy):
    config = RunConfig(boosting_rate=0.4, boosting_min_leaf=5, boosting_rounds=60, boosting_patience=5)
    data = models.prepare_training(noisy, FEATURES, "y", True)
    held = data.vectors.filter("held_out").count()
    assert 0 < held < 0.3 * data.rows
    model = models.fit_classifier("gradient_boosting", data, config)
    curve = models.boosting_rounds(model)
    losses = [loss for _, _, loss, _ in curve]
    kept = curve[0][3]
    assert kept == models.best_round(losses, 5, config.early_stopping_tolerance)[0] < len(losses) < 60
    assert min(losses[:kept]) == losses[kept - 1] < losses[0]
    # The cut ensemble is the ensemble of a fit with so few rounds.
    shorter = models._boosting(kept, config).fit(data.vectors.filter("not held_out"))
    assert model.model.getNumTrees == shorter.getNumTrees == kept
    rows = data.vectors.limit(50)
    one, two = (
        [row["probability"][1] for row in fitted.transform(rows).select("probability").collect()]
        for fitted in (model.model, shorter)
    )
    assert one == pytest.approx(two)
    scored = model.positive(noisy)
    means = {row["high"]: row["p"] for row in scored.groupBy((F.col("cadence_progress") > 0.5).alias("high")).agg(F.avg("readiness").alias("p")).collect()}
    assert means[True] > means[False] + 0.3


def test_held_out_customers_are_whole(noisy):
    data = noisy.withColumn("y", F.col("customer_id").substr(2, 4).cast("int"))
    prepared = models.prepare_training(data, FEATURES, "y", False)
    sides = prepared.vectors.groupBy("label").agg(F.count_distinct("held_out").alias("n"))
    assert {row["n"] for row in sides.collect()} == {1}


def test_one_rule_at_every_size(noisy):
    """Few rows stop by patience as well; without held-out customers all rounds are kept."""
    config = RunConfig(boosting_rate=0.4, boosting_min_leaf=2, boosting_rounds=40, boosting_patience=3)
    few = models.prepare_training(noisy.limit(600), FEATURES, "y", True)
    assert len(models.fit_classifier("gradient_boosting", few, config).fits[0].losses) < 40
    alone = models.prepare_training(noisy.filter("customer_id = 'c1'"), FEATURES, "y", True)
    fit = models.fit_classifier("gradient_boosting", alone, RunConfig(boosting_rounds=4)).fits[0]
    assert fit.losses == [] or alone.vectors.filter("not held_out").isEmpty()
    assert fit.model.getNumTrees == 4


def test_steady_losses_go_on_with_all_rounds(spark, monkeypatch):
    """A loss that falls in every round costs one long fit, not a chain of repeats."""
    assert models.falls_steadily([5.0, 4.0, 3.0], 2, 1e-7)
    assert not models.falls_steadily([5.0, 4.0, 4.0], 2, 1e-7)
    assert not models.falls_steadily([5.0, 4.0], 2, 1e-7)
    rows = [(at % 40 / 40, 0.0, int(at % 40 >= 20), f"c{at // 40}") for at in range(2400)]
    clear = spark.createDataFrame(
        rows, "cadence_progress double, order_momentum double, y int, customer_id string"
    )
    config = RunConfig(boosting_rate=0.05, boosting_depth=2, boosting_rounds=70)
    tried = []
    real = models._boosting
    monkeypatch.setattr(models, "_boosting", lambda rounds, c: (tried.append(rounds), real(rounds, c))[1])
    data = models.prepare_training(clear, FEATURES, "y", True)
    fit = models.fit_classifier("gradient_boosting", data, config).fits[0]
    assert tried == [16, 70]
    assert len(fit.losses) == fit.model.getNumTrees == 70


def test_published_rounds_follow_from_the_losses():
    config = RunConfig(boosting_rounds=180, boosting_patience=10)
    falling = [1.0 - at / 1000 for at in range(180)]
    assert models.judged_rounds(falling, config) == 180
    assert models.judged_rounds(falling[:16], config) == 16
    # Least at round 20: patience runs out at round 30, which the second doubling covers.
    turned = falling[:20] + [2.0] * 160
    assert models.judged_rounds(turned, config) == 32
    assert models.judged_rounds(falling[:3] + [2.0] * 177, config) == 16


def longest_method(frame) -> int:
    """Bytes of the longest method that Spark generates for the plan of ``frame``."""
    debug = getattr(frame.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$")
    plan = frame._jdf.queryExecution().executedPlan()
    found = getattr(debug, "MODULE$").codegenStringSeq(plan)
    return max([found.apply(at)._3().maxMethodCodeSize() for at in range(found.size())], default=0)


def test_preparation_and_scores_are_compiled(spark):
    """Methods beyond 8,000 bytes are interpreted by the JVM, many times slower."""
    names = [f"x{at}" for at in range(40)]
    dice = random.Random(4)
    rows = [
        (*[dice.choice((None, dice.random())) for _ in names], dice.choice((None, "A", "B")), *"RSTU", f"c{at}", at % 3)
        for at in range(60)
    ]
    schema = ", ".join(f"{name} double" for name in names)
    kinds = list(models.CATEGORICAL_FEATURES)
    schema += ", " + ", ".join(f"{name} string" for name in kinds) + ", customer_id string, y int"
    table = spark.createDataFrame(rows, schema)
    path = models.stage(table, "wide")
    prepared = models.fit_preprocessing(path, names + kinds).transform(path)
    assert 0 < longest_method(prepared.select("features")) <= 8000
    filled = {row["customer_id"]: row[kinds[0]] for row in prepared.collect()}
    mode = models.most_frequent_values(table, kinds)[kinds[0]]
    assert filled == {row[-2]: row[40] or mode for row in rows}
    data = models.prepare_training(path, names + kinds, "y", False)
    model = models.fit_classifier("logistic_regression", data, RunConfig(logistic_iterations=5))
    scored = model.aligned(path, [9, 2, 1, 0])
    assert 0 < longest_method(scored) <= 8000
    raw = {row["customer_id"]: list(row["probability"]) for row in model.model.transform(prepared).collect()}
    for row in scored.collect():
        assert row["probabilities"] == pytest.approx([0.0, *reversed(raw[row["customer_id"]])], abs=1e-12)


def test_only_open_columns_are_read_again(spark, monkeypatch):
    """A median that is found leaves the later passes."""
    read = []
    explode = ranking.F.explode

    def counted(column):
        read.append(str(column._jc.toString()).count("AS value"))
        return explode(column)

    monkeypatch.setattr(ranking.F, "explode", counted)
    monkeypatch.setattr(ranking, "_RANGES", 4)
    dice = random.Random(5)
    rows = [(float(at % 2), dice.random()) for at in range(301)]
    found = ranking.exact_medians(spark.createDataFrame(rows, "few double, many double"), ["few", "many"])
    assert found == {"few": 0.0, "many": statistics.median(value for _, value in rows)}
    assert read[0] == 2 and len(read) > 1 and read[-1] == 1


def trees_of(model) -> list[tuple[str, ...]]:
    """Splits of a boosted model, and its leaves to six digits."""
    lines = [line.strip() for line in model.toDebugString.split("\n")[1:] if line.strip()]
    return [f"{float(line.split(': ')[1]):.6f}" if "Predict" in line else line for line in lines]


def test_classes_grow_together_as_sparks_trees(spark, monkeypatch):
    """Fits of all classes share their passes, go on where they stopped, and are those of Spark."""
    monkeypatch.setattr(boosting, "_BLOCK_ROWS", 100)
    passes = []
    run = boosting.Boosting._run
    monkeypatch.setattr(boosting.Boosting, "_run", lambda self, *work: (passes.append(work), run(self, *work))[1])
    monkeypatch.setattr(models, "_FITS_AT_ONCE", 1)
    dice = random.Random(21)
    rows = []
    for at in range(3000):
        x, z, kind = dice.random(), dice.choice((None, dice.gauss(0, 1))), dice.choice("RST")
        score = x + (0.4 if kind == "R" else 0.0) + dice.random()
        rows.append((x, z, kind, "low" if score < 0.8 else "mid" if score < 1.4 else "top", f"c{at // 20}"))
    table = spark.createDataFrame(
        rows, "cadence_progress double, order_momentum double, region string, y string, customer_id string"
    )
    config = RunConfig(boosting_rate=0.2, boosting_depth=3, boosting_min_leaf=20, boosting_rounds=20, boosting_patience=20)
    data = models.prepare_training(table, [*FEATURES, "region"], "y", False)
    # Weights by class count in the trees and in the loss.
    weighted = data.vectors.withColumn("weight", F.when(F.col("label") == 0.0, 2.5).otherwise(0.75))
    fits = models._fit_boosting(weighted, [0.0, 1.0, 2.0], config)
    # Sixteen rounds, then the rest: a level of all classes is one pass, and the last losses are one more.
    assert len(passes) == 20 * 3 + 1
    for at, fit in enumerate(fits):
        one = weighted.withColumn("label", (F.col("label") == float(at)).cast("double"))
        plain = models._boosting(20, config).fit(one.filter("not held_out"))
        losses = plain.evaluateEachIteration(one.filter("held_out"))
        assert fit.losses == pytest.approx(losses, abs=1e-7)
        kept = fit.model.getNumTrees
        assert kept == models.best_round(losses, 20, config.early_stopping_tolerance)[0]
        text = trees_of(plain)
        assert trees_of(fit.model) == (text[: text.index(f"Tree {kept} (weight 0.2):")] if kept < 20 else text)
    # Folders of saved trees and of margins are gone.
    folder = boosting.new_path(spark, "x").rpartition("/")[0]
    assert not [name for name in os.listdir(folder) if name.startswith("trees-")]
