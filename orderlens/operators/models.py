"""Fitted models: Spark ML estimators behind two candidate names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import EARLY_STOPPING_SHARE, RunConfig
from orderlens.operators.boosting import BinnedRows, Boosting, Ensemble, spark_model
from orderlens.operators.ranking import exact_medians
from orderlens.operators.snapshots import CATEGORICAL_FEATURES
from orderlens.scratch import shared_folder, stage

MODEL_NAMES = ("logistic_regression", "gradient_boosting")
_CHECKPOINT_EVERY = 10
_FIRST_ROUNDS = 16
_FITS_AT_ONCE = 2


def numeric_names(features: list[str]) -> list[str]:
    return [name for name in features if name not in CATEGORICAL_FEATURES]


def categorical_names(features: list[str]) -> list[str]:
    return [name for name in CATEGORICAL_FEATURES if name in features]


class MedianFill(Transformer):
    """Numeric features as doubles with missing values replaced; none known means 0."""

    def __init__(self, features: list[str], medians: dict[str, float]):
        super().__init__()
        self.features = features
        self.medians = medians

    def _transform(self, dataset: DataFrame) -> DataFrame:
        missing = F.lit(None).cast("double")
        return dataset.withColumns(
            {
                f"{name}_filled": F.coalesce(
                    F.nanvl(F.col(name).cast("double"), missing),
                    F.lit(self.medians.get(name, 0.0)),
                )
                for name in numeric_names(self.features)
            }
        )


def numeric_stages(frame: DataFrame, features: list[str]) -> list:
    """Median imputation, then zero mean and unit variance, into ``numeric``."""
    names = numeric_names(features)
    return [
        MedianFill(features, exact_medians(frame, names)),
        VectorAssembler(inputCols=[f"{name}_filled" for name in names], outputCol="numeric_filled"),
        StandardScaler(
            withMean=True, withStd=True, inputCol="numeric_filled", outputCol="numeric"
        ),
    ]


def categorical_stages(features: list[str]) -> list:
    """One-hot columns into ``categorical``; an unseen value becomes all zeros.

    ``keep`` gives unseen values an extra index, and dropping the last slot removes it.
    """
    names = categorical_names(features)
    if not names:
        return []
    indexed = [f"{name}_index" for name in names]
    encoded = [f"{name}_encoded" for name in names]
    return [
        StringIndexer(
            inputCols=names,
            outputCols=indexed,
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=encoded, outputCol="categorical"),
    ]


def most_frequent_values(frame: DataFrame, features: list[str]) -> dict[str, str]:
    """Most frequent non-null value per categorical feature, ties to the smallest."""
    names = categorical_names(features)
    if not names:
        return {}
    modes = frame.agg(*[F.mode(name, True).alias(name) for name in names]).first()
    return {name: modes[name] for name in names if modes[name] is not None}


class CategoryFill(Transformer):
    """Missing categories replaced by their most frequent value.

    Filled as arrays of one value: a function over arrays keeps this projection, which the medians
    and the numeric vector join, out of a generated method too long for the JVM to compile.
    """

    def __init__(self, fills: dict[str, str]):
        super().__init__()
        self.fills = fills

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def filled(name: str, value: str) -> Column:
            known = F.transform(F.array(name), lambda one: F.coalesce(one, F.lit(value)))
            return F.get(known, F.lit(0))

        return dataset.withColumns(
            {name: filled(name, value) for name, value in self.fills.items()}
        )


def fit_preprocessing(frame: DataFrame, features: list[str]) -> PipelineModel:
    """Fitted preparation of ``features`` into one dense-or-sparse vector ``features``."""
    parts = ["numeric"] + (["categorical"] if categorical_names(features) else [])
    stages = [
        CategoryFill(most_frequent_values(frame, features)),
        *numeric_stages(frame, features),
        *categorical_stages(features),
        VectorAssembler(inputCols=parts, outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(frame)


def class_weights(frame: DataFrame, label: str) -> DataFrame:
    """(label, rows, weight) with weight = all rows / (2 * rows of the class)."""
    counts = frame.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(
        "label",
        "rows",
        (total.cast("double") / (F.lit(2.0) * F.col("rows").cast("double"))).alias("weight"),
    )


def _balance(frame: DataFrame) -> Column:
    """Balanced weight of each row from the two class counts."""
    counts = {row["label"]: row["weight"] for row in class_weights(frame, "label").collect()}
    return F.when(F.col("label") == 1.0, F.lit(counts.get(1.0, 1.0))).otherwise(
        F.lit(counts.get(0.0, 1.0))
    )


def _logistic(rows: int, binary: bool, config: RunConfig) -> LogisticRegression:
    """Balanced weights add up to the number of rows, so the penalty needs only that."""
    return LogisticRegression(
        family="binomial" if binary else "multinomial",
        maxIter=config.logistic_iterations,
        regParam=1.0 / (config.logistic_c * rows),
        elasticNetParam=0.0,
        standardization=False,
        weightCol="weight",
    )


def _boosting(rounds: int, config: RunConfig) -> GBTClassifier:
    return GBTClassifier(
        stepSize=config.boosting_rate,
        maxIter=rounds,
        maxDepth=config.boosting_depth,
        minInstancesPerNode=config.boosting_min_leaf,
        maxBins=255,
        checkpointInterval=_CHECKPOINT_EVERY,
        weightCol="weight",
        seed=config.seed,
    )


def best_round(losses: list[float], patience: int, tolerance: float) -> tuple[int, bool]:
    """Best round (from 1) by held-out loss, and whether patience ran out after it.

    A round counts as better only if its loss is lower by more than ``tolerance``.
    """
    best, at = float("inf"), 0
    for number, loss in enumerate(losses, 1):
        if loss < best - tolerance:
            best, at = loss, number
        elif number - at >= patience:
            return at, True
    return at, False


@dataclass(frozen=True)
class BoostedFit:
    """A boosted model cut at its best round, and the held-out loss of all rounds tried."""

    model: GBTClassificationModel
    losses: list[float]


def falls_steadily(losses: list[float], patience: int, tolerance: float) -> bool:
    """Whether each of the last ``patience`` rounds lowered the loss by more than ``tolerance``."""
    last = losses[-(patience + 1) :]
    return len(last) > patience and all(
        after < before - tolerance for before, after in zip(last, last[1:])
    )


def judged_rounds(losses: list[float], config: RunConfig) -> int:
    """Rounds whose loss is published: the least doubled number at which patience ran out.

    It depends on the losses alone, not on the rounds that were tried to find them.
    """
    rounds = min(_FIRST_ROUNDS, config.boosting_rounds)
    while rounds < len(losses):
        if best_round(
            losses[:rounds], config.boosting_patience, config.early_stopping_tolerance
        )[1]:
            break
        rounds = min(2 * rounds, config.boosting_rounds)
    return rounds


def _fit_boosting(rows: DataFrame, targets: list[float], config: RunConfig) -> list[BoostedFit]:
    """One boosted model per target class, each against the rest, all grown in the same passes.

    A fit stops after ``boosting_patience`` rounds without a lower held-out loss. The held-out customers
    judge every round and train none, at every size of the table. The losses are looked at after growing
    numbers of rounds, and the ensemble is cut at the best one; a fit goes on where it stopped. A loss
    that falls in every round is tried with all rounds at once, up to the doubled number at which patience
    runs out. Without held-out rows all rounds are kept.
    """
    if rows.select("held_out").distinct().count() < 2:
        rows = rows.withColumn("held_out", F.lit(False))
        first = config.boosting_rounds
    else:
        first = min(_FIRST_ROUNDS, config.boosting_rounds)
    rule = config.boosting_patience, config.early_stopping_tolerance
    settings = _boosting(first, config)
    binned = BinnedRows(rows, settings)

    def more(one: Ensemble) -> bool:
        if not one.trees:
            one.rounds = settings.getMaxIter()
            return True
        tried = len(one.trees)
        doubled = bool(one.losses) and judged_rounds(one.losses, config) == tried
        if doubled and best_round(one.losses, *rule)[1]:
            return False
        if tried >= one.rounds:
            if tried >= config.boosting_rounds:
                return False
            steady = falls_steadily(one.losses, *rule)
            rounds = config.boosting_rounds if steady else min(2 * tried, config.boosting_rounds)
            one.rounds = _boosting(rounds, config).getMaxIter()
        return True

    def grown(some: list[float]) -> list[BoostedFit]:
        boosting = Boosting(binned, some, settings)
        try:
            ensembles = boosting.grow(more)
        finally:
            boosting.close()
        return [fit(one) for one in ensembles]

    def fit(one: Ensemble) -> BoostedFit:
        kept = max(1, best_round(one.losses, *rule)[0]) if one.losses else len(one.trees)
        trees = one.trees[:kept]
        model = spark_model(rows.sparkSession, trees, binned.binning.size, settings)
        return BoostedFit(model, one.losses)

    # Classes share passes, and the passes of one part run while another part splits its nodes.
    parts = min(_FITS_AT_ONCE, len(targets))
    try:
        with ThreadPoolExecutor(parts) as pool:
            fits = list(pool.map(grown, [targets[at::parts] for at in range(parts)]))
    finally:
        binned.blocks.unpersist()
    return [fits[at % parts][at // parts] for at in range(len(targets))]


class BoostedPerClass:
    """One boosted model per class; adds their margins as the array ``margins``."""

    def __init__(self, fits: list[BoostedFit]):
        self.fits = fits

    def transform(self, frame: DataFrame) -> DataFrame:
        margins = []
        for at, fit in enumerate(self.fits):
            shown = fit.model.copy()
            shown.setRawPredictionCol(f"raw_{at}").setPredictionCol("").setProbabilityCol("")
            frame = shown.transform(frame)
            margins.append(F.element_at(vector_to_array(f"raw_{at}"), 2))
        return frame.withColumn("margins", F.array(*margins))


class FittedClassifier:
    """Preprocessing plus classifier; adds probabilities in the requested class order."""

    def __init__(self, preprocessing, model, labels: list, one_vs_rest: bool, fits: list = ()):
        self.fits = fits
        self.preprocessing = preprocessing
        self.model = model
        self.labels = labels
        self.one_vs_rest = one_vs_rest

    def _model_probabilities(self, frame: DataFrame) -> tuple[DataFrame, Column]:
        scored = self.model.transform(self.preprocessing.transform(frame))
        if self.one_vs_rest:
            # Boosted margins become probabilities by the sigmoid of twice the margin.
            return scored, F.transform("margins", lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
        return scored, vector_to_array("probability")

    def aligned(self, frame: DataFrame, classes, result: str = "probabilities") -> DataFrame:
        """Add one array in ``classes`` order: 0 for classes never seen, rows sum to 1."""
        scored, probabilities = self._model_probabilities(frame)
        scored = scored.withColumn("model_probabilities", probabilities)
        entries = [
            F.element_at("model_probabilities", self.labels.index(label) + 1)
            if label in self.labels
            else F.lit(0.0)
            for label in classes
        ]
        # The sum is taken once a row, in class order.
        total = F.aggregate("model_entries", F.lit(0.0), lambda total, entry: total + entry)
        return (
            scored.withColumn("model_entries", F.array(*entries))
            .withColumn("model_total", total)
            .select(
                *frame.columns,
                F.transform(
                    "model_entries",
                    lambda entry: F.when(
                        F.col("model_total") > 0, entry / F.col("model_total")
                    ).otherwise(0.0),
                ).alias(result),
            )
        )

    def positive(self, frame: DataFrame, result: str = "readiness") -> DataFrame:
        """Add the probability of label 1."""
        both = self.aligned(frame, [0, 1], "both")
        return both.withColumn(result, F.element_at("both", 2)).drop("both")


@dataclass(frozen=True)
class TrainingSet:
    """Prepared rows of one task: staged vectors, their labels and the preparation."""

    preprocessing: PipelineModel
    vectors: DataFrame
    labels: list
    rows: int
    binary: bool


def prepare_training(
    frame: DataFrame, features: list[str], label: str, binary: bool
) -> TrainingSet:
    """Fit the preparation on rows whose label is not null and stage the vectors once.

    Every candidate and every boosting round reads the staged vectors.
    """
    # Whole customers are held out: rows of one customer resemble each other.
    held_out = F.pmod(F.xxhash64("customer_id"), F.lit(1000)) < F.lit(
        int(1000 * EARLY_STOPPING_SHARE)
    )
    labeled = frame.filter(F.col(label).isNotNull()).select(
        *features, label, F.coalesce(held_out, F.lit(False)).alias("held_out")
    )
    preprocessing = fit_preprocessing(labeled, features)
    if binary:
        labels = [0, 1]
        position = F.col(label).cast("double")
    else:
        labels = [row[0] for row in labeled.select(label).distinct().orderBy(label).collect()]
        position = (
            F.array_position(F.array(*[F.lit(value) for value in labels]), F.col(label)) - 1
        ).cast("double")
    vectors = stage(
        preprocessing.transform(labeled).select(
            "features", position.alias("label"), "held_out"
        ),
        "vectors",
    )
    rows = vectors.count()
    weight = _balance(vectors) if binary else F.lit(1.0)
    prepared = vectors.withColumn("weight", weight)
    return TrainingSet(preprocessing, prepared, labels, rows, binary)


def fit_classifier(name: str, data: TrainingSet, config: RunConfig) -> FittedClassifier:
    """Fit one candidate."""
    if name not in MODEL_NAMES:
        raise ValueError(f"Unknown model: {name}")
    shared_folder(data.vectors.sparkSession)
    if name == "logistic_regression":
        model = _logistic(data.rows, data.binary, config).fit(data.vectors)
        return FittedClassifier(data.preprocessing, model, data.labels, one_vs_rest=False)
    if data.binary:
        fit = _fit_boosting(data.vectors, [1.0], config)[0]
        return FittedClassifier(data.preprocessing, fit.model, data.labels, False, [fit])
    targets = [float(at) for at in range(len(data.labels))]
    model = BoostedPerClass(_fit_boosting(data.vectors, targets, config))
    return FittedClassifier(data.preprocessing, model, data.labels, True, model.fits)


def boosting_rounds(model: FittedClassifier) -> list[tuple[str, int, float, int]]:
    """(class, round, held-out loss, rounds kept) of a boosted candidate."""
    classes = [str(label) for label in model.labels] if model.one_vs_rest else [str(model.labels[1])]
    return [
        (label, number, float(loss), fit.model.getNumTrees)
        for label, fit in zip(classes, model.fits)
        for number, loss in enumerate(fit.losses, 1)
    ]
