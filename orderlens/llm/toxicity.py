"""Toxicity by a chain of linear classifiers.

The categories of a chain are predicted one after the other; the model of each also reads the
probabilities of the categories before it. For training, these are out-of-fold: each row's
probability comes from a model that has not seen the row, as it will be for new documents.

Features are lower-case words and word beginnings, and whether they occur at least once, twice and
four times. They are chosen by chi-square on the training rows. Training uses at most about
``TRAIN_ROWS`` labelled documents, drawn by a hash of the id: a documented bound that does not
grow with the corpus, so models and vocabulary fit any driver. Scoring covers all documents.

A category's limit is the one with the best F1 on the out-of-fold probabilities.

Edge cases: NULL or blank text has no features; a label that is NULL, or an id with different labels,
counts as 1 if any row says 1; a category with one class only, or no labelled rows, is never
reported; repeated documents are scored alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import handing_back

TRAIN_ROWS = 8_000
FOLDS = 3
FEATURES_PER_CATEGORY = 600
PREFIXES = (4, 5, 6, 7)
LEVELS = (1, 2, 4)
MIN_ROWS = 4
MAX_ITERATIONS = 12
RIDGE = 0.002
OUTER = "\"'`.,;:!?()[]{}<>«»„“”‘’¿¡…-–—*_#$%&|"
_MEMO = 150_000
_PIECE = 20_000
_MOST_COUNTED = 100_000
_FIELD = 40


def stems(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings."""
    bare = word.strip(OUTER)
    if not bare:
        return ()
    return (f"={bare}", *[f"^{bare[:length]}" for length in PREFIXES if len(bare) >= length])


def stem_counts(text: str) -> Counter:
    out: Counter = Counter()
    for word, n in Counter(text.lower().split()).items():
        for stem in stems(word):
            out[stem] += n
    return out


def training_rows(docs: DataFrame, labels: DataFrame, categories: dict) -> DataFrame:
    """Text, fold and one 0/1 column per category of the drawn labelled documents."""
    marked = labels.groupBy("doc_id").agg(
        *[F.max(F.coalesce(rule.cast("int"), F.lit(0))).alias(name) for name, rule in categories.items()]
    )
    known = marked.filter("doc_id is not null")
    share = min(1.0, TRAIN_ROWS / max(1, known.count()))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(41), "doc_id"), 11) / F.lit(float(1 << 53))
    drawn = known.filter(draw < share).withColumnRenamed("doc_id", "_of")
    fold = F.pmod(F.xxhash64(F.lit(43), "_of"), F.lit(FOLDS)).cast("int").alias("fold")
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(drawn), F.col("doc_id") == F.col("_of"))
        .select("text", fold, *categories)
    )


def _count_features(names: list[str]):
    columns = ["stem", "level", "rows", *names]
    mask = (1 << _FIELD) - 1

    def handed(seen: dict[tuple[str, int], int]) -> Iterator[pd.DataFrame]:
        counted = iter(seen.items())
        while piece := list(islice(counted, _PIECE)):
            rows = [
                (stem, level, *(sums >> _FIELD * at & mask for at in range(len(names) + 1)))
                for (stem, level), sums in piece
            ]
            yield pd.DataFrame(rows, columns=columns)

    def count(batches) -> Iterator[pd.DataFrame]:
        # Rows and rows of each category are fields of one number; what a task holds is bounded.
        seen: dict[tuple[str, int], int] = {}
        for frame in batches:
            marks = frame[names].to_numpy()
            for text, mark in zip(frame["text"], marks):
                row = 1 + sum(int(one) << _FIELD * at for at, one in enumerate(mark, 1))
                for stem, n in stem_counts(text).items():
                    for level in LEVELS:
                        if n >= level:
                            seen[stem, level] = seen.get((stem, level), 0) + row
                if len(seen) > _MOST_COUNTED:
                    yield from handed(seen)
                    seen = {}
        yield from handed(seen)

    return count


def choose_features(rows: DataFrame, names: list[str]) -> dict[tuple[str, int], int]:
    """The features with the largest chi-square of any category, numbered."""
    sums = ", ".join(f"{name} long" for name in names)
    counts = (
        rows.mapInPandas(handing_back(_count_features(names)), f"stem string, level int, rows long, {sums}")
        .groupBy("stem", "level")
        .agg(F.sum("rows").alias("rows"), *[F.sum(name).alias(name) for name in names])
        .filter(F.col("rows") >= MIN_ROWS)
    )
    whole = rows.agg(F.count(F.lit(1)).alias("all"), *[F.sum(name).alias(name) for name in names]).first()
    chosen: set[tuple[str, int]] = set()
    for name in names:
        total, positive = float(whole["all"] or 0), float(whole[name] or 0)
        if not 0 < positive < total:
            continue
        n, k = F.col("rows"), F.col(name)
        margin = n * F.lit(total) - n * n
        square = F.lit(total) * F.pow(k * total - n * positive, 2) / (
            F.lit(positive * (total - positive)) * F.greatest(margin, F.lit(1.0))
        )
        best = counts.select("stem", "level", square.alias("square")).orderBy(
            F.desc("square"), "stem", "level"
        ).limit(FEATURES_PER_CATEGORY)
        chosen.update((row["stem"], row["level"]) for row in best.collect())
    return {feature: at for at, feature in enumerate(sorted(chosen))}


class Vocabulary:
    """Chosen features by stem, and the ones that a word can raise."""

    def __init__(self, features: dict[tuple[str, int], int]):
        self.size = len(features)
        self.levels: dict[str, list[tuple[int, int]]] = {}
        for (stem, level), at in features.items():
            self.levels.setdefault(stem, []).append((level, at))
        self.memo: dict[str, tuple[str, ...]] = {}

    def present(self, text: str) -> list[int]:
        if len(self.memo) > _MEMO:
            self.memo.clear()
        counts: Counter = Counter()
        for word, n in Counter(text.lower().split()).items():
            known = self.memo.get(word)
            if known is None:
                known = self.memo[word] = tuple(one for one in stems(word) if one in self.levels)
            for stem in known:
                counts[stem] += n
        return sorted(at for stem, n in counts.items() for level, at in self.levels[stem] if n >= level)


def _fit(rows: DataFrame, name: str) -> tuple[float, np.ndarray] | None:
    """Intercept and weights; None unless both classes occur."""
    sizes = rows.agg(F.min(name), F.max(name)).first()
    if sizes[0] == sizes[1]:
        return None
    model = LogisticRegression(
        labelCol=name, maxIter=MAX_ITERATIONS, regParam=RIDGE, standardization=False
    ).fit(rows)
    return float(model.intercept), model.coefficients.toArray()


def best_limit(scores: np.ndarray, truth: np.ndarray) -> float:
    """Probability from which a row is reported: best F1, the middle between two scores."""
    if not truth.any():
        return math.inf
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(truth[order])
    quality = 2 * hits / (np.arange(1, len(order) + 1) + truth.sum())
    at = int(np.argmax(quality))
    below = scores[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((scores[order[at]] + below) / 2)


class Chain:
    """Fitted categories in order: (name, intercept, weights, limit)."""

    def __init__(self, vocabulary: Vocabulary, links: list[tuple]):
        self.vocabulary = vocabulary
        self.links = links

    def probabilities(self, text: str) -> list[float]:
        present = self.vocabulary.present(text)
        earlier: list[float] = []
        for _, fitted, _ in self.links:
            if fitted is None:
                earlier.append(0.0)
                continue
            intercept, weights = fitted
            z = intercept + float(weights[present].sum())
            z += float(np.dot(weights[self.vocabulary.size :], earlier))
            earlier.append(1 / (1 + math.exp(-max(-700.0, min(700.0, z)))))
        return earlier


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict, stage) -> Chain:
    """Train the chain. ``categories`` maps names, in chain order, to 0/1 columns of ``labels``."""
    names = list(categories)
    texts = stage(training_rows(docs, labels, categories).coalesce(8), "toxicity-texts")
    vocabulary = Vocabulary(choose_features(texts, names))

    width = max(1, vocabulary.size)
    active = F.udf(
        lambda text: Vectors.sparse(width, [(at, 1.0) for at in vocabulary.present(text)]),
        VectorUDT(),
    )
    rows = stage(
        texts.select(F.monotonically_increasing_id().alias("row"), "fold", *names, active("text").alias("features")),
        "toxicity-rows",
    )
    links = []
    for place, name in enumerate(names):
        if not vocabulary.size:
            links.append((name, None, math.inf))
            continue
        fitted = _fit(rows, name)
        outside = [_fit(rows.filter(F.col("fold") != fold), name) for fold in range(FOLDS)]

        def chance(fold: int, features, outside=outside) -> float:
            if outside[fold] is None:
                return 0.0
            intercept, weights = outside[fold]
            z = intercept + float(features.dot(weights))
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))

        extended = F.udf(
            lambda features, p: Vectors.sparse(
                features.size + 1, np.append(features.indices, features.size), np.append(features.values, p)
            ),
            VectorUDT(),
        )
        scored = rows.withColumn("chance", F.udf(chance, "double")("fold", "features"))
        rows = stage(
            scored.withColumn("features", extended("features", "chance")), f"toxicity-rows-{place}"
        )
        pairs = rows.select("chance", name).collect()
        limit = best_limit(
            np.array([pair[0] for pair in pairs]), np.array([pair[1] for pair in pairs], np.int64)
        )
        links.append((name, fitted, limit if fitted is not None else math.inf))
    return Chain(vocabulary, links)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, ``probabilities`` in chain order, ``reported`` (names at or above their limit), ``row_key``."""
    names = [name for name, _, _ in chain.links]
    limits = [limit for _, _, limit in chain.links]

    def run(batches) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for doc, row, text in zip(frame["doc"], frame["row"], frame["text"]):
                found = chain.probabilities(text)
                above = [name for name, p, limit in zip(names, found, limits) if p >= limit]
                rows.append((doc, row, found, above))
            yield pd.DataFrame(rows, columns=["doc", "row", "probabilities", "reported"])

    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc"),
        F.md5(F.coalesce("text", F.lit(""))).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return texts.mapInPandas(
        handing_back(run), "doc string, row string, probabilities array<double>, reported array<string>"
    ).select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        "probabilities",
        "reported",
        F.col("row").alias("text_md5"),
    )


def remove_reported(docs: DataFrame, chain: Chain, reject_on: tuple[str, ...]) -> DataFrame:
    """``docs`` without those reported for one of ``reject_on``.

    Only texts go to Python; nothing is shuffled and all columns stay as they are.
    """
    checked = [(at, limit) for at, (name, _, limit) in enumerate(chain.links) if name in reject_on]

    @handing_back
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            found = [chain.probabilities(text) for text in batch]
            yield pd.Series(
                [not any(one[at] >= limit for at, limit in checked) for one in found], dtype=bool
            )

    return docs.filter(F.pandas_udf(clean, "boolean")(F.coalesce("text", F.lit(""))))
