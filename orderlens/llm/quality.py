"""Quality rules by divergence from the references of a document's language.

A document is described by three histograms: its character classes, how often it uses each of
the listed function words of its language, and how often each of the words that are the most
frequent ones in all documents of its language. The references are the same histograms over
all documents of that language. A document fails when its Jensen-Shannon distance (base 2, in
[0, 1]) to a reference is above a limit; each test applies from a minimum length on, because short
texts are far from any reference by chance. For the frequent words the limit is a share of the
distance of a document that has none of them, so such a document always fails.

Everything is built-in expressions over a document's own text, linear or n log n in its length;
word counts and references are aggregations with map-side combine.

Edge cases: NULL text counts as empty; NULL is a language of its own; a language without listed words
has no test on these, but one on its frequent words; an empty table gives an empty result; repeated rows are judged alike; other
columns are not returned.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import BREAKS, let, words

MIN_WORDS = 50
MIN_CHARS = 200
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
FREQUENT_WORDS = 24
MAX_FREQUENT_DISTANCE = 0.9  # of the distance without any frequent word
MAX_REPEAT_PERCENT = 50
SHORT_LIST = 24
# Character classes: a mark and the characters that it stands for. Blanks, bytes beyond the first
# of a character (accented letters) and the rest (lower-case letters) are counted without marks.
CLASSES = (
    ("#", "#*$%&|<>"),
    ("A", string.ascii_uppercase),
    ("0", string.digits),
    (".", ".,;:!?'\"()-"),
    ("=", "/\\=+_@{}~^`[]"),
)
# Function words whose shares make the word histogram, per language code.
COMMON_WORDS = {
    "de": ("der", "die", "und", "das", "ist", "zu", "den", "mit", "ein", "nicht", "eine", "für"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "with"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "por", "un"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}


def class_marks(text: Column) -> Column:
    """The text with marked characters replaced by their mark and lower-case letters dropped.

    One pass without regular expressions; several patterns in one task slow each other down.
    """
    marked = "".join(characters for _, characters in CLASSES)
    marks = "".join(mark * len(characters) for mark, characters in CLASSES)
    return F.translate(text, marked + string.ascii_lowercase, marks)


def _count(marks: Column, mark: str) -> Column:
    return (F.length(marks) - F.length(F.replace(marks, F.lit(mark), F.lit("")))).cast("long")


def _windows(tokens: Column, with_place: bool) -> Column:
    """Hash of every three-word window, with its place if asked for."""

    def window(word: Column, at: Column) -> Column:
        value = F.xxhash64(word, F.get(tokens, at + 1), F.get(tokens, at + 2))
        return F.struct(value.alias("hash"), at.alias("at")) if with_place else value

    return F.transform(F.slice(tokens, 1, F.greatest(F.size(tokens) - 2, F.lit(0))), window)


def _places_by_sorting(tokens: Column) -> Column:
    """Places of windows that occur twice: sorted by hash, they have an equal neighbour."""

    def repeated(ordered: Column) -> Column:
        def same(other: Column, one: Column) -> Column:
            return F.coalesce(other["hash"] == one["hash"], F.lit(False))

        found = F.filter(
            ordered,
            lambda one, at: same(F.get(ordered, at - 1), one) | same(F.get(ordered, at + 1), one),
        )
        return F.sort_array(F.transform(found, lambda one: one["at"]))

    return let(F.sort_array(_windows(tokens, True)), repeated)


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a three-word window found at least twice in the text.

    Three ways to the same places: none if all hashes differ; a search in the list of repeated
    hashes while that is short; else sorting. What is used inside a lambda is bound by ``let``, or it
    would be computed again for each element.
    """
    no_places = F.array().cast("array<int>")

    def repeats(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda one, at: one == F.get(ordered, at - 1)))

    def places_of(bound: Column, hashes: Column) -> Column:
        def listed(twice: Column) -> Column:
            marked = F.transform(
                hashes, lambda one, at: F.when(F.array_contains(twice, one), at)
            )
            return F.when(F.size(twice) <= SHORT_LIST, F.array_compact(marked)).otherwise(
                _places_by_sorting(bound)
            )

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), no_places).otherwise(
            let(let(F.sort_array(hashes), repeats), listed)
        )

    places = let(
        tokens, lambda bound: let(_windows(bound, False), lambda hashes: places_of(bound, hashes))
    )
    none = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("covered"))
    return F.aggregate(
        places,
        none,
        lambda state, at: F.struct(
            at.alias("last"),
            (state["covered"] + F.least(F.lit(3), at - state["last"])).alias("covered"),
        ),
        lambda state: state["covered"],
    )


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.trim(line, F.lit(BREAKS)) != "")
    return let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long")


def common_words(lang: Column) -> Column:
    """The listed words of a language; none for other languages."""
    listed = F.when(F.lit(False), F.array().cast("array<string>"))
    for code, some in COMMON_WORDS.items():
        listed = listed.when(lang == code, F.array(*[F.lit(word) for word in some]))
    return F.coalesce(listed, F.array().cast("array<string>"))


def spoken_words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation and digits, which part words."""
    apart = string.punctuation + string.digits
    return words(F.translate(F.lower(text), apart, " " * len(apart)))


def frequent_words(docs: DataFrame, count: int = FREQUENT_WORDS) -> DataFrame:
    """The ``count`` most frequent words of each language; a tie goes to the smaller word.

    Counts combine on the map side, and only the first ``count`` words of a language leave a
    task, so a language of most documents is no hot group.
    """
    spoken = docs.select("lang", F.explode(spoken_words(F.col("text"))).alias("word"))
    counted = spoken.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    return (
        counted.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= count)
        .groupBy(F.col("lang").alias("spoken_lang"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("top"))
        .select("spoken_lang", F.col("top")["word"].alias("frequent"))
    )


def jensen_shannon(left: Column, right: Column) -> Column:
    """Jensen-Shannon distance of two distributions given as arrays of equal length."""

    def half(one: Column, other: Column) -> Column:
        terms = F.zip_with(
            one,
            other,
            lambda p, q: F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0)),
        )
        return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)

    return F.sqrt(F.greatest(F.lit(0.0), (half(left, right) + half(right, left)) / 2))


def measures(docs: DataFrame, frequent: DataFrame) -> DataFrame:
    """Base counts and the histograms of every document, without its text.

    ``frequent`` has one row per language. Its words are compared by 64-bit hashes: looking up
    each of them in strings took most of the time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    known = docs.join(F.broadcast(frequent), F.col("lang").eqNullSafe(F.col("spoken_lang")), "left")
    split = known.select(
        "doc_id",
        "lang",
        text.alias("text"),
        words(F.col("text")).alias("words"),
        class_marks(text).alias("marks"),
        common_words(F.col("lang")).alias("common"),
        F.transform(spoken_words(F.col("text")), lambda word: F.xxhash64(word)).alias("spoken"),
        F.coalesce(
            F.transform("frequent", lambda word: F.xxhash64(word)), F.array().cast("array<bigint>")
        ).alias("frequent"),
    )
    listed = [f"listed_{at}" for at in range(max(len(some) for some in COMMON_WORDS.values()))]
    often = [f"often_{at}" for at in range(FREQUENT_WORDS)]
    counted = split.select(
        "doc_id",
        "lang",
        "common",
        "frequent",
        F.coalesce(F.size("spoken"), F.lit(0)).cast("long").alias("n_spoken"),
        F.size("words").cast("long").alias("n_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        *[_count(F.col("marks"), mark).alias(f"class_{at}") for at, (mark, _) in enumerate(CLASSES)],
        (F.octet_length("text") - F.length("text")).cast("long").alias("n_beyond"),
        *[
            (F.size("words") - F.size(F.array_remove("words", F.get("common", F.lit(at)))))
            .cast("long")
            .alias(name)
            for at, name in enumerate(listed)
        ],
        *[
            (F.size("spoken") - F.size(F.array_remove("spoken", F.get("frequent", F.lit(at)))))
            .cast("long")
            .alias(name)
            for at, name in enumerate(often)
        ],
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    blanks = F.col("n_chars") - F.col("word_chars")
    found = [F.col(f"class_{at}") for at in range(len(CLASSES))]
    known = [*found, blanks, F.col("n_beyond")]
    used = [F.when(F.size("common") > at, F.col(name)).otherwise(F.lit(0)) for at, name in enumerate(listed)]
    heard = [F.when(F.size("frequent") > at, F.col(name)).otherwise(F.lit(0)) for at, name in enumerate(often)]
    rest = F.greatest(F.lit(0), F.col("n_chars") - sum(known[1:], known[0]))
    others = F.greatest(F.lit(0), F.col("n_words") - sum(used[1:], used[0]))
    seldom = F.greatest(F.lit(0), F.col("n_spoken") - sum(heard[1:], heard[0]))
    return counted.select(
        "doc_id",
        "lang",
        "n_words",
        "n_spoken",
        "n_chars",
        "word_chars",
        found[0].alias("n_symbols"),
        "n_dup_lines",
        "n_repeat_words",
        F.array(*known, rest).alias("class_counts"),
        F.concat(F.slice(F.array(*used), 1, F.size("common")), F.array(others)).alias("word_counts"),
        F.concat(F.slice(F.array(*heard), 1, F.size("frequent")), F.array(seldom)).alias("frequent_counts"),
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)


def references(measured: DataFrame) -> DataFrame:
    """Per language, the share of each character class, listed word and frequent word in all its text."""

    def sums(name: str, length: int) -> list[Column]:
        return [F.sum(F.get(name, F.lit(at))).alias(f"{name}_{at}") for at in range(length)]

    n_classes = len(CLASSES) + 3
    n_listed = 1 + max(len(some) for some in COMMON_WORDS.values())
    held = measured.groupBy("lang").agg(
        *sums("class_counts", n_classes),
        *sums("word_counts", n_listed),
        *sums("frequent_counts", FREQUENT_WORDS + 1),
    )

    def shares(name: str, length: int) -> Column:
        parts = F.filter(F.array(*[F.col(f"{name}_{at}") for at in range(length)]), F.isnotnull)
        return let(parts, lambda all_of: F.transform(all_of, lambda n: n / F.greatest(_total(all_of), F.lit(1))))

    return held.select(
        F.col("lang").alias("of_lang"),
        shares("class_counts", n_classes).alias("class_share"),
        shares("word_counts", n_listed).alias("common_share"),
        shares("frequent_counts", FREQUENT_WORDS + 1).alias("frequent_share"),
    )


def judge(docs: DataFrame, stage) -> DataFrame:
    """One row per document: counts, ``base_failed``, the distances and ``kept``.

    ``stage`` writes a table once and returns its reader.
    """
    frequent = stage(frequent_words(docs), "quality-words")
    measured = stage(measures(docs, frequent), "quality-measures")
    known = measured.join(references(measured), F.col("lang").eqNullSafe(F.col("of_lang")), "left")

    def share(counts: str) -> Column:
        return let(
            F.col(counts),
            lambda bound: F.transform(bound, lambda n: n / F.greatest(_total(bound), F.lit(1))),
        )

    char_distance = F.when(
        F.col("n_chars") >= MIN_CHARS,
        jensen_shannon(share("class_counts"), F.col("class_share")),
    )
    word_distance = F.when(
        (F.col("n_words") >= MIN_WORDS) & (F.size("word_counts") > 1),
        jensen_shannon(share("word_counts"), F.col("common_share")),
    )
    no_frequent = F.transform(
        "frequent_counts", lambda n, at: (at == F.size("frequent_counts") - 1).cast("double")
    )
    frequent_distance = F.when(
        (F.col("n_spoken") >= MIN_WORDS) & (F.size("frequent_counts") > 1),
        jensen_shannon(share("frequent_counts"), F.col("frequent_share"))
        / jensen_shannon(no_frequent, F.col("frequent_share")),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    near = (F.coalesce(F.col("char_distance"), F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) <= MAX_WORD_DISTANCE
    ) & (F.coalesce(F.col("frequent_distance"), F.lit(0.0)) <= MAX_FREQUENT_DISTANCE)
    return (
        known.withColumn("char_distance", char_distance)
        .withColumn("word_distance", word_distance)
        .withColumn("frequent_distance", frequent_distance)
        .withColumn("base_failed", base_failed)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & near).alias("kept"),
            "char_distance",
            "word_distance",
            "frequent_distance",
        )
    )
