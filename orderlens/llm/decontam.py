"""Benchmark decontamination by canonical templates.

Words become template tokens: numbers, units and names turn into typed placeholders (slots), all
others into their lower-case form without outer punctuation. Windows of template tokens of the
benchmark items form a hash index; documents look up each of their windows. Matching windows
of an item must fill its slots consistently: one document value for each item value of a type and
the reverse. So a question with other numbers or names is still found, and a text that only
shares a pattern is not. A document is contaminated by an item when consistent windows cover
at least ``MIN_SHARE`` of the item's tokens (and ``WINDOW`` of them, or all of a shorter item), or
``PASSAGE`` consecutive tokens of an item of any length.

The index is built for blocks of at most ``BLOCK_CHARS`` characters of benchmark text, which bounds
what is sent to the tasks; a larger benchmark is matched block by block.

A capitalised word is a name wherever it stands, so its token does not depend on the word before it.
Where an item's sentence starts, its word is indexed in both forms, as a name and as a word.

All windows are indexed by their literal values as well, so verbatim copies are always found.
Windows with more slots than words, and whole items of fewer than ``MIN_TOKENS`` tokens, say too little
as templates; they are indexed by their values only.

Edge cases: NULL or blank texts match nothing; an item of one token is found in each document with
that token; repeated items or documents are matched on their own; a NULL
id is carried; an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm import packed
from orderlens.llm.common import handing_back

WINDOW = 10
MIN_TOKENS = 5
MIN_SHARE = 0.5
PASSAGE = 13
BLOCK_CHARS = 8 << 20
OUTER = "\"'`.,;:!?()[]{}<>«»„“”‘’¿¡…-–—*_"
UNITS = frozenset(
    "mm cm m km g kg mg l ml s sec min h hr hrs mph kmh km/h hz khz mhz ghz w kw mw v kv a j kj cal kcal "
    "usd eur gbp dollars dollar euros euro cents percent inch inches foot feet mile miles yard yards "
    "pound pounds ounce ounces meter meters metre metres gram grams kilogram kilograms liter liters "
    "litre litres second seconds minute minutes hour hours day days week weeks month months year "
    "years °c °f c f kb mb gb tb".split()
)
NUMBER = re.compile(r"[+\-$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th|e[+-]?\d+)?$", re.IGNORECASE)
MAX_EITHER = 4  # sentence starts in a window up to which all mixed forms are indexed
_VOCABULARY = 1_000_000
_BITS = 22


def token_kind(word: str) -> tuple[str, str]:
    """Type (``num``, ``unit``, ``name``, ``word`` or nothing) and value of a word."""
    value = word.strip(OUTER)
    if not value:
        return "", ""
    low = value.lower()
    if NUMBER.match(low):
        return "num", low
    if low in UNITS:
        return "unit", low
    if value[0].isupper() and value[1:2].islower():
        return "name", low
    return "word", low


class Templates(dict):
    """Numbers the words it sees; their template hashes stand in arrays by number."""

    def __init__(self):
        super().__init__()
        self.template = np.zeros(1 << 12, np.uint64)
        self.literal = np.zeros(1 << 12, np.uint64)
        self.ends = np.zeros(1 << 12, bool)

    def __missing__(self, word: str) -> int:
        number = len(self)
        if number == len(self.ends):
            for name in ("template", "literal", "ends"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        kind, value = token_kind(word)
        literal = xxhash.xxh3_64_intdigest(value.encode()) if value else 0
        typed = xxhash.xxh3_64_intdigest(f"<{kind}>".encode())
        self.template[number] = literal if kind in ("word", "") else typed
        self.literal[number] = literal
        self.ends[number] = word[-1:] in ".!?:"
        self[word] = number
        return number

    def tokens(self, text: str) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Words that carry a token, hashes of template and value, and which of them are slots."""
        words = text.split()
        if len(self) > _VOCABULARY:
            self.clear()
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not len(at):
            return [], np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool)
        hashes = self.template[at]
        kept = np.flatnonzero(hashes)
        if len(kept) < len(words):
            words = [words[one] for one in kept]
        return words, hashes[kept], self.literal[at[kept]], np.isin(hashes[kept], SLOTS)

    def openers(self, text: str) -> np.ndarray:
        """Which of the tokens are words or names at the start of a sentence."""
        at = np.array([self[word] for word in text.split()], np.int64)
        starts = np.concatenate(([True], self.ends[at[:-1]]))
        hashes = self.template[at]
        either = starts & ((hashes == NAME) | ~np.isin(hashes, SLOTS))
        return either[np.flatnonzero(hashes)]


SLOTS = np.array(
    [xxhash.xxh3_64_intdigest(f"<{kind}>".encode()) for kind in ("num", "unit", "name")], np.uint64
)
NAME = SLOTS[2]


def forms(named: np.ndarray, literal: np.ndarray, either: np.ndarray) -> list[int]:
    """Hashes of a window in which each opener is a name or a word."""
    places = np.flatnonzero(either)
    out = []
    for chosen in itertools.product((False, True), repeat=len(places)):
        window = named.copy()
        window[places[list(chosen)]] = literal[places[list(chosen)]]
        out += packed.runs_of_words(window, len(window)).tolist()
    return out


class Index:
    """Template windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[object, str]]):
        templates = Templates()
        self.items = []
        # By width and whether the window is literal.
        self.windows: dict[tuple[int, bool], dict[int, list[tuple[int, int]]]] = {}
        for item_id, text in items:
            words, hashes, literals, slots = templates.tokens(text or "")
            if not len(hashes):
                continue
            width = min(WINDOW, len(hashes))
            values = [word.strip(OUTER).lower() for word in words]
            number = len(self.items)
            either = templates.openers(text)
            self.items.append((item_id, width, values, slots | either))
            named, worded = np.where(either, NAME, hashes), np.where(either, literals, hashes)
            filled = np.convolve(slots & ~either, np.ones(width, int), "valid")
            mixed = np.convolve(either, np.ones(width, int), "valid")
            runs = packed.runs_of_words(named, width).tolist()
            others = packed.runs_of_words(worded, width).tolist()
            exact = packed.runs_of_words(literals, width).tolist()
            for at, many in enumerate(filled):
                values_held = self.windows.setdefault((width, True), {})
                values_held.setdefault(exact[at], []).append((number, at))
                if width < MIN_TOKENS or 2 * many > width:
                    continue
                held = self.windows.setdefault((width, False), {})
                hashed = {runs[at], others[at]}
                if 1 < mixed[at] <= MAX_EITHER:
                    here = slice(at, at + width)
                    hashed.update(forms(named[here], literals[here], either[here]))
                for value in hashed:
                    held.setdefault(value, []).append((number, at))
        self.bitmaps = {}
        for kind, held in self.windows.items():
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[np.array(list(held), np.uint64) & np.uint64((1 << _BITS) - 1)] = True
            self.bitmaps[kind] = bitmap

    def matches(self, words: list[str], hashes: np.ndarray, literals: np.ndarray) -> list[tuple]:
        """(item, tokens, covered, changed slots, first and last word) of the contaminating items."""
        hits: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for (width, literal), held in self.windows.items():
            if len(hashes) < width:
                continue
            runs = packed.runs_of_words(literals if literal else hashes, width)
            likely = np.flatnonzero(self.bitmaps[width, literal][runs & np.uint64((1 << _BITS) - 1)])
            for place, value in zip(likely.tolist(), runs[likely].tolist()):
                for number, at in held.get(value, ()):
                    hits[number][place - at].append(at)
        found = []
        for number, shifts in hits.items():
            item_id, width, values, slots = self.items[number]
            covered, changed, places, longest = set(), 0, [], 0
            for shift, starts in shifts.items():
                forward: dict[str, str] = {}
                backward: dict[str, str] = {}
                low = high = -1
                for start in sorted(set(starts)):
                    slot_at = [at for at in range(start, start + width) if slots[at]]
                    pairs = [
                        (values[at], words[at + shift].strip(OUTER).lower()) for at in slot_at
                    ]
                    if all(
                        forward.get(a, b) == b and backward.get(b, a) == a for a, b in pairs
                    ):
                        forward.update(pairs)
                        backward.update((b, a) for a, b in pairs)
                        covered.update(range(start, start + width))
                        places.append(start + shift)
                        low, high = (low if start <= high else start), start + width
                        longest = max(longest, high - low)
                changed += sum(a != b for a, b in forward.items())
            if longest >= PASSAGE or len(covered) >= max(width, math.ceil(MIN_SHARE * len(values))):
                last = max(places) + width - 1
                found.append((item_id, len(values), len(covered), changed, min(places), last))
        return found


def _search(index: Index):
    def search(batches) -> Iterator[pd.DataFrame]:
        templates = Templates()
        columns = ["doc", "row", "item", "n_tokens", "n_covered", "n_changed", "first", "last"]
        for frame in batches:
            rows = []
            for doc, row, text in zip(frame["doc"], frame["row"], frame["text"]):
                rows += [(doc, row, *match) for match in index.matches(*templates.tokens(text)[:3])]
            yield pd.DataFrame(rows, columns=columns)

    return search


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in blocks of bounded size, in the order of a hash of the item."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, -(-2 * total // BLOCK_CHARS))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for one in range(count):
        rows = benchmark.filter(number == one).select(F.col("item_id").cast("string"), "text")
        yield [(row[0], row[1]) for row in rows.collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and contaminating item.

    doc_id, item_id, the item's tokens, the tokens covered, the slots with another value, and the
    first and last covered token of the document; ``row_key`` finds the document's row again.
    """
    row = F.concat_ws(
        "|", F.md5(F.coalesce("text", F.lit(""))), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    )
    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc"), row.alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = "doc string, row string, item string, n_tokens long, n_covered long, n_changed long, first long, last long"
    found = None
    for items in blocks(benchmark):
        part = texts.mapInPandas(handing_back(_search(Index(items))), schema)
        found = part if found is None else found.unionAll(part)
    return found.select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("item").cast(benchmark.schema["item_id"].dataType).alias("item_id"),
        "n_tokens",
        "n_covered",
        "n_changed",
        "first",
        "last",
        F.col("row").alias("row_key"),
    )


def _is_clean(index: Index):
    @handing_back
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        templates = Templates()
        for batch in texts:
            yield pd.Series(
                [not index.matches(*templates.tokens(text)[:3]) for text in batch], dtype=bool
            )

    return F.pandas_udf(clean, "boolean")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that some item contaminates.

    Only texts go to Python; nothing is shuffled and all columns stay as they are.
    """
    kept = docs
    for items in blocks(benchmark):
        kept = kept.filter(_is_clean(Index(items))(F.coalesce("text", F.lit(""))))
    return kept
