"""Token counts by byte-pair merging with a heap over a linked list of symbols.

A text starts as one symbol per character. The adjacent pair whose join has the lowest rank in the
vocabulary merges first, the leftmost among equal ranks, until no pair is left. Each merge takes one
symbol away, so the count is the number of first symbols minus the number of merges; no identifier
is made. A character that the vocabulary lacks stays as its UTF-8 bytes, each a symbol of its own.

Characters that no piece joins with others, and places before a word mark inside which no piece
reaches, cut the text into runs that merge on their own. A task remembers the counts of the runs it
has seen, at most ``MEMO_RUNS`` of them of at most ``MEMO_LENGTH`` characters; forgetting costs
time only. A run without any cut, however long, is merged whole in n log n steps.

Edge cases: a NULL or empty text has no bytes and no tokens; white space is text like any other;
special strings inside a text are ordinary text, as the library has them; repeated rows are counted
alike; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEMO_RUNS = 400_000
MEMO_LENGTH = 64


def count_after_merges(symbols: list[str], ranks: dict[str, int]) -> int:
    """Symbols that are left once no adjacent pair joins to a ranked piece."""
    count = len(symbols)
    piece = list(symbols)
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    heap = []
    for at in range(count - 1):
        joined = piece[at] + piece[at + 1]
        rank = ranks.get(joined)
        if rank is not None:
            heap.append((rank, at, joined))
    heapify(heap)
    end = count
    while heap:
        _, at, joined = heappop(heap)
        taken = after[at]
        # A pair is stale once one of its symbols has merged with another.
        if piece[at] is None or taken >= end or piece[at] + piece[taken] != joined:
            continue
        piece[at] = joined
        piece[taken] = None
        following = after[taken]
        after[at] = following
        count -= 1
        if following < end:
            before[following] = at
            wider = joined + piece[following]
            rank = ranks.get(wider)
            if rank is not None:
                heappush(heap, (rank, at, wider))
        earlier = before[at]
        if earlier >= 0:
            wider = piece[earlier] + joined
            rank = ranks.get(wider)
            if rank is not None:
                heappush(heap, (rank, earlier, wider))
    return count


class PieceCounter:
    """Counts the tokens of texts by the ranks of a vocabulary; the file travels as bytes."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        score = {}
        for number in range(self.model.get_piece_size()):
            special = (
                self.model.is_control(number)
                or self.model.is_unknown(number)
                or self.model.is_byte(number)
                or self.model.is_unused(number)
            )
            if not special:
                score[self.model.id_to_piece(number)] = self.model.get_score(number)
        order = {value: rank for rank, value in enumerate(sorted(set(score.values()), reverse=True))}
        self.ranks = {piece: order[value] for piece, value in score.items() if len(piece) > 1}
        singles = {piece for piece in score if len(piece) == 1}
        joining = set().union(*self.ranks) if self.ranks else set()
        self.unknown = re.compile(f"[^{_class(singles | joining)}]")
        self.runs = re.compile(_run_pattern(joining, self.ranks))
        self.memo: dict[str, int] = {}

    def count(self, text: str) -> int:
        plain = self.model.normalize(text)
        total = len(plain)
        for run, times in Counter(self.runs.findall(plain)).items():
            total -= self._merges(run) * times
        for character in self.unknown.findall(plain):
            total += len(character.encode()) - 1
        return total

    def _merges(self, run: str) -> int:
        if len(run) == 1:
            return 0
        known = self.memo.get(run)
        if known is None:
            known = len(run) - count_after_merges(list(run), self.ranks)
            if len(run) <= MEMO_LENGTH:
                if len(self.memo) >= MEMO_RUNS:
                    self.memo.clear()
                self.memo[run] = known
        return known


def _class(characters: set[str]) -> str:
    return "".join(map(re.escape, sorted(characters))) or r"\0"


def _run_pattern(joining: set[str], pieces) -> str:
    """Runs of joining characters, cut before a word mark if no piece has one inside."""
    mark = "▁"
    if mark in joining and not any(mark in piece.lstrip(mark) for piece in pieces):
        rest = _class(joining - {mark})
        return f"{mark}+[{rest}]*|[{rest}]+"
    return f"[{_class(joining)}]+"


def token_count(text: Column, model_path: str) -> Column:
    """The number of tokens of a text; the vocabulary is read once here, on the driver."""
    with open(model_path, "rb") as file:
        model = file.read()

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = PieceCounter(model)
        for texts in batches:
            yield pd.Series([counter.count(one) for one in texts], dtype="int64")

    return counted(F.coalesce(text, F.lit("")))


def token_counts(docs: DataFrame, model_path: str, limit: int) -> DataFrame:
    """One row per document: bytes, tokens, and whether the tokens exceed ``limit``."""
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    counted = docs.select(
        "doc_id", n_bytes.alias("n_bytes"), token_count(F.col("text"), model_path).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
