"""Repair of the turn order of conversations by weighted CYK parsing.

The roles of a conversation should read ``(s?(ua)+)?``: an optional system turn, then pairs of user and
assistant. Edits make it so: Keep (0), Rerole to user or assistant (1), Delete (2, forced for blank
and repeated turns), Insert an empty turn (5); a truncated turn that stays costs 5 more.

The grammar is in Chomsky normal form. Its symbols name what a span of turns can become, by first and
last role (``UA`` is ``(ua)+``, ``AU`` is ``(au)+``, ``UU``, ``AA`` in between; ``S``, ``SU``, ``SA`` begin with the
system turn; ``N`` is nothing, all turns deleted). A cell holds the least (cost, audit) of each symbol
over its span; cells are closed under insertions at both ends and combined bottom-up by span
length over every split. Equal costs over one span never have audits of which one begins the other
(each further letter would be an insertion that costs), so the least audits of two
neighbours join to the least audit.

A conversation is cut into parts of ``PART`` turns, each parsed to the cell of its whole span. The cells
of up to ``PART`` neighbouring parts are the leaves of the next parse, until one cell is left, so no
task holds more than ``PART`` leaves however long a conversation is. The order of turns inside a
conversation is a window over narrow rows; the repaired turns stream in order through the task
of their conversation, one batch at a time.

Edge cases: a NULL role or text is one space; NULL turn numbers come first; turns with equal numbers
are ordered by role, then by a digest of the text; rows without a conversation id form one
conversation (NULL); a conversation without turns has zeros and an empty audit; repeated rows are duplicates;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from orderlens.llm.common import BREAKS

PART = 32
MEMO = 50_000
RECORD = 1_000
RETAIN, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL_PAIRS = ("su", "ua", "au")
WHOLE = ("N", "UA", "SA")
COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "new_turns")

Cell = dict[str, tuple[int, str]]


def _joins() -> dict[str, dict[str, str]]:
    """Right-hand sides of the grammar: the symbol that a left and a right neighbour make."""
    table: dict[str, dict[str, str]] = {"N": {"N": "N"}, "S": {"N": "S", "UU": "SU", "UA": "SA"}}
    table["N"]["S"] = "S"
    for first in "USA":
        for last in "UA":
            symbol = first + last
            table["N"][symbol] = symbol
            follower = "A" if last == "U" else "U"
            table[symbol] = {"N": symbol, follower + "U": first + "U", follower + "A": first + "A"}
    return table


JOINS = _joins()


def _offer(cell: Cell, symbol: str, cost: int, audit: str) -> bool:
    known = cell.get(symbol)
    if known is None or (cost, audit) < known:
        cell[symbol] = (cost, audit)
        return True
    return False


def close(cell: Cell) -> Cell:
    """Add what insertions before or after the span make, until nothing gets cheaper."""
    waiting = list(cell)
    while waiting:
        symbol = waiting.pop()
        cost, audit = cell[symbol]
        cost += INSERT
        if symbol == "N":
            found = [("UU", "I" + audit), ("AA", "I" + audit), ("UU", audit + "I"), ("AA", audit + "I")]
        elif symbol == "S":
            found = [("SU", audit + "I")]
        else:
            first, last = symbol
            found = [(first + ("A" if last == "U" else "U"), audit + "I")]
            if first != "S":
                found.append((("A" if first == "U" else "U") + last, "I" + audit))
        for made, text in found:
            if _offer(cell, made, cost, text):
                waiting.append(made)
    return cell


def leaf(mark: str) -> Cell:
    """The cell of one turn: its role class, a capital if truncated, ``x`` if it must go."""
    cell: Cell = {"N": (DELETE, "D")}
    if mark != "x":
        extra = TRUNCATED if mark.isupper() else 0
        for symbol in ("UU", "AA"):
            _offer(cell, symbol, REROLE + extra, "R")
        own = {"s": "S", "u": "UU", "a": "AA"}.get(mark.lower())
        if own:
            _offer(cell, own, RETAIN + extra, "K")
    return close(cell)


def parse(leaves: list[Cell]) -> Cell:
    """The cell of the whole span, bottom-up by span length."""
    count = len(leaves)
    row = leaves
    # by_end[j][i] is the cell of the span that starts at i and ends before j.
    starts = [{at + 1: cell} for at, cell in enumerate(row)]
    for length in range(2, count + 1):
        for at in range(count - length + 1):
            end = at + length
            cell: Cell = {}
            for middle in range(at + 1, end):
                right = starts[middle][end]
                for symbol, (cost, audit) in starts[at][middle].items():
                    joins = JOINS[symbol]
                    for other, (more, tail) in right.items():
                        made = joins.get(other)
                        if made is None:
                            continue
                        total = cost + more
                        known = cell.get(made)
                        if known is None or total < known[0]:
                            cell[made] = (total, audit + tail)
                        elif total == known[0] and audit + tail < known[1]:
                            cell[made] = (total, audit + tail)
            starts[at][end] = close(cell)
    return starts[0][count]


def _remembered(of_text, texts: pd.Series, memo: dict[str, str]) -> pd.Series:
    out = []
    for text in texts:
        known = memo.get(text)
        if known is None:
            known = of_text(text)
            if len(memo) >= MEMO:
                memo.clear()
            memo[text] = known
        out.append(known)
    return pd.Series(out, dtype="object")


@F.pandas_udf(StringType())
def _cell_of_marks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    leaves = {mark: leaf(mark) for mark in "suaoSUAOx"}
    memo: dict[str, str] = {}
    for marks in batches:
        yield _remembered(
            lambda text: json.dumps(parse([leaves[mark] for mark in text])), marks, memo
        )


@F.pandas_udf(StringType())
def _cell_of_cells(cells: pd.Series) -> pd.Series:
    return pd.Series(
        [json.dumps(parse([_read(cell) for cell in one])) for one in cells], dtype="object"
    )


def _read(cell: str) -> Cell:
    return {symbol: tuple(value) for symbol, value in json.loads(cell).items()}


@F.pandas_udf(StructType().add("cost", LongType()).add("audit", StringType()))
def _best(cells: pd.Series) -> pd.DataFrame:
    found = []
    for text in cells:
        cell = _read(text)
        found.append(min(cell[symbol] for symbol in WHOLE if symbol in cell))
    return pd.DataFrame(found, columns=["cost", "audit"])


def plain_turns(turns: DataFrame) -> DataFrame:
    """The four columns without NULL roles and texts, and a digest that stands for role and text."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    keyed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.substring(F.sha2(keyed, 256), 1, 32)).alias("digest"),
    )


def _in_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def faults(turns: DataFrame) -> DataFrame:
    """Narrow rows in their order: position, the first fault of each, and its mark for the parse."""
    bare = F.rtrim(F.col("text"), F.lit(BREAKS))
    narrow = plain_turns(turns).select(
        "conv_id",
        "turn",
        "role",
        "digest",
        F.substring("role", 1, 1).alias("initial"),
        (F.length(bare) == 0).alias("is_blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("is_cut"),
    )
    same = Window.partitionBy("conv_id", "digest").orderBy(F.col("turn").asc_nulls_first())
    seen = narrow.withColumn("copy", F.row_number().over(same))
    order = Window.partitionBy("conv_id").orderBy(*_in_order(), "copy")
    former = F.lag("initial").over(order)
    former_turn = F.lag("turn").over(order)
    blank = F.col("is_blank")
    duplicate = ~blank & (F.col("copy") > 1)
    cut = ~blank & ~duplicate & F.col("is_cut")
    own = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("o"))
    return seen.select(
        "conv_id",
        "turn",
        (F.row_number().over(order) - 1).cast("long").alias("place"),
        blank.alias("blank"),
        duplicate.alias("duplicate"),
        cut.alias("truncated"),
        (~F.concat(former, F.col("initial")).isin(*LEGAL_PAIRS)).alias("illegal"),
        (F.col("turn").isNotNull() & ~former_turn.eqNullSafe(F.col("turn"))).alias("new_turns"),
        F.when(blank | duplicate, F.lit("x"))
        .when(cut, F.upper(own))
        .otherwise(own)
        .alias("mark"),
    )


def parsed(turns: DataFrame, stage) -> DataFrame:
    """One row per conversation that has turns: its counts and the cell of its whole span."""
    part = F.floor(F.col("place") / PART).cast("long")
    marks = F.sort_array(F.collect_list(F.struct("place", "mark")))
    spans = (
        faults(turns)
        .groupBy("conv_id", part.alias("part"))
        .agg(
            F.array_join(F.transform(marks, lambda one: one["mark"]), "").alias("marks"),
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(F.coalesce(F.col(name).cast("long"), F.lit(0))).alias(name) for name in COUNTS[1:]],
            F.min("turn").alias("first_turn"),
            F.max("turn").alias("last_turn"),
        )
    )
    spans = stage(spans.withColumn("cell", _cell_of_marks("marks")).drop("marks"), "repair-spans")
    last = spans.agg(F.max("part")).first()[0] or 0
    while last > 0:
        cells = F.sort_array(F.collect_list(F.struct("part", "cell")))
        grouped = spans.groupBy("conv_id", F.floor(F.col("part") / PART).cast("long").alias("above")).agg(
            F.transform(cells, lambda one: one["cell"]).alias("cells"),
            *[F.sum(name).alias(name) for name in COUNTS],
            F.min("first_turn").alias("first_turn"),
            F.max("last_turn").alias("last_turn"),
        )
        spans = stage(
            grouped.withColumn("cell", _cell_of_cells("cells"))
            .drop("cells")
            .withColumnRenamed("above", "part"),
            "repair-spans",
        )
        last //= PART
    return spans.drop("part")


def summaries(turns: DataFrame, ids: DataFrame, stage) -> DataFrame:
    """One row per conversation of ``ids`` (column ``conv_id``): faults, cost and audit."""
    spans = parsed(turns, stage).withColumnRenamed("conv_id", "of_conv")
    spread = F.col("last_turn") - F.col("first_turn") + 1 - F.col("new_turns")
    judged = spans.withColumn("best", _best("cell")).select(
        "of_conv",
        spread.alias("gaps"),
        *COUNTS[1:5],
        F.col("best.cost").alias("cost"),
        F.col("best.audit").alias("audit"),
    )
    known = ids.select("conv_id").distinct()
    joined = known.join(judged, known["conv_id"].eqNullSafe(judged["of_conv"]), "left")
    numbers = ("gaps", *COUNTS[1:5], "cost")
    return joined.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
    )


REPAIRED = "conv_id long, place long, edit string, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow the audit of each conversation along its turns; the audit's row comes first."""
    names = ["conv_id", "place", "edit", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []
    held = 0
    conv, letters, at, place, expected = None, "", 0, 0, "user"

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def emit(edit: str, role: str, text: str) -> None:
        nonlocal place, expected, held
        out.append((conv, place, edit, role, text))
        held += len(text)
        place += 1
        if role[:1] != "s":
            expected = "assistant" if expected == "user" else "user"

    def insert() -> None:
        nonlocal at
        while at < len(letters) and letters[at] == "I":
            at += 1
            emit("I", expected, "")

    for block in batches:
        columns = (block.column(name).to_pylist() for name in ("conv_id", "audit", "role", "text"))
        for of_conv, audit, role, text in zip(*columns):
            if audit is not None:
                conv, letters, at, place, expected = of_conv, audit, 0, 0, "user"
                insert()
            else:
                edit = letters[at]
                at += 1
                if edit != "D":
                    emit(edit, expected if edit == "R" else role, text)
                insert()
            if len(out) >= RECORD or held > 1 << 22:
                yield batch()
                out.clear()
                held = 0
    if out:
        yield batch()


def repaired_turns(turns: DataFrame, summary: DataFrame) -> DataFrame:
    """The turns that stay, rewritten, and the inserted ones, in order (``place`` from 0).

    Partitions hold whole conversations in order, so a consumer can stream them.
    """
    missing = F.lit(None)
    heads = summary.select(
        "conv_id",
        "audit",
        missing.cast("long").alias("turn"),
        missing.cast("string").alias("role"),
        missing.cast("binary").alias("digest"),
        missing.cast("string").alias("text"),
    )
    rows = plain_turns(turns).withColumn("audit", missing.cast("string"))
    ordered = (
        heads.unionByName(rows)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), *_in_order())
    )
    return ordered.select("conv_id", "audit", "role", "text").mapInArrow(_apply, REPAIRED)


def _hash_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    done: list[tuple] = []
    conv, state = None, None
    for block in batches:
        columns = (block.column(name).to_pylist() for name in ("conv_id", "role", "text"))
        for of_conv, role, text in zip(*columns):
            piece = f"{role}:{text}".encode()
            if state is not None and of_conv == conv:
                state.update(b"\n" + piece)
                continue
            if state is not None:
                done.append((conv, state.hexdigest()))
            conv, state = of_conv, hashlib.sha256(piece)
        if done:
            yield _digest_batch(done)
            done = []
    if state is not None:
        yield _digest_batch([*done, (conv, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    ids, digests = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(digests, pa.string())], ["of_conv", "digest"]
    )


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of ``role:text`` lines of each conversation; reads the order of ``repaired_turns``."""
    return repaired.mapInArrow(_hash_turns, "of_conv long, digest string")
