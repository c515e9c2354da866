"""Repair, prefix trie and token counts against brute force written another way."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlens.llm import bpe_counts, prefix_trie, queries, repair
from orderlens.scratch import stage

SCHEMA = "conv_id long, turn long, role string, text string, place long, audit string, n_rows int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sample_conversations():
    """Repairs of every kind, NULLs, ties, repeated rows, a long conversation and shared beginnings."""
    rows = []
    roles = ["system", "user", "assistant"]
    for conv in range(90):
        if conv % 20 == 7:
            continue
        for turn in range(1 + conv * 7 % 9):
            role = roles[0] if turn == 0 and conv % 3 == 0 else roles[1 + (turn + conv // 13) % 2]
            text = f"turn {turn % 3} of {conv % 4}" + ("." if (turn + conv) % 5 else "")
            rows.append((conv, turn * (1 + conv % 2), role, text))
    rows += [(500, turn, roles[1 + turn * 5 // 3 % 2], f"n{turn}{'.?!,'[turn % 4]}") for turn in range(150)]
    rows += [(501, 0, "user", "x " * 20000 + "."), (501, 1, "assistant", "y.")]
    rows += [(502, None, None, None), (502, None, "user", ""), (502, 3, "tool", "z!"), (502, 9, "", "?")]
    rows += [(503, 2, "user", "same."), (503, 2, "user", "same."), (503, 2, "user", "same.")]
    rows += [(504, None, "assistant", "é."), (505, None, None, " \t")]
    rows += [(conv, 0, "user", "alone.") for conv in range(600, 760)]
    rows += [(None, 0, "user", "no id."), (None, 1, "assistant", "none.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "k", 2) for row in rows], SCHEMA)


def in_folder(spark, tmp_path, name, made):
    made.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def damaged_rows(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        key = ":".join(" " if value is None else str(value) for value in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        kept = out[conv]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)

    def order(row):
        turn, role, text = row
        keyed = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        return (turn is not None, turn or 0, role, keyed)

    return {conv: sorted(kept, key=order) for conv, kept in out.items()}


def state_after(state, initial):
    """States of ``(s?(ua)+)?``: 0 start, 1 after s, 2 after u, 3 after a (accepted, as is 0)."""
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, initial))


def best_by_states(kinds):
    """Least (cost, audit) by a pass over the turns with one entry per state of the automaton."""

    def insertions(entries):
        entries = dict(entries)
        for _ in range(4):
            for state, (cost, audit) in list(entries.items()):
                for initial in "ua":
                    after = state_after(state, initial)
                    if after is not None:
                        offer = (cost + 5, audit + "I")
                        entries[after] = min(entries.get(after, offer), offer)
        return entries

    entries = insertions({0: (0, "")})
    for initial, must_go, cut in kinds:
        new = {}

        def put(state, cost, audit):
            if state is not None:
                new[state] = min(new.get(state, (cost, audit)), (cost, audit))

        for state, (cost, audit) in entries.items():
            put(state, cost + 2, audit + "D")
            if not must_go:
                put(state_after(state, initial), cost + 5 * cut, audit + "K")
                for other in "ua":
                    put(state_after(state, other), cost + 1 + 5 * cut, audit + "R")
        entries = insertions(new)
    return min(entries[state] for state in (0, 3) if state in entries)


def expected_repair(kept):
    seen, kinds, counts = set(), [], [0, 0, 0]
    for _, role, text in kept:
        last = WORD.findall(text)
        blank = not last
        again = (role, text) in seen and not blank
        cut = not blank and not again and last[-1][-1] not in ".!?"
        seen.add((role, text))
        kinds.append((role[:1], blank or again, cut))
        counts = [count + flag for count, flag in zip(counts, (blank, again, cut))]
    illegal = sum(
        (one[0] + two[0]) not in ("su", "ua", "au") for one, two in itertools.pairwise(kinds)
    )
    numbers = [turn for turn, _, _ in kept if turn is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit = best_by_states(kinds)
    lines, left, next_role = [], iter(kept), "user"
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter == "D":
            continue
        role = role if letter == "K" else next_role
        lines.append(f"{role}:{text}")
        if role[:1] != "s":
            next_role = "assistant" if next_role == "user" else "user"
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest)


def test_repair_matches_brute_force(spark, tmp_path):
    rows = sample_conversations()
    folder = in_folder(spark, tmp_path, "conversations", frame(spark, rows))
    got = {row[0]: tuple(row[1:]) for row in queries.op11_cyk_repair(spark, folder).collect()}
    kept = damaged_rows(rows)
    assert set(got) == set(kept)
    for conv, left in kept.items():
        assert got[conv] == expected_repair(left), conv
    assert any(not left for left in kept.values())


def test_repair_of_nothing(spark, tmp_path):
    folder = in_folder(spark, tmp_path, "conversations", frame(spark, []))
    assert queries.op11_cyk_repair(spark, folder).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="suaoSUAOx", max_size=24))
def test_parse_finds_the_least_repair(marks):
    kinds = [(mark.lower(), mark == "x", mark.isupper()) for mark in marks]
    leaves = [repair.leaf(mark) for mark in marks]
    if leaves:
        cell = repair.parse(leaves)
        assert min(cell[name] for name in repair.WHOLE if name in cell) == best_by_states(kinds)
        # Any cut into parts gives the same cell.
        for size in (1, 3):
            parts = [repair.parse(leaves[at : at + size]) for at in range(0, len(leaves), size)]
            assert repair.parse(parts) == cell


def test_short_sequences_against_all_edits():
    """All edits of all sequences of up to three turns, with at most two insertions per gap."""
    for count in range(1, 4):
        for marks in itertools.product("suoUx", repeat=count):
            best = None
            choices = [
                [("D", "", 2)]
                if mark == "x"
                else [("D", "", 2), ("R", "u", 1 + 5 * mark.isupper()), ("R", "a", 1 + 5 * mark.isupper())]
                + ([("K", mark.lower(), 5 * mark.isupper())])
                for mark in marks
            ]
            gaps = [[("", "", 0), ("I", "u", 5), ("I", "a", 5), ("II", "ua", 10), ("II", "au", 10)]] * (count + 1)
            slots = [gaps[0]]
            for choice in choices:
                slots += [choice, gaps[0]]
            for pick in itertools.product(*slots):
                if re.fullmatch("(s?(ua)+)?", "".join(one[1] for one in pick)):
                    found = (sum(one[2] for one in pick), "".join(one[0] for one in pick))
                    best = min(best or found, found)
            cell = repair.parse([repair.leaf(mark) for mark in marks])
            assert min(cell[name] for name in repair.WHOLE if name in cell) == best, marks


def test_repaired_turns_alternate(spark):
    turns = frame(spark, sample_conversations())
    summary = repair.summaries(turns, turns, stage)
    found = defaultdict(list)
    for row in repair.repaired_turns(turns, summary).collect():
        found[row["conv_id"]].append((row["place"], row["role"], row["edit"]))
    for turns_of in found.values():
        assert [place for place, _, _ in turns_of] == list(range(len(turns_of)))
        assert re.fullmatch("s?(ua)+", "".join(role[:1] for _, role, _ in turns_of))
    assert len(found[500]) > 2 * repair.PART


def expected_nodes(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            keyed = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[: prefix_trie.KEY]
            turns[conv].append(((turn is not None, turn or 0, keyed), (role, text)))
    original = {conv: [one for _, one in sorted(found)] for conv, found in turns.items()}
    built = {}
    for conv, own in original.items():
        kept = zlib.crc32(str(conv).encode()) % 4
        built[conv] = tuple(original.get(conv - conv % 20, [])[:kept] + own[kept:])
    members = defaultdict(list)
    for conv, path in built.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    out = []
    for node, convs in members.items():
        depth = len(node)
        below = [other for other in members if other[:depth] == node]
        parents = {other[:-1] for other in below if other}
        ends = sorted(conv for conv in convs if len(built[conv]) == depth)
        saved = sum(
            (len(members[other]) - 1) * len(WORD.findall(other[-1][1])) for other in below if other
        )
        out.append(
            (
                min(convs),
                depth,
                min(members[node[:-1]]) if node else None,
                len(convs),
                sum(len(other) == depth + 1 for other in below),
                sum(other not in parents for other in below),
                saved,
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_nodes", [prefix_trie.SHARD_NODES, 60, 4, 1])
def test_trie_matches_brute_force(spark, tmp_path, monkeypatch, shard_nodes):
    rows = sample_conversations()
    # Copies, one conversation that begins others, and a deep chain that others share in part.
    rows += [(conv, turn, "user", f"copy {turn}") for conv in range(1000, 1030) for turn in range(4)]
    rows += [(conv, turn, "user", f"step {turn}") for conv in range(1100, 1106) for turn in range(40 + conv % 7)]
    monkeypatch.setattr(prefix_trie.trie_nodes, "__defaults__", (shard_nodes,))
    folder = in_folder(spark, tmp_path, "conversations", frame(spark, rows))
    got = sorted(map(tuple, queries.op12_parentheses_trie(spark, folder).collect()), key=str)
    assert got == expected_nodes(rows)


def test_trie_of_nothing(spark, tmp_path):
    folder = in_folder(spark, tmp_path, "conversations", frame(spark, []))
    assert queries.op12_parentheses_trie(spark, folder).count() == 0


@pytest.mark.parametrize("bias", [-0.5, 0.0, 0.3, 3.0])
def test_closing_parentheses(bias):
    """Random trees, wide and deep enough for many levels of block minima."""
    dice = random.Random(5)
    opens, way = [True], 0
    for _ in range(6000):
        depth = max(1, min(way + 1, way + 1 - int(dice.expovariate(1.0) - bias)))
        opens += [False] * (way - depth + 1) + [True]
        way = depth
    opens += [False] * (way + 1)
    waiting, expected = [], {}
    for at, is_open in enumerate(opens):
        if is_open:
            waiting.append(at)
        else:
            expected[waiting.pop()] = at
    string = prefix_trie.Parentheses(prefix_trie.np.array(opens))
    at = prefix_trie.np.flatnonzero(opens)
    assert string.find_close(at).tolist() == [expected[one] for one in at.tolist()]


@pytest.fixture(scope="module")
def model():
    return public_tokenizers.path(queries.TOKENIZER)


ODD_TEXTS = [
    None,
    "",
    " ",
    "  two  spaces \t tab\nline\r\n",
    "<s>special</s> <unk> <0x0A> ▁mark▁▁",
    "naïve Straße 漢字かな\U0001f600 é 　\x00",
    "same words same words same words",
    "same words same words same words",
    "nospaceatall" * 4000,
    "a" * 5000 + " " * 5000,
    "word " * 6000,
]


def test_counts_match_the_library(spark, tmp_path, model):
    rows = [(at, text, "en", "web", 7, 1, 2) for at, text in enumerate(ODD_TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens int, n_bytes int"
    folder = in_folder(spark, tmp_path, "documents", spark.createDataFrame(rows, schema))
    got = {row["doc_id"]: row for row in queries.op13_heap_bpe_counts(spark, folder).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    for at, text in enumerate(ODD_TEXTS):
        tokens = len(library.encode(text or ""))
        assert (got[at]["n_bytes"], got[at]["n_tokens"]) == (len((text or "").encode()), tokens)
        assert got[at]["over_limit"] == (tokens > 4096)
    assert any(row["over_limit"] for row in got.values())


def test_counts_of_given_documents_match_the_library(spark, model):
    folder = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = {row["doc_id"]: row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for row in queries.op13_heap_bpe_counts(spark, folder).collect():
        assert row["n_tokens"] == len(library.encode(texts[row["doc_id"]]))


def test_counts_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    folder = in_folder(spark, tmp_path, "documents", empty)
    assert queries.op13_heap_bpe_counts(spark, folder).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_matches_the_library(text):
    with open(public_tokenizers.path(queries.TOKENIZER), "rb") as file:
        counter = _counter(file.read())
    assert counter.count(text) == len(counter.model.encode(text))


def _counter(data, made={}):
    if "one" not in made:
        made["one"] = bpe_counts.PieceCounter(data)
    return made["one"]


def test_memo_is_bounded(monkeypatch, model):
    monkeypatch.setattr(bpe_counts, "MEMO_RUNS", 5)
    with open(model, "rb") as file:
        counter = bpe_counts.PieceCounter(file.read())
    text = " ".join(f"word{number}" for number in range(50))
    assert counter.count(text) == len(counter.model.encode(text))
    assert len(counter.memo) <= 5
