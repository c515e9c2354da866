"""Small fixtures with NULLs, empty and long texts, ties and repeated rows, against brute force."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orderlens.llm import (
    chat,
    decontam,
    line_dedup,
    mixing,
    ngram_join,
    quality,
    sharding,
    substring,
    toxicity,
    url_lists,
)
from orderlens.llm.common import word_count
from orderlens.llm.components import connected_components
from orderlens.scratch import stage

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, size long"


def word(number):
    return f"w{number * 7919 % 1009}x{number % 13}"


def prose(start, length):
    return " ".join(word(start * 31 + at * at) for at in range(length))


def sample_texts():
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed")
    shared = prose(99, 60)
    return [
        base,
        base,
        near,
        base.upper(),
        shared + " " + prose(5, 80),
        prose(6, 50) + "\n" + shared,
        "a b c a b c " * 20,
        "one two three",
        "one  two\tthree",
        "",
        None,
        " \n\t ",
        "line one\nline two\nline three\nline one",
        prose(7, 3000),
        "é ß ü naïve " * 5,
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (at, text, ("en", "de", None)[at % 3], ("a", "b", None)[at % 3], None, 7, 9)
        for at, text in enumerate(sample_texts())
    ]
    rows += [(None, "text without an id here", None, None, None, 7, 9), rows[0], rows[0]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def tokens(text):
    return (text or "").encode().split()


# sharding ----------------------------------------------------------------------------------


def check_shards(rows, sizes, n_shards):
    assert sorted(row["size"] for row in rows) == sorted(sizes)
    held = defaultdict(list)
    for row in rows:
        held[row["shard"]].append(row)
    for members in held.values():
        assert sorted(row["slot"] for row in members) == list(range(len(members)))
    share, largest = sum(sizes) / n_shards, max(sizes)
    assert all(sum(r["size"] for r in members) <= share + largest for members in held.values())


def test_shards_are_near_equal_with_a_hot_key(spark):
    rows = [(at, 0 if at % 3 else at, 10 + at % 50) for at in range(5000)]
    frame = spark.createDataFrame(rows, "doc_id long, k long, size long")
    placed = sharding.shard(frame, 7, F.col("k"), F.xxhash64("doc_id"), F.col("size")).collect()
    check_shards(placed, [row[2] for row in rows], 7)
    assert placed and sorted(map(tuple, placed)) == sorted(
        map(tuple, sharding.shard(frame, 7, F.col("k"), F.xxhash64("doc_id"), F.col("size")).collect())
    )


def test_sharding_keeps_odd_rows(docs, nothing):
    placed = sharding.shard_documents(docs, 3).collect()
    assert len(placed) == docs.count()
    assert {row["shard"] for row in placed} <= {0, 1, 2}
    assert sharding.shard_documents(nothing, 3).count() == 0


def test_overfull_ranges_are_divided(spark):
    frame = spark.range(20000).select(
        F.lit(5).cast("long").alias("_shard_key"),
        F.xxhash64("id").alias("_shard_tie"),
        F.lit(10).cast("long").alias("_shard_size"),
    )
    cuts, total = sharding.splitters(frame, 8, 17)
    assert total == 200000 and len(cuts) > 8 and {key for key, _ in cuts} == {5}


# n-gram join -------------------------------------------------------------------------------


def brute_groups(rows):
    sets = []
    for _, text in rows:
        low = tokens(text)
        low = [token.lower() for token in low]
        sets.append({tuple(low)} if 0 < len(low) < 5 else {tuple(low[i : i + 5]) for i in range(len(low) - 4)})
    parent = list(range(len(rows)))

    def find(at):
        while parent[at] != at:
            at = parent[at]
        return at

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for at, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[find(at)].append(doc)
    return [
        (doc, len(sets[at]), doc if not sets[at] else min(ids[find(at)], default=None))
        for at, (doc, _) in enumerate(rows)
    ]


def test_groups_match_brute_force(spark, docs, nothing):
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    found = [tuple(r) for r in ngram_join.similar_groups(docs, stage).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found, key=str) == sorted(brute_groups(rows), key=str)
    assert ngram_join.similar_groups(nothing, stage).count() == 0


def test_groups_of_many_near_copies(spark):
    base = prose(3, 100).split()
    rows = []
    for at in range(60):
        copy = list(base)
        copy[at % 90] = f"z{at}"
        if at % 4 == 0:
            copy[(at * 7) % 90] = f"y{at}"
        rows.append((at, " ".join(copy)))
    rows += [(100 + at, prose(200 + at, 40) + " " + " ".join(base[:30])) for at in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in ngram_join.similar_groups(frame, stage).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found) == sorted(brute_groups(rows))


def test_near_misses_meet_in_blocks(spark, monkeypatch):
    # Similarities around the limit: many candidates, few links, several components in every bucket.
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    sent = []
    real = ngram_join._home_links

    def watched(homes, likely, percent):
        links = stage(real(homes, likely, percent), "watched")
        sent.append((homes.filter("root <> home").count(), links.count()))
        return links

    monkeypatch.setattr(ngram_join, "_home_links", watched)
    base = prose(3, 100).split()
    rows = []
    for at in range(150):
        copy = list(base)
        for turn in range(1 + at % 4):
            copy[(at * 37 + turn * turn * 11) % 100] = f"z{at % 23}q{turn}"
        rows.append((at, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in ngram_join.similar_groups(frame, stage).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found) == sorted(brute_groups(rows))
    assert len({group for _, _, group in found}) > 5 and sent[0][0] > 10


def test_block_links_are_those_of_brute_force():
    import numpy as np

    random = np.random.default_rng(5)
    rows = []
    for at in range(60):
        held = np.unique(random.choice(60, random.integers(1, 50), replace=False).astype(np.uint64))
        prefixes = [held.astype(np.int64) for _ in range(ngram_join.ORDERS)]
        rows.append((at.to_bytes(16, "big"), len(held), (at % 9).to_bytes(16, "big"), at % 9 == 0, held.tobytes(), *prefixes))
    block = ngram_join._Block(rows)
    for row in rows:
        mine, wanted = set(np.frombuffer(row[4], np.uint64)), set()
        for other in rows:
            theirs = set(np.frombuffer(other[4], np.uint64))
            if row[2] != other[2] and (other[3] or other[0] > row[0]):
                if 100 * len(mine & theirs) >= 50 * len(mine | theirs):
                    wanted.add(other[2])
        of = {other[0]: other[2] for other in rows}
        assert {of[one] for one in block.links(row, 50)} == wanted


def test_first_shingles_tell_of_every_partner():
    import numpy as np

    random = np.random.default_rng(8)
    linked = 0
    for _ in range(3000):
        n = int(random.integers(1, 60))
        held = random.choice(2**62, n + 20, replace=False).astype(np.uint64)
        one, other = np.sort(held[:n]), np.sort(held[random.integers(0, 1 + n // 6) : n + random.integers(0, 1 + n // 6)])
        common = len(np.intersect1d(one, other))
        if common and 100 * common >= 80 * len(np.union1d(one, other)):
            linked += 1
            firsts = [x[: ngram_join.first_length(len(x), 80)] for x in (one, other)]
            shared = len(np.intersect1d(*firsts))
            assert shared >= ngram_join.least_shared(len(one), 80) and shared >= ngram_join.least_shared(len(other), 80)
    assert linked > 500


def test_only_sets_that_may_have_a_partner_travel_whole(spark):
    rows = [(at, prose(500 + at, 60)) for at in range(40)]
    rows += [(100, rows[0][1] + " more"), (101, rows[0][1]), (102, rows[1][1]), (103, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    staged = {}

    def kept(one, name):
        return staged.setdefault(name, stage(one, name)) if name == "sharing-texts" else stage(one, name)

    found = [tuple(r) for r in ngram_join.similar_groups(frame, kept).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found) == sorted(brute_groups(rows))
    assert {row["doc"] for row in staged["sharing-texts"].collect()} <= {"0", "100", "101"}


def test_sets_visit_the_home_that_crowds_their_bucket(spark, monkeypatch):
    # Two families with a passage in common: near misses of each other, whose pairs are not to be listed.
    monkeypatch.setattr(ngram_join, "CROWD", 8)
    staged, asked = {}, []
    real = ngram_join._crossing_pairs

    def listed(held, percent):
        pairs = stage(real(held, percent), "listed")
        asked.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "_crossing_pairs", listed)

    def kept(one, name):
        staged[name] = stage(one, name)
        return staged[name]

    common, first, second = prose(31, 70).split(), prose(32, 30).split(), prose(33, 30).split()
    rows = []
    for at in range(60):
        own = list(first if at % 3 else second)
        # Some of the one family are near the other, so that links may cross as well.
        own[at % 5 : at % 5 + at % 4] = (second if at % 3 else first)[at % 5 : at % 5 + at % 4]
        copy = common + own
        copy[(at * 7) % 70] = f"z{at % 6}"
        rows.append((at, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in ngram_join.similar_groups(frame, kept).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found) == sorted(brute_groups(rows))
    assert staged["visits"].count() > 0 and len({group for *_, group in found}) > 5


def test_plans_of_the_join_stay_small(spark):
    # The driver holds each plan, and anew whenever one of its stages ends.
    base = prose(3, 60).split()
    rows = [(at, " ".join([*base[: at % 50], f"z{at}", *base[at % 50 :]])) for at in range(30)]
    sizes = {}

    def kept(one, name):
        plan = one._jdf.queryExecution().executedPlan().toString()
        sizes[name] = max(sizes.get(name, 0), plan.count("Exchange"))
        return stage(one, name)

    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in ngram_join.similar_groups(frame, kept).select("doc_id", "n_shingles", "component_id").collect()]
    assert sorted(found) == sorted(brute_groups(rows))
    assert {"links", "home-links", "candidates"} <= set(sizes) and max(sizes.values()) <= 16, sizes


def test_settled_components_take_no_further_step(spark):
    written = []

    def kept(one, name):
        written.append(name)
        return stage(one, name)

    stars = spark.createDataFrame([(0, 3), (0, 4), (4, 0), (1, 2), (7, 7)], "a long, b long")
    assert sorted(tuple(row) for row in connected_components(stars, kept).collect()) == [(0, 0), (1, 1), (2, 1), (3, 0), (4, 0)]
    assert written.count("links") == 1
    chain = spark.createDataFrame([(at, at + 1) for at in range(40)], "a long, b long")
    assert {row["root"] for row in connected_components(chain, kept).collect()} == {0}
    assert connected_components(stars.limit(0), kept).count() == 0


def test_names_of_postings_survive_their_packing():
    import numpy as np

    from orderlens.llm import packed

    for names in ([b"\x00" * 12, b"a" * 11 + b"\x00", bytes(range(12))], [b"a", b"bcd", b""]):
        postings = packed.Postings(3)
        for at, name in enumerate(names):
            postings.add(name, np.arange(at, 40 + at, dtype=np.uint64))
        found = set()
        for bucket, blob in postings.flush():
            values, owner, owners, _ = packed.gather([blob])
            assert set((values % np.uint64(3)).tolist()) == {bucket}
            found |= {(owners[one], int(value)) for one, value in zip(owner, values)}
        assert found == {(name, at + value) for at, name in enumerate(names) for value in range(40)}


def test_one_of_each_group_stays(docs):
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    groups = brute_groups(rows)
    blank = sum(1 for _, n, _ in groups if n == 0)
    kept = ngram_join.keep_one(docs, stage)
    assert kept.columns == docs.columns
    assert kept.count() == blank + len({group for _, n, group in groups if n})


def test_columns_with_the_names_of_helpers_stay(docs):
    odd = docs.withColumns({"_row": F.col("doc_id") * 2, "_turn": F.lit("t"), "_kept": F.lit(1), "_blank": F.lit("b")})
    kept = ngram_join.keep_one(odd, stage)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert {row["doc_id"] for row in rows} == {row["doc_id"] for row in ngram_join.keep_one(docs, stage).collect()}
    assert all(row["_row"] == row["doc_id"] * 2 and row["_turn"] == "t" for row in rows if row["doc_id"] is not None)


def test_components(spark):
    links = [(at, at + 1) for at in range(50)] + [(100, 101), (103, 102), (101, 103), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = dict(tuple(row) for row in connected_components(frame, stage).collect())
    assert found == {**{at: 0 for at in range(51)}, **{at: 100 for at in range(100, 104)}}


# chat --------------------------------------------------------------------------------------


def test_perspectives(spark):
    rows = [
        (1, 0, "system", "be kind"),
        (1, 1, "ann", "hi"),
        (1, 2, "bob", None),
        (1, 2, "bob", None),
        (1, 300, "ann", "späť"),
        (None, 0, None, "lost"),
        (2, 0, "system", "alone"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r["conv_id"], r["speaker"], r["part"]): r for r in chat.render(frame).collect()}
    assert set(out) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (None, "unknown", 0)}
    first = out[(1, "ann", 0)]
    assert first["text"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n"
        "<|im_start|>user name=bob\n<|im_end|>\n"
    )
    assert [first["text"][s["start"] : s["end"]] for s in first["spans"]] == ["hi<|im_end|>\n"]
    late = out[(1, "bob", 1)]
    assert late["text"] == "<|im_start|>user name=ann\nspäť<|im_end|>\n" and not late["spans"]
    assert chat.render(frame.limit(0)).count() == 0


# line dedup --------------------------------------------------------------------------------


def brute_lines(rows):
    """Texts without the lines of runs of lines that also stand earlier, by plain search."""
    placed = sorted(
        (doc is None, doc or 0, "" if text is None else hashlib.md5(text.encode()).hexdigest(), text)
        for doc, text in set(rows) if text is not None
    )
    seen, lost = {}, defaultdict(set)
    for unknown, doc, key, text in placed:
        lines = text.split("\n")
        full = [at for at, line in enumerate(lines) if line.strip()]
        for low, high in zip(full, full[1:]):
            here = (unknown, doc, key, low)
            if seen.setdefault("\n".join(lines[low : high + 1]), here) != here:
                lost[(None if unknown else doc, text)].update(range(low, high + 1))
    out = []
    for doc, text in rows:
        kept = None
        if text is not None:
            kept = "\n".join(line for at, line in enumerate(text.split("\n")) if at not in lost[doc, text])
        out.append((doc, kept))
    return out


def test_repeated_passages_go_but_the_first(spark, nothing):
    passages = [[f"shared {size} line {at} {word(at)}" for at in range(size)] for size in range(2, 21)]
    rows = []
    for at in range(60):
        own = [f"own {at} {n}" for n in range(8)]
        own[3:3] = passages[at % 19]
        own[1:1] = ["", "  "] if at % 5 == 0 else []
        rows.append((at, "\n".join(own)))
    whole = "\n".join(passages[-1])
    rows += [(100, None), (101, ""), (102, "one line"), (None, whole), (103, "\n\n\n"), (104, "x\nx\nx\nx"), rows[2], rows[2]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"of": F.lit(1), "row": F.lit("r")})
    out = line_dedup.dedup_lines(frame, stage).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == sorted(brute_lines(rows), key=str)
    # Recall on the planted passages: each stays in one document only, line by line.
    left = Counter(line for r in out if r["text"] and r["doc_id"] != 2 for line in r["text"].split("\n"))
    assert all(left[line] <= 1 for passage in passages for line in passage)
    assert line_dedup.dedup_lines(nothing, stage).count() == 0


def test_chunks_do_not_shift():
    lines = [f"line {at} {word(at)}".encode() for at in range(200)]
    whole = {tuple(lines[low:high]) for low, high in line_dedup.chunks(b"\n".join(lines))}
    later = {tuple(([b"new"] + lines)[low:high]) for low, high in line_dedup.chunks(b"\n".join([b"new", *lines]))}
    assert len(whole - later) <= 2


# decontamination ---------------------------------------------------------------------------

ITEM = "A farmer named Alice sold 12 apples and 30 pears to Bob for 5 dollars. How many fruits did Alice sell?"


def test_templates_find_other_parameters(spark, nothing):
    around = "some words before it. ", " and then other words follow here."
    texts = [
        ITEM.join(around),
        ITEM.replace("12", "17").replace("Alice", "Carol").join(around),
        # One item value with two document values: not the same question.
        ITEM.replace("Alice sold", "Carol sold").join(around),
        "A farmer likes apples and pears. How many fruits are there?",
        None,
        "",
        prose(4, 2000),
    ]
    rows = list(enumerate(texts)) + [(None, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in decontam.contaminated(frame, items).collect()}
    assert {(0, 1), (1, 1), (None, 1)} <= set(found) and not {3, 4, 5, 6} & {doc for doc, _ in found}
    assert found[(0, 1)]["n_changed"] == 0 and found[(1, 1)]["n_changed"] >= 2
    assert found[(0, 1)]["n_covered"] > found.get((2, 1), {"n_covered": 0})["n_covered"]
    kept = decontam.remove_contaminated(frame, items)
    assert {3, 4, 5, 6} <= {r["doc_id"] for r in kept.collect()} and kept.columns == frame.columns
    assert decontam.contaminated(frame, items.limit(0)).count() == 0
    assert decontam.contaminated(nothing, items).count() == 0



def leaks(item, *texts):
    index, templates = decontam.Index([(1, item)]), decontam.Templates()
    return [bool(index.matches(*templates.tokens(text)[:3])) for text in texts]


def test_slot_dense_and_short_items_are_found_verbatim():
    for item in ("Solve 12 + 7 - 3 * 2", "3 5 8 13 21 34 55 89 144 233 377 610", "Name two primes"):
        assert leaks(item, f"see: {item} and more", item, "Solve 4 + 1 - 9 * 8 and 1 2 3") == [True, True, False]


def test_names_that_open_sentences_are_slots():
    pens = "Anna has 12 pens. Ben has 7 pens. Carl buys 5 pens. How many pens are there in the room?"
    other = pens.replace("Anna", "Dora").replace("Ben", "Emil").replace("Carl", "Fritz")
    assert leaks(pens, other, other.replace("How", "how"), other.replace("12", "3")) == [True] * 3
    capital = "What is the capital of France?"
    assert leaks(capital, f"Question 12\n{capital}", f"so {capital.lower()}") == [True, True]


def test_long_passages_of_longer_items_are_found():
    for length, quoted in ((59, 25), (200, 90), (500, 13)):
        item = prose(length, length).split()
        passage = " ".join(item[5 : 5 + quoted])
        assert leaks(" ".join(item), f"{prose(1, 80)} {passage} {prose(2, 80)}", prose(3, 200)) == [True, False]
    assert leaks(" ".join(item), " ".join(item[5:17])) == [False]


# substring dedup ---------------------------------------------------------------------------


def brute_substring(rows):
    held = [tokens(text) for _, text in rows]
    width = substring.WINDOW
    counts = Counter(tuple(w[i : i + width]) for w in held for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, held):
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        kept = b" ".join(token for token, stays in zip(w, keep) if stays)
        out.append((doc, len(w), keep.count(False), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [substring.HOT, 1])
def test_substrings_match_brute_force(docs, nothing, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    found = [tuple(r)[:4] for r in substring.remove_repeats(docs, stage).collect()]
    assert sorted(found, key=str) == sorted(brute_substring(rows), key=str)
    assert substring.remove_repeats(nothing, stage).count() == 0


# URL lists ---------------------------------------------------------------------------------


def test_entries_hold_from_their_day(spark):
    entries = spark.createDataFrame(
        [
            ("l", "bad.com", "2024-01-10", "block"),
            ("l", "bad.com", "2024-02-10", "drop"),
            ("l", "ok.bad.com", "2024-01-01", "allow"),
            ("m", "bad.com", "2024-01-20", "allow"),
            ("l", None, "2024-01-01", "block"),
            ("l", "bad.com", "2024-01-10", "block"),
        ],
        "list_name string, pattern string, day string, action string",
    ).select("list_name", "pattern", F.col("day").cast("date").alias("listed_on"), "action")
    cases = [
        ("http://bad.com/x", "2024-01-09", None),
        ("https://u@WWW.bad.com:80/x", "2024-01-10", "block"),
        ("http://bad.com./", "2024-01-25", "block"),
        ("http://bad.com", "2024-02-10", "allow"),
        ("http://a.ok.bad.com", "2024-01-15", "allow"),
        ("http://verybad.com", "2024-01-15", None),
        ("no url", "2024-01-15", None),
        (None, "2024-01-15", None),
        ("http://bad.com", None, None),
    ]
    frame = spark.createDataFrame(
        [(at, url, day, "x") for at, (url, day, _) in enumerate(cases)], "id long, url string, day string, host string"
    ).withColumn("fetched_on", F.col("day").cast("date"))
    judged = {r["id"]: r["verdict"] for r in url_lists.judge_captures(frame, entries).collect()}
    assert judged == {at: verdict for at, (_, _, verdict) in enumerate(cases)}
    assert url_lists.judge_captures(frame, entries.limit(0)).filter("verdict is not null").count() == 0
    assert url_lists.judge_captures(frame.limit(0), entries).count() == 0


# toxicity ----------------------------------------------------------------------------------


def toxicity_tables(spark, count=600):
    rows, labels = [], []
    for at in range(count):
        bad = at % 5 == 0
        text = prose(at, 40) + (" nasty vile rude" if bad else " kind warm calm")
        rows.append((at, text))
        if at % 2 == 0:
            labels.append((at, int(at % 7 > 0), int(bad)))
    rows += [(None, None), (count, ""), (count + 1, rows[0][1]), rows[0]]
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality long, toxic long"),
    )


def test_chain_on_held_out_documents(spark):
    docs, labels = toxicity_tables(spark)
    categories = {"low": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.fit_chain(docs, labels, categories, stage)
    assert [name for name, _, _ in chain.links] == ["low", "toxic"]
    assert len(chain.links[1][1][1]) == chain.vocabulary.size + 1
    rows = toxicity.score(docs, chain).collect()
    held_out = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 2]
    right = sum(("toxic" in r["reported"]) == (r["doc_id"] % 5 == 0) for r in held_out)
    assert right >= 0.97 * len(held_out) and len(rows) == docs.count()
    kept = toxicity.remove_reported(docs, chain, ("toxic",))
    assert kept.columns == docs.columns
    assert kept.count() == sum("toxic" not in r["reported"] for r in rows)


def test_chain_without_labels_reports_nothing(spark):
    docs, labels = toxicity_tables(spark, 20)
    categories = {"toxic": F.col("toxic") == 1}
    for some in (labels.limit(0), labels.withColumn("toxic", F.lit(0))):
        chain = toxicity.fit_chain(docs, some, categories, stage)
        assert all(not r["reported"] for r in toxicity.score(docs, chain).collect())


# mixing ------------------------------------------------------------------------------------


def test_targets_stop_at_twice_the_size():
    wanted = [float(t) for t in mixing.targets([100, 100, 1000, 0], [5, 2, 1, 5])]
    assert wanted == [200.0, 200.0, 1400.0, 0.0]


def test_split_is_exact():
    quotas = [50, 0, 7, 1000]
    split = mixing.split_quotas(quotas, 64, 3)
    assert split.sum(axis=0).tolist() == quotas
    totals = split.sum(axis=1)
    assert totals.max() - totals.min() <= 7


def test_mix_meets_its_targets(spark, docs, nothing):
    rows = [(at, ("a", "b", "c", None)[at % 4], prose(at, 5 + at % 60)) for at in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    planned = mixing.mix(frame, word_count(F.col("text")))
    taken = planned.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")
    )
    for row in taken.collect():
        assert abs(row["taken"] - row["target"]) <= 65
    assert planned.filter("size(mix_shards) <> copies or copies > 2").count() == 0
    again = mixing.mix(frame.orderBy(F.desc("doc_id")), word_count(F.col("text")))
    assert planned.exceptAll(again).count() == 0
    odd = mixing.mix(docs, word_count(F.col("text")))
    assert odd.count() == docs.count() and odd.columns.count("size") == 1
    rows = mixing.mixed_documents(docs, word_count(F.col("text")))
    assert rows.columns == docs.columns and rows.filter("size <> 9").count() == 0
    assert rows.count() == odd.agg(F.sum("copies")).first()[0]
    assert mixing.mix(nothing, word_count(F.col("text"))).count() == 0


def test_tree_gives_every_shard_its_exact_blocks(spark, tmp_path, monkeypatch):
    """Quotas, owners of blocks and the written layout, recomputed document by document."""
    monkeypatch.setattr(mixing, "BLOCK_WORDS", 400)
    monkeypatch.setattr(mixing, "SLICE_WORDS", 300)
    rows = [(at, ("a", "b", None)[at % 3], prose(at, 5 + at % 60)) for at in range(3000)]
    sizes = {at: len(text.split()) for at, _, text in rows}
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    planned = mixing.mix(frame, word_count(F.col("text")))
    shards = {row["doc_id"]: row["mix_shards"] for row in planned.collect()}

    def drawn(purpose, at):
        return int(hashlib.md5(f"{purpose}29|{at}|{sizes[at]}".encode()).hexdigest()[:15], 16)

    names = ["a", "b", None]
    totals = [sum(sizes[at] for at, name, _ in rows if name == source) for source in names]
    goals = [float(goal) for goal in mixing.targets(totals, [5, 2, 1])]
    units, owed = {}, []
    for source, total, goal in zip(names, totals, goals):
        blocks, passes = -(-total // 400), int(goal // total)
        members = sorted((drawn("place", at), at) for at, name, _ in rows if name == source)
        so_far, most = 0, passes * blocks
        starts = {}
        for random, at in members:
            starts.setdefault((random >> 20) * blocks >> 40, so_far)
            so_far += sizes[at]
        most += max((n + 1 for n, before in starts.items() if before < goal - passes * total), default=0)
        owed.append(most)
        so_far = 0
        for random, at in members:
            block = (random >> 20) * blocks >> 40
            times = passes + (2 * so_far + sizes[at] <= 2 * (goal - passes * total))
            units[at] = [number * blocks + block for number in range(times)]
            so_far += sizes[at]
    ends = mixing.split_quotas(owed, mixing.MIX_SHARDS, 29).cumsum(axis=0)
    assert ends[-1].tolist() == owed
    for at, source, _ in rows:
        column = ends[:, names.index(source)]
        assert shards[at] == [int((column <= unit).sum()) for unit in units[at]]
        assert all(unit < column[-1] for unit in units[at])

    path = str(tmp_path / "mix")
    mixing.write_mix(planned, ["doc_id"], path)
    written = spark.read.parquet(path).groupBy("doc_id").agg(F.sort_array(F.collect_list("mix_shard")))
    assert dict(written.collect()) == {at: sorted(own) for at, own in shards.items() if own}
    spread = mixing.laid_out(planned).withColumn("task", F.spark_partition_id())
    slices = spread.groupBy("mix_shard", "mix_slice").agg(F.count_distinct("task").alias("tasks"))
    assert slices.filter("tasks > 1").count() == 0 and slices.count() > mixing.MIX_SHARDS
    places = spread.withColumn("place", F.monotonically_increasing_id()).select(
        "task", "mix_shard", "mix_order", "place"
    )
    seen = [(row["task"], row["mix_shard"], row["mix_order"]) for row in places.orderBy("place").collect()]
    assert seen == sorted(seen)


# quality -----------------------------------------------------------------------------------


def test_quality_counts_match_brute_force(spark, docs, nothing):
    rows = {r["doc_id"]: r for r in quality.judge(docs.dropDuplicates(["doc_id"]), stage).collect()}
    for at, text in enumerate(sample_texts()):
        held = tokens(text)
        triples = Counter(zip(held, held[1:], held[2:]))
        covered = {
            i + d for i in range(len(held) - 2) if triples[tuple(held[i : i + 3])] > 1 for d in range(3)
        }
        lines = [line for line in (text or "").split("\n") if line.split()]
        row = rows[at]
        assert row["n_words"] == len(held) and row["n_repeat_words"] == len(covered)
        assert row["word_chars"] == sum(len(token.decode()) for token in held)
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["base_failed"] == (len(held) < 50 or 100 * len(covered) > 50 * len(held))
        assert not (row["kept"] and row["base_failed"])
    assert quality.judge(nothing, stage).count() == 0


def test_symbol_junk_fails_and_prose_stays(spark):
    line = "The old house of the family was in a small town and it is that road to the sea for which we came. "
    rows = [(at, " ".join(f"{word(at * n)} {line}" for n in range(1, 12)), "en") for at in range(30)]
    junk = " ".join(f"{word(n)}###$$$ %%%&&& *** |||" for n in range(80))
    rows.append((99, junk, "en"))
    many = " ".join(f"{word(n)} {word(n + 1)} {word(n)} {word(n + 1)} {word(n)}" for n in range(300))
    rows.append((98, many, "xx"))
    judged = {
        r["doc_id"]: r
        for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), stage).collect()
    }
    assert not judged[99]["kept"] and judged[99]["char_distance"] > quality.MAX_CHAR_DISTANCE
    assert judged[98]["word_distance"] is None and judged[98]["n_repeat_words"] == 1500
    assert all(judged[at]["char_distance"] < 0.2 for at in range(30))


def test_text_without_the_words_of_its_language_fails(spark):
    small = ("the", "of", "and", "to", "in", "a", "is", "that")
    prose_rows = [
        (at, " ".join(f"{word(at * 31 + n)} {small[n * (2 * at + 1) % 8]}" for n in range(100))) for at in range(30)
    ]
    gibberish = " ".join("z" + chr(97 + n % 26) + chr(97 + n // 26) + "q" for n in range(200))
    rows = []
    for at, lang in enumerate(("en", "tr", None)):
        rows += [(1000 * at + doc, text, lang) for doc, text in prose_rows]
        rows.append((1000 * at + 99, gibberish, lang))
    judged = {
        r["doc_id"]: r
        for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), stage).collect()
    }
    for doc, row in judged.items():
        assert row["kept"] == (doc % 1000 != 99), row
        assert (row["frequent_distance"] > quality.MAX_FREQUENT_DISTANCE) == (doc % 1000 == 99)


def test_markup_is_a_class_of_its_own(spark):
    rows = [(at, " ".join(word(at * 31 + n) for n in range(100)), "en") for at in range(30)]
    rows.append((99, " ".join(f"{word(n)}==== ____ {{}} @@@@ ~~~~/" for n in range(90)), "en"))
    judged = {
        r["doc_id"]: r["char_distance"]
        for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), stage).collect()
    }
    assert judged.pop(99) > quality.MAX_CHAR_DISTANCE >= max(judged.values())


def test_line_tasks_hand_memory_back(monkeypatch):
    """Reused Python workers keep nothing of a partition that has ended."""
    from orderlens.llm import common

    ended = []
    monkeypatch.setattr(common, "hand_back", lambda: ended.append(1))
    for task in (line_dedup._emit, line_dedup._emit_bytes, line_dedup._cut):
        assert list(task(iter([]))) == []
    assert len(ended) == 3
