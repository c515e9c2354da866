"""N-gram Jaccard join with prefix filters under several global token orders.

Documents are sets of word shingles; two link when their Jaccard similarity reaches the limit.

1. Equal sets are one set (by 64 bits of a digest and the size). Under the order of the hashes alone, two sets
   that link share ``SPARE`` percent of the smaller one's shingles among the first 20 + ``SPARE`` percent of
   both. Only these firsts travel, as packed postings, to the bucket of the shingle; a set that shares fewer
   has no partner. Texts of the other sets, one per set, are read again.
2. Their sets travel whole to the buckets, which tell how many of them hold a shingle. Every order puts shingles that one set alone holds first. A set of n shingles shares with a
   partner one of its first n - ceil(limit * n) + 1, so a set whose prefix has only shingles of its
   own is done, whatever the order; only shared shingles are kept for the rest.
3. The rest get a prefix under each of ``ORDERS`` orders of their shared shingles: rarest first,
   and frequency classes with two different scrambles. A candidate pair must share a prefix shingle
   under all of them; only pairs that pass all filters are verified.
4. Only components are asked for, so a dense group is not expanded into pairs: each set is first verified
   against a few leaders among the sets it shares prefix shingles with. What is left to compare are
   pairs between different components. A set's home is the component that is the largest in most of its
   buckets; sets of one home meet as blocks of bounded size, where the filters and the overlap of
   a set with a whole block are counted at once and one link per component leaves. Only pairs between
   homes are listed.

All orders go through one plan, and what a later step reads more than once is written first: the driver
holds every plan, and anew whenever one of its stages ends.

Shingles are compared by 64-bit hashes.

Edge cases: NULL or blank text is an empty set, linked with nothing; fewer words than a shingle make one
shingle of them all; repeated rows and equal ids are fine (a NULL id never names a component, unless
all ids in it are NULL); an empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm import packed
from orderlens.llm.common import BREAK_PATTERN, handing_back
from orderlens.llm.components import connected_components

SHINGLE = 5
PERCENT = 80
ORDERS = 3
SPARE = 10
BUCKETS_A_HOME = 8
NAME_BYTES = 12
LEADERS_TRIED = (1, 6)
HOME_TURNS = 1
CROWD = 64
HOME_TO_CROWD = 16
BUCKET_BYTES = 6 << 20
LEAST_BUCKETS = 16
MOST_PARTITIONS = 20_000
BLOCK_SETS = 1024
BLOCK_BYTES = 8 << 20
_SEEN = 200_000


def shingles(tokens: list[bytes]) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not tokens:
        return np.empty(0, np.uint64)
    return np.unique(packed.runs_of_words(packed.word_hashes(tokens), min(SHINGLE, len(tokens))))


def least_overlap(n, percent: int):
    """Smallest intersection of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def first_length(n: int, percent: int) -> int:
    """How many of ``n`` shingles, in the order of their hashes, are looked at first."""
    return min(n, n - least_overlap(n, percent) + max(1, n * SPARE // 100))


def least_shared(n, percent: int):
    """How many of a set's first shingles are among those of any partner.

    Of t common shingles the i-th, in any order, is among the first n - t + i of either set.
    """
    return np.maximum(1, least_overlap(n, percent) * SPARE // 100)


def _send_sets(buckets: int, percent: int | None):
    """Document rows and packed postings; with ``percent`` only of the first shingles of a set."""

    def send(batches) -> Iterator[pd.DataFrame]:
        columns = ["bucket", "doc", "row", "digest", "n", "blob"]
        postings, seen, turn = packed.Postings(buckets), set(), 0

        def blobs() -> pd.DataFrame:
            return pd.DataFrame(
                [(bucket, None, None, None, 0, blob) for bucket, blob in postings.flush()], columns=columns
            )

        for frame in batches:
            rows = []
            for doc, row, text in zip(frame["doc"], frame["row"], frame["text"]):
                held = shingles(text.lower().split())
                digest = hashlib.md5(held.tobytes()).digest()[: NAME_BYTES - 4]
                owner = digest + len(held).to_bytes(4, "big")
                turn += 1
                rows.append((turn % buckets, doc, row, owner, len(held), None))
                if len(held) and owner not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(owner)
                    postings.add(owner, held if percent is None else held[: first_length(len(held), percent)])
                    if postings.full():
                        yield blobs()
            yield pd.DataFrame(rows, columns=columns)
        if postings.size:
            yield blobs()

    return send


def _shared_postings(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Of a bucket's postings, those of shingles that two sets hold: values, owners, holders, names."""
    value, owner, owners, _ = packed.gather(blobs)
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    # Most shingles have one holder; only runs of equal ones are looked at further.
    starts = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    lengths = np.diff(np.append(starts, len(value)))
    holders = np.repeat(lengths, lengths)
    shared = holders > 1
    return value[shared], owner[shared], holders[shared], owners


def _by_home(owner: np.ndarray, owners: list[bytes], homes: int) -> Iterator[tuple[int, np.ndarray]]:
    """(home, places of its postings) for every home that has some."""
    home = np.fromiter((int.from_bytes(one[:4], "big") for one in owners), np.int64, len(owners)) % homes
    target = home[owner]
    order = np.lexsort((owner, target))
    edges = np.searchsorted(target[order], np.arange(homes + 1))
    for number in np.flatnonzero(np.diff(edges)):
        yield int(number), order[edges[number] : edges[number + 1]]


def _meet_firsts(homes: int):
    def meet(batches) -> Iterator[pd.DataFrame]:
        """Document rows as they are; for every home its sets and how many of their firsts are shared."""
        columns = ["doc", "row", "digest", "n", "home", "blob"]
        for _, rows in packed.by_key(batches, "bucket", ["doc", "row", "digest", "n", "blob"]):
            blobs = [row[4] for row in rows if row[4] is not None]
            out = [(*row[:4], -1, None) for row in rows if row[4] is None]
            if blobs:
                _, owner, _, owners = _shared_postings(blobs)
                for number, part in _by_home(owner, owners, homes):
                    used, counts = np.unique(owner[part], return_counts=True)
                    blob = packed.dump(b"".join(owners[one] for one in used), counts.astype(np.int32))
                    out.append((None, None, None, 0, number, blob))
            if out:
                yield pd.DataFrame(out, columns=columns)

    return meet


def _keep_sharing(percent: int):
    """Names of the sets that share enough of their first shingles to have a partner."""

    def keep(batches) -> Iterator[pd.DataFrame]:
        for _, rows in packed.by_key(batches, "home", ["blob"]):
            names, counts = zip(*(packed.load(blob) for (blob,) in rows))
            used, at = np.unique(np.frombuffer(b"".join(names), f"S{NAME_BYTES}"), return_inverse=True)
            total = np.bincount(at, np.concatenate(counts))
            n = np.frombuffer(used.tobytes(), ">u4")[NAME_BYTES // 4 - 1 :: NAME_BYTES // 4].astype(np.int64)
            kept = used[total >= least_shared(n, percent)]
            yield pd.DataFrame({"id": [one.ljust(NAME_BYTES, b"\0") for one in kept.tolist()]})

    return keep


def _meet_shingles(homes: int):
    def meet(batches) -> Iterator[pd.DataFrame]:
        """Of the postings, those of shingles that two sets hold, sent to the homes of the sets."""
        for _, rows in packed.by_key(batches, "bucket", ["blob"]):
            value, owner, holders, owners = _shared_postings([blob for (blob,) in rows])
            out = []
            for number, part in _by_home(owner, owners, homes):
                used, at = np.unique(owner[part], return_inverse=True)
                names = [owners[one] for one in used]
                blob = packed.dump(value[part], at.astype(np.int32), names, holders[part].astype(np.int64))
                out.append((number, blob))
            yield pd.DataFrame(out, columns=["home", "blob"])

    return meet


def _prefixes(value: np.ndarray, holders: np.ndarray, length: int) -> list[np.ndarray]:
    """The first ``length`` shared shingles under each order."""
    classes = np.floor(np.log2(holders)).astype(np.int64)
    one = packed.scrambled(value ^ np.uint64(0x51ED270B))
    two = packed.scrambled(value ^ np.uint64(0xA5A5F00D))
    orders = [np.lexsort((value, holders)), np.lexsort((one, classes)), np.lexsort((two, classes))]
    return [value[order[:length]] for order in orders[:ORDERS]]


def _keep_likely(percent: int):
    """Sets whose prefix has shared shingles, with those shingles and the prefixes."""

    def keep(batches) -> Iterator[pd.DataFrame]:
        columns = ["id", "n", "alone", "shared", *[f"prefix{at}" for at in range(ORDERS)]]
        for _, rows in packed.by_key(batches, "home", ["blob"]):
            numbers: dict[bytes, int] = {}
            parts = []
            for (blob,) in rows:
                value, at, names, holders = packed.load(blob)
                known = np.array([numbers.setdefault(one, len(numbers)) for one in names])
                parts.append((value, known[at], holders))
            value = np.concatenate([part[0] for part in parts])
            owner = np.concatenate([part[1] for part in parts])
            holders = np.concatenate([part[2] for part in parts])
            order = np.lexsort((value, owner))
            value, owner, holders = value[order], owner[order], holders[order]
            edges = np.searchsorted(owner, np.arange(len(numbers) + 1))
            out = []
            for name, number in numbers.items():
                low, high = edges[number], edges[number + 1]
                n = int.from_bytes(name[NAME_BYTES - 4 :], "big")
                alone = n - int(high - low)
                length = n - least_overlap(n, percent) + 1 - alone
                if length > 0:
                    mine, counts = value[low:high], holders[low:high]
                    cuts = _prefixes(mine, counts, length)
                    out.append(
                        (name, n, alone / n, mine.tobytes(), *[cut.view(np.int64) for cut in cuts])
                    )
                if len(out) >= 500:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    return keep


def _verify(percent: int):
    def verify(batches) -> Iterator[pd.DataFrame]:
        for frame in batches:
            kept = []
            for a, b, n, m, left, right in zip(
                frame["a"], frame["b"], frame["a_n"], frame["b_n"], frame["a_shared"], frame["b_shared"]
            ):
                common = len(
                    np.intersect1d(
                        np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), True
                    )
                )
                if 100 * common >= percent * (n + m - common):
                    kept.append((a, b))
            yield pd.DataFrame(kept, columns=["a", "b"])

    return verify


def _verified(pairs: DataFrame, likely: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose similarity reaches the limit."""

    def side(name: str) -> DataFrame:
        return likely.select(
            F.col("id").alias(name), F.col("n").alias(f"{name}_n"), F.col("shared").alias(f"{name}_shared")
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(handing_back(_verify(percent)), "a binary, b binary")


def _postings(likely: DataFrame, order: int) -> DataFrame:
    return likely.select("id", "n", "alone", F.explode(f"prefix{order}").alias("token"))


def _placed_postings(likely: DataFrame, homes: DataFrame) -> DataFrame:
    """Postings under all orders, ``order_bit`` tells which, of the sets that have a home."""
    orders = [F.struct(F.lit(1 << at).alias("order_bit"), F.col(f"prefix{at}").alias("tokens")) for at in range(ORDERS)]
    each = likely.select("id", "n", F.explode(F.array(*orders)).alias("under"))
    postings = each.select("id", "n", "under.order_bit", F.explode("under.tokens").alias("token"))
    return postings.join(homes, "id")


def _sizes_fit(percent: int, one: str, other: str):
    return (F.col(one) * 100 >= F.col(other) * percent) & (F.col(other) * 100 >= F.col(one) * percent)


def _leader_pairs(held: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs of sets with leaders of their prefix buckets that are in another component.

    First the set with the fewest shingles of its own leads a bucket, for it is nearest to what
    copies have in common; later any set does, by a hash, and what is left tries several leaders.
    """
    first = F.col("alone") if turn == 0 else F.xxhash64(F.lit(turn), "token", "id").cast("double")
    rank = F.struct(first.alias("first"), F.col("id").alias("leader"), F.col("n").alias("leader_n"), F.col("root").alias("leader_root"))
    leaders = held.groupBy("token").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("members"))
    fitting = held.join(leaders.filter("members > 1"), "token").filter(
        (F.col("root") != F.col("best.leader_root")) & _sizes_fit(percent, "n", "best.leader_n")
    )
    tried = F.slice(F.sort_array(F.collect_set("best")), 1, LEADERS_TRIED[turn])
    return (
        fitting.groupBy("id")
        .agg(tried.alias("tried"))
        .select(F.col("id").alias("a"), F.explode("tried.leader").alias("b"))
        .distinct()
    )


def _open_buckets(held: DataFrame, *bucket: str) -> DataFrame:
    """Buckets with several components, and the largest of them."""
    parts = held.groupBy(*bucket, "root").agg(F.count(F.lit(1)).alias("members"))
    largest = parts.groupBy(*bucket).agg(
        F.max(F.struct("members", "root")).alias("largest"), F.count(F.lit(1)).alias("roots")
    )
    return largest.filter("roots > 1").select(*bucket, F.col("largest.root").alias("main"))


def _voted(seats: DataFrame) -> DataFrame:
    """(id, root, home): the home that most buckets of a set name."""
    votes = seats.groupBy("id", "root", "main").agg(F.count(F.lit(1)).alias("votes"))
    return (
        votes.groupBy("id", "root")
        .agg(F.max(F.struct("votes", "main")).alias("most"))
        .select("id", "root", F.col("most.main").alias("home"))
    )


def _homes(held: DataFrame, stage) -> DataFrame:
    """(id, root, home) of the sets that share an open bucket.

    A bucket first names its largest component, then the home that most of its sets have chosen, so
    small homes around a large one join it.
    """
    seats = stage(
        held.join(_open_buckets(held, "token"), "token").select("id", "root", "token", "main"), "seats"
    )
    homes = stage(_voted(seats), "homes")
    for _ in range(HOME_TURNS):
        counted = (
            seats.select("id", "token")
            .join(homes.select("id", "home"), "id")
            .groupBy("token", "home")
            .agg(F.count(F.lit(1)).alias("sets"))
        )
        chosen = counted.groupBy("token").agg(F.max(F.struct("sets", "home")).alias("most"))
        named = chosen.select("token", F.col("most.home").alias("main"))
        homes = stage(_voted(seats.drop("main").join(named, "token")), "homes")
    return homes


def _visits(held: DataFrame, homes: DataFrame) -> DataFrame:
    """(id, visited): sets and the other homes that crowd one of their buckets, under any order.

    A crowd is many sets of one home and no small part of it, so a visit costs about as much as the pairs
    with the crowd would.
    """
    sizes = homes.groupBy(F.col("home").alias("visited")).agg(F.count(F.lit(1)).alias("size"))
    counted = held.groupBy("order_bit", "token", "home").agg(F.count(F.lit(1)).alias("sets"))
    most = counted.groupBy("order_bit", "token").agg(
        F.max(F.struct("sets", "home")).alias("most"), F.count(F.lit(1)).alias("homes")
    )
    crowds = (
        most.filter((F.col("homes") > 1) & (F.col("most.sets") > CROWD))
        .select("order_bit", "token", F.col("most.home").alias("visited"), F.col("most.sets").alias("sets"))
        .join(sizes, "visited")
        .filter(F.col("size") <= HOME_TO_CROWD * F.col("sets"))
        .select("order_bit", "token", "visited")
    )
    guests = held.join(crowds, ["order_bit", "token"]).filter("home <> visited")
    return guests.select("id", "visited").distinct()


def _open_seats(held: DataFrame, visits: DataFrame) -> DataFrame:
    """Postings in open buckets, of any order, with what else the pairs are told by."""
    bucket = ["order_bit", "token"]
    known = visits.groupBy(F.col("id").alias("of")).agg(F.collect_list("visited").alias("visits"))
    return (
        held.join(_open_buckets(held, *bucket), bucket)
        .join(known, F.col("id") == F.col("of"), "left")
        .withColumn("visits", F.coalesce("visits", F.array().cast("array<binary>")))
        .drop("of")
    )


def _crossing_pairs(inside: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a bucket under every order but neither component nor home nor a visit; one side
    is outside the bucket's largest."""
    bucket = ["order_bit", "token"]
    outside = inside.filter(F.col("root") != F.col("main")).select(
        *bucket,
        F.col("id").alias("x"),
        F.col("n").alias("x_n"),
        F.col("root").alias("x_root"),
        F.col("home").alias("x_home"),
        F.col("visits").alias("x_visits"),
    )
    apart = (F.col("root") != F.col("x_root")) & (F.col("home") != F.col("x_home"))
    apart &= ~F.array_contains("x_visits", F.col("home")) & ~F.array_contains("visits", F.col("x_home"))
    return (
        outside.join(inside, bucket)
        .filter(apart & _sizes_fit(percent, "n", "x_n"))
        .groupBy(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b"))
        .agg(F.bit_or("order_bit").alias("orders"))
        .filter(F.col("orders") == (1 << ORDERS) - 1)
        .select("a", "b")
    )


class _Block:
    """Sets whose overlap with one other set is counted in one pass."""

    def __init__(self, rows: list[tuple]):
        ids, n, roots, main, shared, *prefixes = zip(*rows)
        self.ids = np.array(ids, f"S{len(ids[0])}")
        self.n = np.array(n, np.int64)
        self.roots = np.array(roots, f"S{len(ids[0])}")
        self.main = np.array(main, bool)
        parts = [np.frombuffer(one, np.uint64) for one in shared]
        self.values, self.at = np.unique(np.concatenate(parts), return_inverse=True)
        self.starts = self._starts(parts)
        self.prefix_at, self.prefix_starts = [], []
        for one in prefixes:
            pieces = [np.asarray(piece, np.int64).view(np.uint64) for piece in one]
            self.prefix_at.append(np.searchsorted(self.values, np.concatenate(pieces)))
            self.prefix_starts.append(self._starts(pieces))

    @staticmethod
    def _starts(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate(([0], np.cumsum([len(part) for part in parts])[:-1]))

    def _marked(self, values: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        marks = np.zeros(len(self.values), np.int64)
        marks[at[self.values[at] == values]] = 1
        return marks

    def links(self, row: tuple, percent: int, guest: bool = False) -> list[bytes]:
        """A similar set of every other component; of two outside the main one, the smaller or the guest asks."""
        name, n, root, _, shared, *prefixes = row
        fits = (100 * self.n >= percent * n) & (100 * n >= percent * self.n)
        fits &= (self.roots != np.bytes_(root)) & (self.main | guest | (self.ids > np.bytes_(name)))
        for order, prefix in enumerate(prefixes):
            if not fits.any():
                return []
            marks = self._marked(np.asarray(prefix, np.int64).view(np.uint64))
            fits &= np.add.reduceat(marks[self.prefix_at[order]], self.prefix_starts[order]) > 0
        if not fits.any():
            return []
        marks = self._marked(np.frombuffer(shared, np.uint64))
        common = np.add.reduceat(marks[self.at], self.starts)
        fits &= 100 * common >= percent * (n + self.n - common)
        found = np.flatnonzero(fits)
        _, first = np.unique(self.roots[found], return_index=True)
        return [self.ids[one].ljust(self.ids.itemsize, b"\0") for one in found[first]]


def _meet_blocks(percent: int):
    fields = ["asks", "guest", "id", "n", "root", "main", "shared", *[f"prefix{at}" for at in range(ORDERS)]]

    def meet(batches) -> Iterator[pd.DataFrame]:
        for _, rows in packed.by_key(batches, "place", fields):
            asking = [row[1:] for row in rows if row[0]]
            held = [row[2:] for row in rows if not row[0]]
            if asking and held:
                block = _Block(held)
                pairs = [
                    (row[0], other) for guest, *row in asking for other in block.links(row, percent, guest)
                ]
                yield pd.DataFrame(pairs, columns=["a", "b"])

    return meet


def _home_links(present: DataFrame, likely: DataFrame, percent: int) -> DataFrame:
    """Verified pairs (a, b) within homes and with their guests, between components.

    Every guest, and every set outside a home's main component, meets every set of the home: blocks of
    those that ask and blocks of those that are held are paired, so a home of any size spreads over tasks.
    """
    asks = F.col("guest") | (F.col("root") != F.col("home"))
    held = ~F.col("guest")
    sized = present.join(likely.select("id", F.octet_length("shared").alias("bytes")), "id")

    def blocks(which: Column) -> Column:
        sets = F.sum(F.when(which, 1).otherwise(0)) / BLOCK_SETS
        size = F.sum(F.when(which, F.col("bytes")).otherwise(0)) / BLOCK_BYTES
        return F.ceil(F.greatest(sets, size)).cast("int")

    cuts = (
        sized.groupBy(F.col("home").alias("of"))
        .agg(blocks(asks).alias("asking"), blocks(held).alias("holding"))
        .filter("asking > 0")
    )
    members = present.join(cuts, F.col("home") == F.col("of")).join(likely, "id")
    block_asking = F.pmod(F.xxhash64(F.lit(1), "id"), F.col("asking")).cast("int")
    block_held = F.pmod(F.xxhash64(F.lit(2), "id"), F.col("holding")).cast("int")
    main = F.col("root") == F.col("home")
    seat = "array<struct<asks: boolean, one: int, other: int>>"

    def seats(which: Column, asking: bool, one, other) -> Column:
        """Where a member sits when it asks, or is held: once against every block of the other kind."""
        across = F.sequence(F.lit(0), F.col("holding" if asking else "asking") - 1)
        placed = F.transform(across, lambda at: F.struct(F.lit(asking).alias("asks"), one(at).alias("one"), other(at).alias("other")))
        return F.when(which, placed.cast(seat)).otherwise(F.array().cast(seat))

    every = F.concat(
        seats(asks, True, lambda _: block_asking, lambda at: at), seats(held, False, lambda at: at, lambda _: block_held)
    )
    place = F.concat_ws("|", F.hex("home"), F.col("seat.one").cast("string"), F.col("seat.other").cast("string"))
    columns = ["n", "root", main.alias("main"), "guest", "shared", *[f"prefix{at}" for at in range(ORDERS)]]
    rows = members.withColumn("seat", F.explode(every)).select(
        place.alias("place"), F.col("seat.asks").alias("asks"), "id", *columns
    )
    return (
        rows.repartition("place")
        .sortWithinPartitions("place")
        .mapInPandas(handing_back(_meet_blocks(percent)), "a binary, b binary")
    )


def _with_roots(likely: DataFrame, order: int, roots: DataFrame) -> DataFrame:
    of = roots.withColumnRenamed("id", "of")
    return (
        _postings(likely, order)
        .join(of, F.col("id") == F.col("of"), "left")
        .withColumn("root", F.coalesce("root", "id"))
        .drop("of")
    )


def _joined_roots(roots: DataFrame, links: DataFrame, stage) -> DataFrame:
    """Components of what is known, as stars, and of new links."""
    known = roots.select(F.col("id").alias("a"), F.col("root").alias("b"))
    return connected_components(known.unionAll(links), stage)


def _buckets(texts: DataFrame) -> tuple[int, int]:
    """Buckets of bounded text, one per task at any size of the input, and the partitions for them."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(total) // BUCKET_BYTES))
    return buckets, min(buckets, MOST_PARTITIONS)


def _posted(texts: DataFrame, buckets: int, partitions: int, percent: int | None) -> DataFrame:
    """Document rows and postings, by bucket."""
    return (
        texts.mapInPandas(
            handing_back(_send_sets(buckets, percent)),
            "bucket int, doc string, row string, digest binary, n long, blob binary",
        )
        .repartitionById(partitions, "bucket")
        .sortWithinPartitions("bucket")
    )


def similar_groups(docs: DataFrame, stage, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    ``row_key`` finds the document's row again; ``component_root`` names the group by a set's digest.

    ``stage`` writes a table once and returns its reader.
    """
    binary = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = docs.select(
        F.col("doc_id").cast("string").alias("doc"), row_key().alias("row"), binary.alias("text")
    )
    buckets, partitions = _buckets(texts)
    homes = -(-buckets // BUCKETS_A_HOME)
    met = stage(
        _posted(texts, buckets, partitions, percent).mapInPandas(
            handing_back(_meet_firsts(homes)), "doc string, row string, digest binary, n long, home int, blob binary"
        ),
        "shared-firsts",
    )
    sharing = (
        met.filter("home >= 0")
        .select("home", "blob")
        .repartitionById(homes, "home")
        .sortWithinPartitions("home")
        .mapInPandas(handing_back(_keep_sharing(percent)), "id binary")
    )
    # One row stands for all of a set.
    stands = met.filter("home < 0").groupBy("digest").agg(F.min("row").alias("row"))
    chosen = stands.join(sharing, F.col("digest") == F.col("id")).select("row")
    texts = stage(texts.join(chosen, "row", "left_semi"), "sharing-texts")

    buckets, partitions = _buckets(texts)
    prefixes = ", ".join(f"prefix{at} array<bigint>" for at in range(ORDERS))
    likely = stage(
        _posted(texts, buckets, partitions, None)
        .filter("blob is not null")
        .select("bucket", "blob")
        .mapInPandas(handing_back(_meet_shingles(buckets)), "home int, blob binary")
        .repartitionById(partitions, "home")
        .sortWithinPartitions("home")
        .mapInPandas(
            handing_back(_keep_likely(percent)), f"id binary, n long, alone double, shared binary, {prefixes}"
        ),
        "likely-sets",
    )
    roots = likely.select("id", F.col("id").alias("root")).limit(0)
    for turn in range(len(LEADERS_TRIED)):
        pairs = _leader_pairs(_with_roots(likely, 0, roots), percent, turn)
        links = stage(_verified(pairs, likely, percent), "leader-links")
        roots = _joined_roots(roots, links, stage)
    homes = _homes(_with_roots(likely, 0, roots), stage)
    held = stage(_placed_postings(likely, homes), "postings")
    visits = stage(_visits(held, homes), "visits")
    guests = visits.join(homes.select("id", "root"), "id").select("id", "root", F.col("visited").alias("home"))
    present = homes.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    inside = stage(_home_links(stage(present, "present"), likely, percent), "home-links")
    seats = stage(_open_seats(held, visits), "open-seats")
    crossing = stage(_crossing_pairs(seats, percent), "candidates")
    found = stage(_verified(crossing, likely, percent), "crossing-links")
    roots = _joined_roots(roots, inside.unionAll(found), stage)

    rows = met.filter("home < 0").select(
        F.col("doc").cast(docs.schema["doc_id"].dataType).alias("doc_id"),
        F.col("row").alias("row_key"),
        "digest",
        F.col("n").alias("n_shingles"),
    )
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("first"))
    rooted = firsts.join(roots, F.col("digest") == F.col("id"), "left").select(
        F.col("digest").alias("set"), "first", F.coalesce("root", "digest").alias("component_root")
    )
    smallest = rooted.groupBy(F.col("component_root").alias("of")).agg(F.min("first").alias("smallest"))
    named = rooted.join(smallest, F.col("component_root") == F.col("of"))
    blank = F.col("n_shingles") == 0
    return rows.join(named, F.col("digest") == F.col("set")).select(
        "doc_id",
        "n_shingles",
        F.when(blank, F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        "row_key",
        "component_root",
    )


def row_key() -> Column:
    """A document's id and text in one short value; only repeated rows share it."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return F.concat_ws("|", F.md5(text), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))


def keep_one(docs: DataFrame, stage, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id, once.

    Documents without words are in no group and all stay.
    """
    groups = similar_groups(docs, stage, percent)
    choice = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    kept = (
        groups.filter("n_shingles > 0")
        .groupBy("component_root")
        .agg(choice.alias("kept"))
        .select(F.col("kept.row_key").alias("_kept"))
    )
    once = Window.partitionBy("_row").orderBy(F.lit(0))
    blank = F.regexp_replace(F.coalesce("text", F.lit("")), BREAK_PATTERN, "") == ""
    # The document travels as one struct, so its columns may have any names.
    return (
        docs.select(F.struct("*").alias("_document"), row_key().alias("_row"), blank.alias("_blank"))
        .join(kept, F.col("_row") == F.col("_kept"), "left")
        .withColumn("_turn", F.row_number().over(once))
        .filter(F.col("_blank") | (F.col("_kept").isNotNull() & (F.col("_turn") == 1)))
        .select("_document.*")
    )
