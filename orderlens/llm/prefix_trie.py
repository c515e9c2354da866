"""Prefix trie of conversations as balanced parentheses, shard by shard.

Every conversation is a path of turn keys (16 bytes of a SHA-256 over role and text). Equal paths are
counted before anything moves, the distinct ones are range-partitioned by path, and each range (a
shard) is a run of the trie in depth-first order. A shard writes its nodes as parentheses and reads all
measures off that string:

* excess (opened minus closed) per position, with the minimum per block and a tree over the block
  minima; ``find_close`` of a node is the first later position with less excess than the node's own;
* a leaf is a pair ``()``; leaves below a node are a difference of two ranks of such pairs;
* members, savings and the like are differences of cumulative arrays over the nodes in preorder.

The spine that a shard shares with its neighbours (the beginning common to its first path and the last
path of the shard before, and the same at its other end) is reported separately, with what hangs
below it inside the shard. Spines of all shards merge in one small step: two chains per shard.

A path is one row, so a conversation's keys (16 bytes a turn) must fit into a row; texts never move. Ids
of conversations that end at one node are hashed in order as a stream, however many they are.

Edge cases: a NULL role or text is empty; NULL turn numbers come first; turns with equal numbers are
ordered by key; rows without a conversation id belong to none and are left out; an empty table gives an empty
result (no root); repeated rows are turns of their own; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import word_count

KEY = 16
BLOCK = 64
SHARD_NODES = 200_000


def turn_key(role: Column, text: Column) -> Column:
    """Stands for (role, text); the length keeps the two apart."""
    keyed = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(keyed, 256), 1, 2 * KEY))


def conversation_keys(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``keys`` (turn key and words of its text) in order."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            turn_key(role, text).alias("key"),
            word_count(text).alias("words"),
        ).alias("one"),
    )
    # sort_array puts NULL turn numbers first.
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("keys"))


def paths(rebuilt: DataFrame) -> DataFrame:
    """Conversations as one binary path and the words along it."""
    return rebuilt.select(
        "conv_id",
        F.array_join(F.transform("keys", lambda one: F.hex(one["key"])), "").alias("hexed"),
        F.transform("keys", lambda one: one["words"]).alias("words"),
    ).select("conv_id", F.unhex("hexed").alias("path"), "words")


# -- one shard ---------------------------------------------------------------------------------


class Parentheses:
    """A balanced string of parentheses with block minima of its excess."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int32)
        blocks = -(-len(opens) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(opens)] = self.excess
        level = padded.reshape(blocks, BLOCK).min(axis=1) if blocks else padded
        self.levels = [level]
        while len(level) > 1:
            if len(level) % 2:
                level = np.append(level, np.iinfo(np.int32).max)
            level = level.reshape(-1, 2).min(axis=1)
            self.levels.append(level)
        pair = opens[:-1] & ~opens[1:]
        self.pairs = np.concatenate(([0], np.cumsum(pair)))

    @staticmethod
    def _low(level: np.ndarray, node: np.ndarray, aim: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Which of the asked nodes reach down to their aim."""
        low = np.zeros(len(node), bool)
        inside = asked & (node < len(level))
        low[inside] = level[node[inside]] <= aim[inside]
        return low

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """For each open position the position of its closing parenthesis."""
        target = self.excess[at] - 1
        found = np.full(len(at), -1, np.int64)
        place = at + 1
        active = np.arange(len(at))
        # Inside the block first.
        for _ in range(BLOCK):
            if not len(active):
                break
            here = place[active]
            hit = self.excess[here] == target[active]
            found[active[hit]] = here[hit]
            active = active[~hit]
            place[active] += 1
            active = active[place[active] % BLOCK != 0]
        left = np.flatnonzero(found < 0)
        if not len(left):
            return found
        # Then up the tree of minima until a node on the right goes low enough, and down to its block.
        node = place[left] // BLOCK
        aim = target[left]
        height = np.zeros(len(left), np.int64)
        climbing = np.ones(len(left), bool)
        for level in self.levels:
            climbing &= ~self._low(level, node, aim, climbing)
            sibling = climbing & (node % 2 == 0)
            node[sibling] += 1
            climbing &= ~self._low(level, node, aim, sibling)
            node[climbing] = node[climbing] // 2 + 1
            height[climbing] += 1
        for depth in range(len(self.levels) - 1, 0, -1):
            going = height == depth
            if not going.any():
                continue
            node[going] *= 2
            level = self.levels[depth - 1]
            right = going & (level[np.minimum(node, len(level) - 1)] > aim)
            node[right] += 1
            height[going] -= 1
        place = node * BLOCK
        active = np.arange(len(left))
        for _ in range(BLOCK):
            if not len(active):
                break
            hit = self.excess[place[active]] == aim[active]
            found[left[active[hit]]] = place[active[hit]]
            active = active[~hit]
            place[active] += 1
        return found


def common_prefix(one: bytes, two: bytes) -> int:
    """Number of whole keys that two paths begin with."""
    limit = min(len(one), len(two)) // KEY
    low = 0
    while low < limit and one[low * KEY : (low + 1) * KEY] == two[low * KEY : (low + 1) * KEY]:
        low += 1
    return low


INNER = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
MEASURED = f"{INNER}, words long, spine binary, parent_spine binary"
MERGED = f"{INNER}, spine binary"
NODE_COLUMNS = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _parents(depth: np.ndarray) -> np.ndarray:
    """Preorder number of each node's parent, -1 for the root."""
    out = np.full(len(depth), -1, np.int64)
    way: list[int] = []
    for node, level in enumerate(depth.tolist()):
        del way[level:]
        if way:
            out[node] = way[-1]
        way.append(node)
    return out


def _written(listed: list[bytes], along: list) -> tuple[np.ndarray, ...]:
    """Parentheses of sorted distinct paths; depth, words and row of each node; last node of each row."""
    opens, depths, words, row_of = [], [], [], []
    last = np.empty(len(listed), np.int64)
    former: bytes | None = None
    nodes = 0
    for row, path in enumerate(listed):
        length = len(path) // KEY
        start = 0 if former is None else common_prefix(former, path) + 1
        if former is not None:
            opens.append(np.zeros(len(former) // KEY + 1 - start, bool))
        added = length + 1 - start
        opens.append(np.ones(added, bool))
        depths.append(np.arange(start, length + 1))
        counts = np.asarray(along[row], np.int64)
        words.append(counts[start - 1 :] if start else np.concatenate(([0], counts)))
        row_of.append(np.full(added, row))
        nodes += added
        last[row] = nodes - 1
        former = path
    opens.append(np.zeros(len(former) // KEY + 1, bool))
    return *(np.concatenate(parts) for parts in (opens, depths, words, row_of)), last


def measure_shard(rows: pa.Table) -> pa.Table:
    """Nodes of one shard, given its distinct paths and how deep its spines are (-1: no neighbour).

    Rows with ``spine`` are nodes that other shards have as well; they carry what this shard adds: members,
    and below them leaves, children and savings that are on no spine. All other rows are final but
    for a parent on a spine.
    """
    rows = rows.sort_by("path")
    listed = rows.column("path").to_pylist()
    left, right = (rows.column(name)[0].as_py() for name in ("shared_left", "shared_right"))
    opens, depth, word, row_of, last = _written(listed, rows.column("words").to_pylist())
    string = Parentheses(opens)
    at = np.flatnonzero(opens)
    close = string.find_close(at)
    nodes = len(at)
    first = np.arange(nodes)
    beyond = first + (close - at + 1) // 2
    parents = _parents(depth)

    def below(values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[beyond] - total[first]

    on_spine = np.zeros(nodes, bool)
    on_spine[: left + 1] = True
    way = last[-1]
    while way >= 0:
        on_spine[way] |= depth[way] <= right
        way = parents[way]

    ending = np.zeros(nodes, np.int64)
    ending[last] = rows.column("members").to_numpy()
    members = below(ending)
    leaves = string.pairs[close] - string.pairs[at]
    if right == depth[last[-1]]:
        # The last path goes on in the next shard: its end only looks like a leaf here.
        leaves[beyond == nodes] -= 1
    saved = below(np.where(on_spine, 0, (members - 1) * word))
    children = np.bincount(parents[~on_spine & (parents >= 0)], minlength=nodes)
    least = np.full(nodes, np.iinfo(np.int64).max)
    least[last] = rows.column("least").to_numpy()
    smallest = least.tolist()
    above = parents.tolist()
    for node in range(nodes - 1, 0, -1):
        if smallest[node] < smallest[above[node]]:
            smallest[above[node]] = smallest[node]
    least = np.asarray(smallest, np.int64)
    ends = [None if spine else EMPTY_SHA256 for spine in on_spine]
    for node, digest in zip(last.tolist(), rows.column("ends").to_pylist()):
        ends[node] = digest

    def key(node: int) -> bytes:
        return listed[row_of[node]][: depth[node] * KEY]

    under_spine = (parents >= 0) & on_spine[parents]
    unknown = (parents < 0) | under_spine
    return pa.table(
        {
            "conv_id": least,
            "depth": depth,
            "parent_conv_id": pa.array(least[parents], mask=unknown),
            "n_convs": members,
            "n_children": children.astype(np.int64),
            "n_leaves": leaves,
            "saved_tokens": saved,
            "ends_sha256": pa.array(ends, pa.string()),
            "words": word,
            "spine": pa.array(
                [key(node) if flag else None for node, flag in enumerate(on_spine)], pa.binary()
            ),
            "parent_spine": pa.array(
                [
                    key(above[node]) if flag and not on_spine[node] else None
                    for node, flag in enumerate(under_spine)
                ],
                pa.binary(),
            ),
        }
    )


def merge_spines(rows: pa.Table) -> pa.Table:
    """Final numbers of the spine nodes, whose ancestors are all spine nodes."""
    nodes = {row["spine"]: row for row in rows.to_pylist()}
    for row in nodes.values():
        row["saved_tokens"] += (row["n_convs"] - 1) * row["words"]
    own = {spine: (row["n_convs"] - 1) * row["words"] for spine, row in nodes.items()}
    for spine in sorted(nodes, key=len, reverse=True):
        row = nodes[spine]
        above = nodes.get(spine[:-KEY]) if spine else None
        row["parent_conv_id"] = above["conv_id"] if above else None
        if above:
            above["n_children"] += 1
            above["saved_tokens"] += own[spine]
            own[spine[:-KEY]] += own[spine]
    schema = pa.schema(
        [(name, pa.string() if name == "ends_sha256" else pa.int64()) for name in NODE_COLUMNS]
        + [("spine", pa.binary())]
    )
    return pa.Table.from_pylist(
        [{name: row[name] for name in schema.names} for row in nodes.values()], schema
    )


# -- all shards --------------------------------------------------------------------------------


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node; rows come by node and id."""
    done: list[tuple[bytes, str]] = []
    node, state = None, None

    def batch() -> pa.RecordBatch:
        keys, digests = zip(*done)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["end", "ends"]
        )

    for block in batches:
        for of_node, conv in zip(block.column("end").to_pylist(), block.column("conv_id").to_pylist()):
            if of_node == node:
                state.update(f",{conv}".encode())
                continue
            if state is not None:
                done.append((node, state.hexdigest()))
            node, state = of_node, hashlib.sha256(str(conv).encode())
        if done:
            yield batch()
            done = []
    if state is not None:
        done.append((node, state.hexdigest()))
        yield batch()


def _shared_keys(one: Column, two: Column) -> Column:
    @F.pandas_udf("int")
    def shared(ones: pd.Series, twos: pd.Series) -> pd.Series:
        return pd.Series(
            [-1 if a is None or b is None else common_prefix(a, b) for a, b in zip(ones, twos)]
        )

    return shared(one, two)


def distinct_paths(ended: DataFrame) -> DataFrame:
    """Each path once: members, the smallest of them, and the digest of their ids in order."""
    node = F.unhex(F.substring(F.sha2("path", 256), 1, 2 * KEY))
    counted = ended.groupBy("path").agg(
        F.min("conv_id").alias("least"),
        F.count(F.lit(1)).alias("members"),
        F.first("words").alias("words"),
    )
    hashed = (
        ended.select(node.alias("end"), "conv_id")
        .repartition("end")
        .sortWithinPartitions("end", "conv_id")
        .mapInArrow(_hash_ids, "end binary, ends string")
    )
    return counted.withColumn("of_end", node).join(hashed, F.col("of_end") == F.col("end")).drop(
        "of_end", "end"
    )


def trie_nodes(rebuilt: DataFrame, stage, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row per node of the trie over ``conversation_keys`` rows."""
    distinct = stage(distinct_paths(stage(paths(rebuilt), "trie-paths")), "trie-distinct")
    total = distinct.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_nodes))
    ranged = stage(
        distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()),
        "trie-shards",
    )
    # Two paths per shard, in one small window.
    order = Window.orderBy("shard")
    bounds = ranged.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    bounds = bounds.select(
        F.col("shard").alias("of_shard"),
        _shared_keys(F.lag("high").over(order), F.col("low")).alias("shared_left"),
        _shared_keys(F.col("high"), F.lead("low").over(order)).alias("shared_right"),
    )
    measured = stage(
        ranged.join(bounds, F.col("shard") == F.col("of_shard"))
        .groupBy("shard")
        .applyInArrow(measure_shard, MEASURED),
        "trie-nodes",
    )
    spines = (
        measured.filter("spine is not null")
        .groupBy("spine")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.first("depth").alias("depth"),
            F.first("words").alias("words"),
            *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.coalesce(F.max("ends_sha256"), F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )
    merged = stage(spines.groupBy().applyInArrow(merge_spines, MERGED), "trie-spines")
    inner = measured.filter("spine is null")
    heads = merged.select(F.col("spine").alias("head"), F.col("conv_id").alias("head_conv"))
    hanging = (
        inner.filter("parent_spine is not null")
        .join(heads, F.col("parent_spine") == F.col("head"))
        .withColumn("parent_conv_id", F.col("head_conv"))
    )
    parts = (inner.filter("parent_spine is null"), hanging, merged)
    first, *others = (part.select(*NODE_COLUMNS) for part in parts)
    for other in others:
        first = first.unionByName(other)
    return first
