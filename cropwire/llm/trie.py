"""Conversation prefix trie: a double-array trie per shard of prefixes, shared upper nodes merged globally.

Conversations become paths of 128-bit turn keys. Equal paths are folded into
one, then dealt to shards by ranges of their order, so that a shard holds
neighbouring prefixes and a very common first turn or conversation is split
like any other. A shard packs its paths into BASE and CHECK arrays over dense
turn ids and walks them. Only nodes on a shard's first and last path can have
members elsewhere; their partial figures are merged by node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropwire.llm.common import cut, read_table
from cropwire.llm.words import mix

#: Turns of a shard: at least so many, if that leaves shards for all shuffle partitions, and at most.
FEW_TURNS, MOST_TURNS = 1 << 12, 1 << 19
#: Conversation ids of one chunk of a path's ids.
ID_BITS = 12
#: Free places tried for a node with several children before it goes behind all others.
TRIES = 8
#: Hash of no ids.
NO_IDS = hashlib.sha256(b"").hexdigest()
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
         "shard long, path long, size long, a long, b long, parent_a long, parent_b long, shared boolean, shared_parent boolean")
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class DoubleArray:
    """A trie over dense turn ids: the child of node s by turn t is slot BASE[s] + t, if CHECK there is s. The root is slot 0."""

    def __init__(self) -> None:
        self.base = np.zeros(16, np.int64)
        self.check = np.full(16, -1, np.int64)
        self.used = np.zeros(16, bool)
        self.used[0] = True
        self.low, self.top = 1, 1  # no slot below low is free, none from top on is used

    def _reach(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])
            self.used = np.concatenate([self.used, np.zeros(more, bool)])

    def _free(self, n: int) -> np.ndarray:
        """The first ``n`` free slots."""
        self._reach(self.top + n)
        found = self.low + np.flatnonzero(~self.used[self.low:self.top + n])[:n]
        self.low = int(found[0])
        return found

    def _take(self, node, base, slots) -> None:
        self.base[node] = base
        self.check[slots] = node
        self.used[slots] = True
        self.top = max(self.top, int(np.max(slots)) + 1)

    def add(self, nodes: np.ndarray, starts: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """Give ``nodes`` their children, the turns from ``starts`` on; returns the children's slots."""
        sizes = np.diff(np.append(starts, len(turns)))
        slots = np.empty(len(turns), np.int64)
        for i in np.flatnonzero(sizes > 1):
            own = turns[starts[i]:starts[i] + sizes[i]]
            relative = own - own.min()
            self._reach(self.top + int(relative.max()) + TRIES + 1)
            for first in [*self._free(TRIES), self.top]:
                if not self.used[first + relative].any():
                    break
            at = first + relative
            self._take(nodes[i], first - own.min(), at)
            slots[starts[i]:starts[i] + sizes[i]] = at
        one = np.flatnonzero(sizes == 1)
        if len(one):
            at = self._free(len(one))
            self._take(nodes[one], at - turns[starts[one]], at)
            slots[starts[one]] = at
        return slots

    def step(self, nodes: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of ``nodes`` by ``turns``, -1 where there are none."""
        at = self.base[nodes] + turns
        there = (at >= 0) & (at < len(self.check))
        return np.where(there & (self.check[np.where(there, at, 0)] == nodes), at, -1)


def pack(turns: np.ndarray, offsets: np.ndarray) -> tuple[DoubleArray, np.ndarray]:
    """The double array of sorted distinct paths (``turns[offsets[i]:offsets[i + 1]]`` numbers the turns), and the dense ids of the turn numbers.

    Dense ids are given in breadth-first order, so that a node's children mostly have neighbouring ones.
    """
    trie, dense = DoubleArray(), np.full(int(turns.max(initial=-1)) + 1, -1, np.int64)
    lengths, known = np.diff(offsets), 0
    alive, at = np.flatnonzero(lengths > 0), np.zeros(int((lengths > 0).sum()), np.int64)
    depth = 0
    while len(alive):
        raw = turns[offsets[alive] + depth]
        new = np.ones(len(alive), bool)
        new[1:] = (at[1:] != at[:-1]) | (raw[1:] != raw[:-1])
        child = np.flatnonzero(new)
        unseen = raw[child][dense[raw[child]] < 0]
        _, first = np.unique(unseen, return_index=True)
        fresh = unseen[np.sort(first)]
        dense[fresh] = known + np.arange(len(fresh))
        known += len(fresh)
        parents, starts = np.unique(at[child], return_index=True)
        order = np.argsort(starts)
        slots = trie.add(parents[order], starts[order], dense[raw[child]])
        at = slots[np.cumsum(new) - 1]
        depth += 1
        stay = lengths[alive] > depth
        alive, at = alive[stay], at[stay]
    return trie, dense


def nodes_of(keys: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, copies: np.ndarray, least: np.ndarray, ends: list[str], shard: int) -> pa.RecordBatch:
    """All nodes of one shard's sorted distinct paths, by a walk through their double array."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    turns = np.empty(len(keys), np.int64)
    turns[order] = np.cumsum(np.concatenate([[0], (np.diff(keys[order], axis=0) != 0).any(axis=1)])) if len(keys) else 0
    trie, dense = pack(turns, offsets)
    dense_turns, size = dense[turns], len(trie.used)
    n, low, depth, words = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64), np.zeros(size, np.int64)
    chain = np.zeros((2, size), np.uint64)
    shared, side, end = np.zeros(size, bool), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    # The walk: every path at once, a turn at a time.
    lengths, alive, at, d, levels, last = np.diff(offsets), np.arange(len(copies)), np.zeros(len(copies), np.int64), 0, [], []
    while len(alive):
        np.add.at(n, at, copies[alive])
        np.minimum.at(low, at, least[alive])
        depth[at] = d
        levels.append(np.unique(at))
        if alive[0] == 0:
            shared[at[0]], side[at[0]] = True, 2 * shard
        if alive[-1] == len(copies) - 1:
            last.append(at[-1])
            shared[at[-1]] = True
        stop = lengths[alive] == d
        end[at[stop]] = alive[stop]
        alive, at = alive[~stop], at[~stop]
        step = trie.step(at, dense_turns[offsets[alive] + d])
        if (step < 0).any():
            raise AssertionError("a path left the trie")
        words[step] = sizes[offsets[alive] + d]
        for i in range(2):
            chain[i][step] = mix(chain[i][at] * _ODD[i] + keys[offsets[alive] + d, i].view(np.uint64) + np.uint64(d + 1))
        at, d = step, d + 1
    slots = np.concatenate(levels) if levels else np.empty(0, np.int64)
    parent = trie.check
    below = slots[slots != 0]
    own = np.zeros(size, np.int64)
    np.add.at(own, parent[below[~shared[below]]], 1)
    everything = np.zeros(size, np.int64)
    np.add.at(everything, parent[below], 1)
    leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for level in reversed(levels):
        mine = level[~shared[level]]
        leaves[mine] += everything[mine] == 0
        saved[mine] += (n[mine] - 1) * words[mine]
        up = mine[mine != 0]
        np.add.at(leaves, parent[up], leaves[up])
        np.add.at(saved, parent[up], saved[up])
    up = np.where(slots == 0, 0, parent[slots])
    text = [ends[i] if i >= 0 else None for i in end[slots]]
    columns = {
        "conv_id": low[slots], "depth": depth[slots], "parent_conv_id": low[up], "n_convs": n[slots], "n_children": own[slots],
        "n_leaves": leaves[slots], "saved_tokens": saved[slots], "ends_sha256": text, "shard": np.full(len(slots), shard),
        "path": side[slots], "size": words[slots], "a": chain[0][slots].view(np.int64), "b": chain[1][slots].view(np.int64),
        "parent_a": chain[0][up].view(np.int64), "parent_b": chain[1][up].view(np.int64), "shared": shared[slots], "shared_parent": shared[up]}
    # Nodes of the last path alone, and once more, without figures, those that are on the first path too.
    twice = np.isin(slots, np.array([s for s in last if side[s] >= 0], np.int64)) if len(copies) > 1 else np.zeros(len(slots), bool)
    columns["path"] = np.where(shared[slots] & (columns["path"] < 0), 2 * shard + 1, columns["path"])
    first = pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "ends_sha256" else None) for k, v in columns.items()})
    if not twice.any():
        return first
    again = first.filter(pa.array(twice)).to_pydict()
    rows = int(twice.sum())
    again |= {k: [0] * rows for k in ("n_convs", "n_children", "n_leaves", "saved_tokens")} | {"path": [2 * shard + 1] * rows, "ends_sha256": [None] * rows}
    second = pa.RecordBatch.from_pydict({k: pa.array(v, first.schema.field(k).type) for k, v in again.items()})
    return pa.Table.from_batches([first, second]).combine_chunks().to_batches()[0]


def _shard_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sorted rows (path, chunk, ids, n, least) as its nodes; the ids of a path are hashed chunk by chunk as they come."""
    keys, sizes, lengths, copies, least, ends, known, sha = [], [], [], [], [], [], None, None
    for batch in batches:
        path = batch.column("path")
        flat = path.flatten()
        part = np.column_stack([flat.field("a").to_numpy(), flat.field("b").to_numpy()]) if len(flat) else np.empty((0, 2), np.int64)
        bytes_ = flat.field("size").to_numpy().astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(path.value_lengths().to_numpy())]).astype(np.int64)
        for i, (a, b, ids, n, low) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("path_a", "path_b", "ids", "n", "least")))):
            if (a, b) != known:
                if sha is not None:
                    ends.append(sha.hexdigest())
                known, sha = (a, b), hashlib.sha256(ids.encode())
                keys.append(part[bounds[i]:bounds[i + 1]])
                sizes.append(bytes_[bounds[i]:bounds[i + 1]])
                lengths.append(len(keys[-1]))
                copies.append(n)
                least.append(low)
            else:
                sha.update(b"," + ids.encode())
                copies[-1] += n
                least[-1] = min(least[-1], low)
    if sha is None:
        return
    ends.append(sha.hexdigest())
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    shard = TaskContext.get().partitionId()
    nodes = nodes_of(np.ascontiguousarray(np.concatenate(keys)), np.concatenate(sizes), offsets, np.array(copies), np.array(least), ends, shard)
    for at in range(0, nodes.num_rows, 1 << 16):
        yield nodes.slice(at, 1 << 16)


def conversation_paths(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, path): each conversation's turns in order as (a, b, size): two 64-bit hashes of role and text, and the text's UTF-8 bytes.

    Turns are ordered by ``turn``, null first, those of equal number by the hashes. Null roles and texts are empty; rows without a conversation are left out.
    """
    return _paths(_keyed(turns, conv_id, turn, role, text), "conv_id")


def _keyed(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.xxhash64(r, t).alias("a"), F.xxhash64(t, r, F.lit(1)).alias("b"),
        F.octet_length(t).alias("size"))


def _paths(keyed: DataFrame, *by: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("set"), "turn", "a", "b", "size")))
    return keyed.groupBy(*by).agg(F.transform(rows, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["size"].alias("size"))).alias("path"))


def rebuilt_paths(turns: DataFrame, family: int = 5, modulus: int = 9, **names: str) -> DataFrame:
    """(conv_id, path): the first h turns of conversation c - c % ``family`` (none if absent), then c's own turns behind its first h; h = crc32(c as text) % ``modulus``.

    One shuffle: the conversations of a family come together by their common first one.
    """
    keyed = _keyed(turns, **({"conv_id": "conv_id", "turn": "turn", "role": "role", "text": "text"} | names))
    first = F.col("conv_id") - F.col("conv_id") % family
    own = _paths(keyed.withColumn("family", first).repartition("family"), "family", "conv_id")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus
    head = F.when(F.col("conv_id") == F.col("family"), F.slice("path", 1, modulus))
    return (own.groupBy("family").agg(F.max(head).alias("head"), F.collect_list(F.struct("conv_id", "path")).alias("c"))
            .select("head", F.inline("c")).withColumn("h", h.cast("int"))
            .select("conv_id", F.concat(F.slice(F.coalesce("head", F.slice("path", 1, 0)), F.lit(1), F.col("h")),
                                        F.expr("slice(path, h + 1, greatest(size(path) - h, 0))")).alias("path")))


def prefix_trie(paths: DataFrame) -> DataFrame:
    """A row for each node of the trie of ``paths`` (conv_id, path): the distinct sequences of first turns, the textless root included.

    conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves (childless nodes in the subtree),
    saved_tokens (over the subtree, (n_convs - 1) times the bytes of the last
    text) and ends_sha256 (of the comma-joined ascending ids of the
    conversations that end there). Without conversations there is no node.

    A conversation's path, 20 bytes a turn, is one value; no group of
    conversations is ever one. Paths with equal turns are told apart by 128 bits.
    """
    spark = paths.sparkSession
    chunk = F.shiftright("conv_id", ID_BITS)
    folded = cut(paths.withColumn("chunk", chunk).groupBy("path", "chunk")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"),
                      F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
                 .withColumn("path_a", F.xxhash64("path")).withColumn("path_b", F.xxhash64(F.lit(1), "path")), "paths")
    turns = folded.agg(F.sum(F.size("path") + 1).alias("n")).first()["n"] or 0
    shards = max(1, ceil(turns / MOST_TURNS), min(ceil(turns / FEW_TURNS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    nodes = cut(folded.repartitionByRange(shards, "path").sortWithinPartitions("path", "chunk").mapInArrow(_shard_nodes, _NODE), "nodes")
    return _merged(nodes)


def _merged(nodes: DataFrame) -> DataFrame:
    key, parent = ["a", "b"], ["parent_a", "parent_b"]
    inner, edge = nodes.filter("NOT shared"), nodes.filter("shared")
    upper = edge.groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_a").alias("parent_a"), F.max("parent_b").alias("parent_b"),
        F.max("size").alias("size"), F.min("path").alias("path"), F.max("ends_sha256").alias("ends_sha256"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    kids = upper.filter("depth > 0").groupBy(*[F.col(p).alias(k) for p, k in zip(parent, key)]).agg(F.count(F.lit(1)).alias("kids"))
    upper = cut(upper.join(kids, key, "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
                .withColumn("n_leaves", F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
                .withColumn("saved_tokens", F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).drop("kids"), "upper")
    # A shared node's own figures count on one of the paths that it is on, and there for all nodes above it.
    figures = upper.select(*key, F.col("path").alias("own"), "n_leaves", "saved_tokens")
    to_top = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.col("path") == F.col("own")
    totals = (edge.select("path", "depth", *key).join(figures, key)
              .select(*key, *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(to_top).alias(c) for c in ("n_leaves", "saved_tokens")])
              .groupBy(*key).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    names = upper.select(F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), F.col("conv_id").alias("parent"))
    top = (upper.drop("n_leaves", "saved_tokens").join(totals, key).join(names, parent, "left")
           .withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("parent"))))
    # Children of shared nodes learn their parent's smallest member shard by shard, as the root may have most of all nodes.
    of_shard = (edge.select("shard", *key).distinct().join(upper.select(*key, F.col("conv_id").alias("parent")), key)
                .select("shard", F.col("a").alias("parent_a"), F.col("b").alias("parent_b"), "parent"))
    under = (inner.filter("shared_parent").join(of_shard, ["shard", *parent], "left").withColumn("parent_conv_id", F.col("parent")))
    out = inner.filter("NOT shared_parent").select(*_RESULT).unionByName(under.select(*_RESULT)).unionByName(top.select(*_RESULT))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_paths(read_table(spark, sf_dir, "conversations")))


#: Recomputed in SQL by prefixes as texts; sums over subtrees go along the path of each node's smallest member.
OP13_SQL = """WITH t AS (SELECT conv_id, coalesce(role, '') r, coalesce(text, '') x,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 b, xor(4294967295, list_reduce([4294967295::BIGINT] ||
  [CAST(ascii(ch) AS BIGINT) for ch in string_split(CAST(conv_id AS VARCHAR), '')],
  lambda acc, ch: list_reduce([xor(acc, ch), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % 9 h
  FROM (SELECT DISTINCT conv_id FROM t)),
u AS (SELECT c.conv_id, p, r, x FROM c JOIN t ON t.conv_id = c.b WHERE p < h UNION ALL SELECT conv_id, p, r, x FROM t JOIN c USING (conv_id) WHERE p >= h),
d AS (SELECT conv_id, row_number() OVER w AS depth, octet_length(encode(x)) n, md5(string_agg(md5(r) || md5(x), '') OVER w) k FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
a AS (SELECT *, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY depth), '') pk FROM d UNION ALL SELECT conv_id, 0, 0, '', NULL FROM c),
e AS (SELECT conv_id, max(depth) last FROM a GROUP BY 1),
g AS (SELECT k, any_value(pk) pk, any_value(depth) depth, any_value(n) n, count(*) m, min(conv_id) least,
  coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = last), '') ends FROM a JOIN e USING (conv_id) GROUP BY 1),
f AS (SELECT g.*, coalesce(ch, 0) ch FROM g LEFT JOIN (SELECT pk k2, count(*) ch FROM g WHERE pk IS NOT NULL GROUP BY 1) ON k = k2),
s AS (SELECT a.k, sum(CASE WHEN a.conv_id = least AND ch = 0 THEN 1 ELSE 0 END) OVER w l, sum(CASE WHEN a.conv_id = least THEN (m - 1) * f.n ELSE 0 END) OVER w sv
  FROM a JOIN f USING (k) WINDOW w AS (PARTITION BY a.conv_id ORDER BY a.depth DESC)),
z AS (SELECT k, sum(l) l, sum(sv) sv FROM s GROUP BY 1)
SELECT f.least AS conv_id, CAST(f.depth AS BIGINT) AS depth, q.least AS parent_conv_id, f.m AS n_convs, f.ch AS n_children, CAST(l AS BIGINT) AS n_leaves,
  CAST(sv AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256 FROM f JOIN z USING (k) LEFT JOIN f q ON q.k = f.pk"""
