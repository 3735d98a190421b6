"""Hard-negative mining: Strassen products of anchor and candidate tiles, mergeable positive and window heaps.

Two passes over the same tiles. The first finds each anchor's positives (bounded
heaps of the best rows of its label), the second the rows of other labels
whose score lies in the window that each positive's score opens. A heap is a
sorted list of at most k entries; partial heaps of the shards are merged in a tree.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm.common import cut, read_table
from cropwire.llm.tiles import matrix
from cropwire.llm.topk import EXACT, quantise

#: Components of a tile's side; with vectors of 64 components a side has 8,192 rows.
TILE_CELLS = 1 << 19
#: Rows of a tile's side at most, however short the vectors.
TILE_ROWS = 1 << 13
#: Anchors whose scores against a shard are held at once.
SCORED_AT_ONCE = 256
#: Sides up to this length are multiplied plainly.
LEAF = 32
#: Partial heaps that one merge takes together.
FAN_IN = 16
_LONG = np.iinfo(np.int64)


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain product; through doubles where every sum is proven to be exact there."""
    if a.dtype == np.int64 and a.size and b.size:
        largest = max(-int(a.min()), int(a.max())) * max(-int(b.min()), int(b.max())) * a.shape[1]
        if largest < EXACT:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of whole numbers by Strassen's seven half-size products.

    Sides of odd length are padded with zeros. On int64 every addition is exact
    modulo 2^64, so the product is right whenever it fits an int64 itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return _leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), a.dtype)
    p1, p4 = strassen(a11 + a22, b11 + b22), strassen(a22, b21 - b11)
    p5, p7 = strassen(a11 + a12, b22), strassen(a12 - a22, b21 + b22)
    out[:i, :l] = p1 + p4 - p5 + p7
    p3 = strassen(a11, b12 - b22)
    out[:i, l:] = p3 + p5
    p2 = strassen(a21 + a22, b11)
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12)
    return out[:m, :n]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` and ``b`` (doubles holding whole numbers) as int64; sums beyond a long are clipped."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if bound < 2.0 ** 62:
        return strassen(a.astype(np.int64), b.T.astype(np.int64))
    whole = np.frompyfunc(int, 1, 1)
    return np.clip(strassen(whole(np.nan_to_num(a)), whole(np.nan_to_num(b.T))), _LONG.min, _LONG.max).astype(np.int64)


def first_of_rows(score: np.ndarray, open_: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` highest scores of each row where ``open_``; ties go to the smaller column."""
    n = score.shape[1]
    masked = np.where(open_, score, _LONG.min)
    if n > k:
        open_ = open_ & (masked >= np.partition(masked, n - k, axis=1)[:, n - k, None])
    rows, cols = np.nonzero(open_)
    order = np.lexsort((cols, ~score[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[keep], cols[keep]


def merge_heaps(heaps: DataFrame, keys: list[str], parts: int, k: int) -> DataFrame:
    """One heap of ``k`` entries for each of ``keys`` from partial heaps of ``parts`` shards, ``FAN_IN`` at a time."""
    first = F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, k).alias("heap")
    while parts > FAN_IN:
        heaps = heaps.withColumn("shard", F.floor(F.col("shard") / FAN_IN)).groupBy(*keys, "shard").agg(first)
        parts = ceil(parts / FAN_IN)
    return heaps.groupBy(*keys).agg(first)


def labelled_vectors(vectors: DataFrame, label: str, id_col: str = "vec_id", label_col: str = "label",
                     vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, vector, copies, dim) of the rows that take part; equal rows are one, with their number.

    ``label`` is SQL over the columns vec_id and label. Rows with a null id or
    label, and null or empty vectors or such as hold a null or non-finite
    component, are left out.
    """
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & (F.size("vector") > 0))
            .select("vec_id", F.expr(label).cast("long").alias("label"), "vector")
            .groupBy("vec_id", "label", "vector").agg(F.count(F.lit(1)).alias("copies")).withColumn("dim", F.size("vector")))


def _tiles(candidates: DataFrame, anchors: DataFrame, shards: int, blocks: int, kernel: Callable, columns: str, names: list[str]) -> DataFrame:
    """Partial heaps of every (anchor block, candidate shard): ``kernel`` gives key columns and heaps as (turned score, id) lists."""
    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    # Dealt by the vector too, so that many rows of one id spread.
    left = candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards))).withColumn("block", every(blocks))
    right = anchors.withColumn("anchor_block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks))).withColumn("anchor_shard", every(shards))

    def tile(key: tuple, c: pa.Table, a: pa.Table) -> pa.Table:
        found = list(kernel(c, a)) if c.num_rows and a.num_rows else []
        keys, turned, ids, lengths = ([np.concatenate(x) for x in zip(*[f[0] for f in found])] if found else [np.empty(0, np.int64)] * len(names),
                                      *(np.concatenate([f[n] for f in found]) if found else np.empty(0, np.int64) for n in (1, 2, 3)))
        entries = pa.StructArray.from_arrays([pa.array(turned, pa.int64()), pa.array(ids, pa.int64())], ["turned", "vec_id"])
        heaps = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), entries)
        shard = pa.array(np.full(len(lengths), key[1].as_py()), pa.int64())
        return pa.Table.from_arrays([*(pa.array(x, pa.int64()) for x in keys), heaps, shard], [*names, "heap", "shard"])

    return (left.groupBy("block", "shard", "dim").cogroup(right.groupBy("anchor_block", "anchor_shard", "anchor_dim"))
            .applyInArrow(tile, f"{columns}, heap array<struct<turned: long, vec_id: long>>, shard long"))


def _sorted(c: pa.Table, k: int, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and whole components of a shard by ascending id; of equal rows ``k``, as no heap takes more."""
    ids = c["vec_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    order = np.repeat(order, np.minimum(c["copies"].to_numpy()[order], k))
    return ids[order], c["label"].to_numpy()[order], quantise(matrix(c, "vector"), scale)[order]


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: float = 256.0, label: str = "label", id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(``scale`` * x), a score is the inner product with the
    anchor; higher scores come first, ties by the smaller id. Anchors are the
    ids divisible by ``every``, their positives the first ``positives`` other
    rows of the same label, and a positive's negatives the first ``negatives`` rows
    of another label with low * positive <= 100 * negative <= high * positive.
    A positive without negatives gives no row.

    ``label`` is SQL over vec_id and label. Rows with a null id or label, and
    null or empty vectors or such as hold a null or non-finite component, take
    no part. Vectors of different lengths never meet. A repeated id is an anchor
    once (its shortest, then least vector and label), is no candidate of its own, and is
    found as often as it has rows. Sums beyond a long are clipped to it.
    Without rows there are none; other columns are ignored.
    """
    rows = cut(labelled_vectors(vectors, label, id_col, label_col, vector_col), "labelled")
    asked = (rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("dim", "vector", "label")).alias("a"))
             .select(F.col("vec_id").alias("anchor_id"), F.col("a.label").alias("anchor_label"), F.col("a.vector").alias("anchor"), F.col("a.dim").alias("anchor_dim")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim")).first()
    side = max(1, min(TILE_ROWS, TILE_CELLS // max(1, size["dim"] or 1)))
    shards, blocks = max(1, ceil(size["n"] / side)), max(1, ceil(asked.count() / side))

    def scored(c: pa.Table, a: pa.Table, k: int):
        ids, labels, of = _sorted(c, k, scale)
        anchors, anchor_labels, by = a["anchor_id"].to_numpy(), a["anchor_label"].to_numpy(), quantise(matrix(a, "anchor"), scale)
        for at in range(0, len(anchors), SCORED_AT_ONCE):
            part = slice(at, at + SCORED_AT_ONCE)
            same = anchor_labels[part, None] == labels[None, :]
            yield part, ids, anchors[part], same, scores(by[part], of)

    def heaps_of(rows_: np.ndarray, cols: np.ndarray, score: np.ndarray, ids: np.ndarray) -> tuple:
        some, lengths = np.unique(rows_, return_counts=True)
        return some, ~score[rows_, cols], ids[cols], lengths

    def positive_heaps(c: pa.Table, a: pa.Table):
        for _, ids, anchors, same, score in scored(c, a, positives):
            some, turned, found, lengths = heaps_of(*first_of_rows(score, same & (anchors[:, None] != ids[None, :]), positives), score, ids)
            yield [anchors[some]], turned, found, lengths

    def window_heaps(c: pa.Table, a: pa.Table):
        windows = a["heap"].to_pylist()
        for part, ids, anchors, same, score in scored(c, a, negatives):
            other = ~same & (anchors[:, None] != ids[None, :])
            # As Python's integers, since a hundred times a score may not fit a long.
            own = [[(w["vec_id"], ~w["turned"]) for w in heap] for heap in windows[part]]
            for n in range(positives):
                has = np.array([i for i, w in enumerate(own) if len(w) > n], np.int64)
                if not len(has):
                    break
                pid, ps = (np.array([own[i][n][x] for i in has], np.int64) for x in (0, 1))
                least = np.array([-(-low * int(p) // 100) for p in ps], np.int64)[:, None]
                most = np.array([high * int(p) // 100 for p in ps], np.int64)[:, None]
                mine = score[has]
                some, turned, found, lengths = heaps_of(*first_of_rows(mine, other[has] & (mine >= least) & (mine <= most), negatives), mine, ids)
                yield [anchors[has[some]], np.full(len(some), n), pid[some], ps[some]], turned, found, lengths

    first = merge_heaps(_tiles(rows, asked, shards, blocks, positive_heaps, "anchor_id long", ["anchor_id"]), ["anchor_id"], shards, positives)
    with_windows = asked.join(first, "anchor_id")
    names = ["anchor_id", "place", "positive_id", "positive_score"]
    second = _tiles(rows, with_windows, shards, blocks, window_heaps, ", ".join(f"{n} long" for n in names), names)
    return (merge_heaps(second, names, shards, negatives).select(*names, F.posexplode("heap").alias("at", "of"))
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("of.vec_id").alias("negative_id"),
                    "positive_score", F.bitwise_not("of.turned").alias("negative_score")))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), label="CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")


#: Brute force in SQL; the test tables hold finite vectors of one length and no id twice.
OP12_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
  [floor(256 * CAST(x AS DOUBLE)) for x in embedding] e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.l = c.l AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
