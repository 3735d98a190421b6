"""Query blocks against candidate shards: one bounded tile per task, then a tree of top-list merges.

Candidates are dealt to shards and queries to blocks, about ``TILE_ROWS`` rows
each, by a hash of the id; every (block, shard) pair is one tile, so a tile's
memory does not grow with the data. Candidates are sent once per block and
queries once per shard, as in a blocked matrix product.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard, and queries of a block.
TILE_ROWS = 8192
#: Partial top lists that one merge takes together.
FAN_IN = 16
#: Queries whose scores against a shard are held at once.
SCORED_AT_ONCE = 256


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, dim) of the rows with an id and a non-empty vector of finite components."""
    finite = F.forall(F.col(vector_col), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
            .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & (F.size("vector") > 0))
            .withColumn("dim", F.size("vector")))


def queries_of(vectors: DataFrame, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``; of rows that repeat an id, the least vector."""
    return (vectors.filter(F.col("vec_id") % every == 0)
            .groupBy("vec_id", "dim").agg(F.min("vector").alias("vector")))


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional double array."""
    flat = table[name].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(table.num_rows, -1)


def search(candidates: DataFrame, queries: DataFrame, k: int, descending: bool,
           kernel: Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]], score_type: str) -> DataFrame:
    """Each query's ``k`` best candidates: (query_id, rank, vec_id, score), ties to the smaller vec_id.

    ``kernel`` gets the candidates and the queries of one tile and returns
    query ids, candidate ids and scores, at least the tile's ``k`` best of each
    query. Only vectors of equal length meet. Without queries or candidates
    there are no rows.
    """
    n, n_queries = candidates.count(), queries.count()
    shards, blocks = max(1, ceil(n / TILE_ROWS)), max(1, ceil(n_queries / TILE_ROWS))
    left = (candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)))
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    # Renamed, as both sides may come from one table.
    right = (queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.col("dim").alias("query_dim"))
             .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))
    kind = pa.float64() if score_type == "double" else pa.int64()

    def tile(key: tuple, c: pa.Table, q: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score", "shard"]
        if c.num_rows and q.num_rows:
            qid, cid, score = kernel(c, q)
        else:
            qid = cid = score = np.empty(0, np.int64)
        return pa.Table.from_arrays([pa.array(qid, pa.int64()), pa.array(cid, pa.int64()), pa.array(score, kind),
                                     pa.array(np.full(len(qid), key[1].as_py()), pa.int64())], names)

    keys = ["block", "shard", "dim"]
    lists = (left.groupBy(*keys).cogroup(right.groupBy("block", "shard", "query_dim"))
             .applyInArrow(tile, f"query_id long, vec_id long, score {score_type}, shard long"))
    return merge(lists, shards, k, descending)


def merge(lists: DataFrame, parts: int, k: int, descending: bool) -> DataFrame:
    """Merge partial top lists of ``parts`` shards, ``FAN_IN`` at a time."""
    best = [F.col("score").desc() if descending else F.col("score").asc(), F.col("vec_id").asc()]
    while parts > FAN_IN:
        lists = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        parts = ceil(parts / FAN_IN)
        lists = (lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "shard").orderBy(*best)))
                 .filter(F.col("rank") <= k).drop("rank"))
    return (lists.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*best)))
            .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def best_of_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` highest finite scores of each row; ties go to the smaller column."""
    n = scores.shape[1]
    bound = np.partition(scores, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -np.inf)
    rows, cols = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    first = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep]
