"""Exact top-k search by inner product: tiled matrix products, a partial selection per tile, tree merging."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cropwire.llm import tiles

#: Whole numbers up to this size are exact as doubles.
EXACT = float(1 << 53)


def quantise(x: np.ndarray, scale: float = 256.0) -> np.ndarray:
    return np.floor(scale * x)


def exact_top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: float = 256.0,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` highest integer inner products of each query: (query_id, rank, vec_id, score).

    Components become floor(``scale`` * x). Queries are the rows whose id is
    divisible by ``every``, candidates all rows but those with the query's id.
    Rows with a null id, and null or empty vectors or such as hold a null or
    non-finite component, take no part; vectors of different lengths never
    meet. A repeated id asks once (its least vector) and is found as often as
    it has rows. Ties go to the smaller id; other columns are ignored.
    """
    rows = tiles.valid_vectors(vectors, id_col, vector_col)

    def kernel(c: pa.Table, q: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = c["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, cv = ids[order], quantise(tiles.matrix(c, "vector")[order], scale)
        asked, qv = q["query_id"].to_numpy(), quantise(tiles.matrix(q, "query"), scale)
        if np.abs(cv).max() * np.abs(qv).max() * cv.shape[1] >= EXACT:
            return _big(ids, cv, asked, qv, k)
        found = []
        for at in range(0, len(asked), tiles.SCORED_AT_ONCE):
            some = asked[at:at + tiles.SCORED_AT_ONCE]
            scores = qv[at:at + tiles.SCORED_AT_ONCE] @ cv.T
            scores[some[:, None] == ids[None, :]] = -np.inf
            r, col = tiles.best_of_rows(scores, k)
            found.append((some[r], ids[col], scores[r, col].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*found))

    return tiles.search(rows, tiles.queries_of(rows, every), k, True, kernel, "long")


def _big(ids, cv, asked, qv, k):
    """The same with Python's integers, for products that doubles do not hold; sums beyond a long are clipped."""
    whole = [[int(x) for x in v] for v in cv]
    out = []
    for a, v in zip(asked, qv):
        v = [int(x) for x in v]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i) for i, w in zip(ids.tolist(), whole) if i != a)[:k]
        out += [(a, i, max(-2**63, min(2**63 - 1, -s))) for s, i in scored]
    return tuple(np.array([o[n] for o in out], np.int64) for n in range(3))


def op2_exact_top_k(spark, sf_dir: str) -> DataFrame:
    from cropwire.llm.common import read_table
    return exact_top_k(read_table(spark, sf_dir, "embeddings"))


#: Brute force in SQL; the test tables hold finite vectors of one length.
OP2_SQL = """WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
QUALIFY rank <= 5"""
