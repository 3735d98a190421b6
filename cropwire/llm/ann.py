"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector, less a centroid, normalised and rotated at random, keeps one sign
bit per dimension, its length and the cosine between itself and its code. From
these a query estimates its inner product with every vector, with an error
bound that holds with high probability; only vectors whose lower bound of the
distance does not exceed the k-th best exact distance so far are compared
exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm import tiles

#: Vectors of the sample that gives the centroid (those with the least hashed ids).
CENTROID_SAMPLE = 1024
#: Width of the error bound, in standard errors of the estimate.
EPSILON = 1.9
SEED = 20240229


def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per vector length, the mean of the sample's vectors."""
    sample = vectors.select("dim", "vector").orderBy(F.xxhash64("vec_id"), "vector").limit(CENTROID_SAMPLE)
    got: dict[int, list] = {}
    for r in sample.collect():
        got.setdefault(r["dim"], []).append(r["vector"])
    return {d: np.mean(np.array(v, np.float64), axis=0) for d, v in got.items()}


def encode(x: np.ndarray, centre: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distance from the centroid, and cosine of vector and code."""
    dim = x.shape[1]
    rest = x - (0.0 if centre is None else centre)
    length = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest / np.where(length > 0, length, 1.0)[:, None]) @ rotation(dim)
    return np.packbits(turned > 0, axis=1), length, np.abs(turned).sum(axis=1) / np.sqrt(dim)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, dict]:
    """The index, one row per valid vector (vec_id, dim, vector, code, length, cosine), and the centroids."""
    rows = tiles.valid_vectors(vectors, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0))
    centres = centroids(rows)

    def coded(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            codes = [None] * t.num_rows
            length, cosine = np.zeros(t.num_rows), np.zeros(t.num_rows)
            dims = t["dim"].to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                bits, length[at], cosine[at] = encode(tiles.matrix(t.take(at), "vector"), centres.get(int(d)))
                for i, c in zip(at, bits):
                    codes[i] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.binary()), pa.array(length), pa.array(cosine)],
                                             [*b.schema.names, "code", "length", "cosine"])

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(coded, f"vec_id long, vector {kind}, dim int, code binary, length double, cosine double"), centres


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, epsilon: float = EPSILON,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found for each query by Euclidean distance: (query_id, rank, vec_id, score).

    Queries are the rows whose id is divisible by ``every``, candidates all
    rows but those with the query's id. ``score`` is the exact distance of the
    original vectors in double precision. Rows with a null id, and null, empty,
    zero or partly null or non-finite vectors take no part; vectors of
    different lengths never meet. A repeated id asks once (its least vector)
    and is found as often as it has rows. Ties go to the smaller id.
    """
    index, centres = build_index(vectors, id_col, vector_col)

    def kernel(c: pa.Table, q: pa.Table):
        ids, cv = c["vec_id"].to_numpy(), tiles.matrix(c, "vector")
        dim = cv.shape[1]
        bits = np.frombuffer(b"".join(c["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
        length, cosine = c["length"].to_numpy(), c["cosine"].to_numpy()
        safe = np.where(cosine > 0, cosine, 1.0)
        # The standard error of the estimated cosine: what the code leaves of the vector, spread over the other dimensions.
        error = epsilon * np.sqrt(np.maximum(0, 1 - safe * safe)) / safe / np.sqrt(max(1, dim - 1))
        asked, qv = q["query_id"].to_numpy(), tiles.matrix(q, "query")
        rest = qv - centres.get(dim, 0.0)
        qlen = np.sqrt((rest * rest).sum(axis=1))
        turned = ((rest / np.where(qlen > 0, qlen, 1.0)[:, None]) @ rotation(dim)).astype(np.float32)
        found = []
        for at in range(0, len(asked), tiles.SCORED_AT_ONCE):
            part = slice(at, at + tiles.SCORED_AT_ONCE)
            cos = (turned[part] @ signs.T) / (np.sqrt(dim) * safe)
            for i, row in enumerate(cos, at):
                both = 2 * qlen[i] * length
                near = length ** 2 + qlen[i] ** 2 - both * row
                near[ids == asked[i]] = np.inf
                found.append(_rerank(asked[i], qv[i], ids, cv, near, near - both * error, k))
        return tuple(np.concatenate(x) for x in zip(*found))

    queries = tiles.queries_of(index.select("vec_id", "vector", "dim"), every)
    return tiles.search(index, queries, k, False, kernel, "double")


def _rerank(asked, q, ids, cv, near, lower, k):
    """Exact distances of the ``k`` nearest by estimate, then of all whose lower bound may beat them."""
    def exact(at):
        d = cv[at] - q
        return np.sqrt((d * d).sum(axis=1))

    n = int(np.isfinite(near).sum())
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    first = np.argpartition(near, min(k, n) - 1)[:min(k, n)]
    worst = exact(first).max()
    at = np.flatnonzero((lower <= worst * worst * (1 + 1e-9)) & np.isfinite(near))
    at = np.union1d(at, first)
    far = exact(at)
    best = np.lexsort((ids[at], far))[:k]
    return np.full(len(best), asked), ids[at][best], far[best]


def op9_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    from cropwire.llm.common import read_table
    return nearest(read_table(spark, sf_dir, "embeddings"))


#: Exact search; stands for the query where its bounds hold, and measures recall elsewhere.
OP9_EXACT_SQL = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank, vec_id, score FROM s
QUALIFY rank <= 10"""
