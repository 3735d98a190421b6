"""Quality classifier on random-indexing word vectors.

Every token (a run of lower-case letters, of capitals, of digits or of other
characters) falls in a bucket of a fixed number. A bucket's index vector is
sparse and random; its context vector is the sum of the index vectors of the
tokens around it, over all documents. A document pools the context vectors of
its tokens (mean and spread) with its length, how varied it is and how often
neighbours repeat. A small two-layer network turns that into a probability,
calibrated by a temperature on documents that it was not fitted to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm.common import held_out, read_table
from cropwire.llm.samples import labelled_texts, training_labels
from cropwire.llm.tables import sum_tables
from cropwire.llm.words import slices, span_hashes

#: Buckets of tokens, dimensions of a vector, and nonzero entries of an index vector.
BUCKETS, DIMENSIONS, NONZERO = 1 << 14, 32, 4
#: Tokens on either side that count as context.
WINDOW = 2
#: Labelled documents learned from, per class; every ``FOLD``-th calibrates.
PER_CLASS, FOLD = 4000, 5
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.02, 1e-4
THRESHOLD = 0.3
SEED = 11

#: 0 space, 1 lower-case letters and bytes of other scripts, 2 capitals, 3 digits, 4 anything else.
CLASS = np.full(256, 4, np.uint8)
CLASS[[32, *range(9, 14)]], CLASS[97:123], CLASS[128:], CLASS[65:91], CLASS[48:58] = 0, 1, 1, 2, 3


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every token."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = CLASS[raw]
    edge = np.empty(len(raw), bool)
    edge[0], edge[1:] = True, kind[1:] != kind[:-1]
    edge[offsets[:-1][offsets[:-1] < len(raw)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(raw))
    word = kind[starts] > 0
    starts, ends = starts[word], ends[word]
    # What tells apart texts is a mark, not how often it is repeated: "!!!" and "!" are one token.
    mark = kind[starts] == 4
    ends = np.where(mark, starts + 1, ends)
    bucket = (span_hashes(raw, starts, ends) >> np.uint64(50)).astype(np.int64)
    return bucket, np.searchsorted(offsets, starts, side="right") - 1


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Position and sign of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    at = np.argsort(rng.random((BUCKETS, DIMENSIONS)), axis=1)[:, :NONZERO]
    return at, rng.choice([-1, 1], (BUCKETS, NONZERO))


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors of all buckets, from all documents."""
    def fill(batches):
        at, sign = index_vectors()
        table = None
        for _, raw, offsets in slices(batches, 0):
            table = np.zeros(BUCKETS * DIMENSIONS) if table is None else table
            bucket, owner = tokens(raw, offsets)
            for d in range(1, WINDOW + 1):
                same = owner[d:] == owner[:-d]
                left, right = bucket[:-d][same], bucket[d:][same]
                for of, near in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        table += np.bincount(of * DIMENSIONS + at[near, k], sign[near, k], minlength=len(table))
        return table

    total = sum_tables(docs.select("text"), fill, BUCKETS * DIMENSIONS).reshape(BUCKETS, DIMENSIONS).astype(float)
    # Frequent neighbours would drown the others, so the common direction is taken out.
    unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    seen = np.abs(total).sum(axis=1) > 0
    unit[seen] -= unit[seen].mean(axis=0) if seen.any() else 0
    return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(raw: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A row per text: mean and spread of its vectors, log length, variety, repeated neighbours, shares of token classes."""
    m = len(offsets) - 1
    bucket, owner = tokens(raw, offsets)
    n = np.bincount(owner, minlength=m)
    out = np.zeros((m, 2 * DIMENSIONS + 8), np.float32)
    if len(bucket):
        code, many = np.unique(owner * BUCKETS + bucket, return_counts=True)
        of, v = code // BUCKETS, vectors[code % BUCKETS]
        some, first = np.unique(of, return_index=True)
        weight = (many / n[of]).astype(np.float32)[:, None]
        mean = np.add.reduceat(v * weight, first, axis=0)
        out[some, :DIMENSIONS] = mean
        out[some, DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(0, np.add.reduceat(v * v * weight, first, axis=0) - mean ** 2))
        out[some, -7] = np.bincount(of, minlength=m)[some] / np.sqrt(n[some])
        out[some, -6] = np.maximum.reduceat(many, first) / n[some]
        for d in (1, 2):
            same = (owner[d:] == owner[:-d]) & (bucket[d:] == bucket[:-d])
            out[:, -6 + d] = np.bincount(owner[d:][same], minlength=m) / np.maximum(n, 1)
    size = np.maximum(np.diff(offsets), 1)
    total = np.stack([np.concatenate([[0], np.cumsum(CLASS[raw] == k)])[offsets] for k in (2, 3, 4)])
    out[:, -3:] = (np.diff(total, axis=1) / size).T
    out[:, -8] = np.log1p(n)
    return out


class Network:
    """Two layers over standardised features, with a temperature and the classes' true shares."""

    def __init__(self, x: np.ndarray, y: np.ndarray, share: float):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        fold = np.arange(len(y)) % FOLD == 0
        if fold.all() or not fold.any():
            fold = np.zeros(len(y), bool)
        layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), np.zeros(1)]
        moment, square = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers]
        a, b = x[~fold], y[~fold]
        weight = np.where(b == 1, 0.5 / max(1, (b == 1).sum()), 0.5 / max(1, (b == 0).sum()))
        for step in range(1, EPOCHS + 1):
            hidden = np.tanh(a @ layers[0] + layers[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -30, 30)))
            out = weight * (p - b)
            back = np.outer(out, layers[2]) * (1 - hidden ** 2)
            for i, g in enumerate((a.T @ back + DECAY * layers[0], back.sum(axis=0), hidden.T @ out + DECAY * layers[2], np.array([out.sum()]))):
                moment[i] = 0.9 * moment[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                layers[i] = layers[i] - RATE * (moment[i] / (1 - 0.9 ** step)) / (np.sqrt(square[i] / (1 - 0.999 ** step)) + 1e-9)
        self.layers, self.temperature, self.shift = layers, 1.0, 0.0
        if fold.any():
            z, y = self._logit(x[fold]), y[fold]
            w = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
            loss = {t: (w * np.logaddexp(0, np.where(y == 1, -z, z) / t)).sum() for t in np.geomspace(0.25, 8, 61)}
            self.temperature = min(loss, key=loss.get)
        # The sample is balanced; the documents are not.
        self.shift = float(np.log(share / (1 - share)))

    def _logit(self, x):
        return np.tanh(x @ self.layers[0] + self.layers[1]) @ self.layers[2] + self.layers[3]

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = self._logit(np.clip((x - self.mean) / self.scale, -6, 6)) / self.temperature + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def learn(docs: DataFrame, labels: DataFrame, vectors, per_class: int = PER_CLASS) -> Network | float:
    """The network; without labels of both kinds, the share of label 1 (0.5 without any)."""
    n = {r["label"]: r["count"] for r in training_labels(labels, "quality", 5, 0).groupBy("label").count().collect()}
    good, bad = n.get(1, 0), n.get(0, 0)
    if not good or not bad:
        return 1.0 if good else 0.0 if bad else 0.5

    def measured(batches):
        for rows, raw, offsets in slices(batches, 1):
            x = features(raw, offsets, vectors.value)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), pa.array([v.tobytes() for v in x], pa.binary())], ["doc_id", "label", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = labelled_texts(docs, labels, "quality", 5, 0, per_class)
    got = (sample.select("doc_id", "text", "label").mapInArrow(measured, f"doc_id {kind}, label int, x binary")
           .orderBy(F.xxhash64("doc_id"), "doc_id", "x").toPandas())
    if got["label"].nunique() < 2:
        return good / (good + bad)
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(len(got), -1).astype(float)
    return Network(x, got["label"].to_numpy(), good / (good + bad))


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD) -> DataFrame:
    """Quality of every whole text: doc_id, held_out, score (0 to 1), predicted.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (0 or 1); other
    columns are ignored. Labels are learned from rows whose crc32(doc_id) mod 5
    is not 0, word vectors from all texts. A null text counts as empty and gets the
    score of a text without tokens. Without labels of both kinds all scores are the
    known label's share; repeated rows get equal results; an empty table gives no rows.
    """
    spark = docs.sparkSession
    vectors = spark.sparkContext.broadcast(context_vectors(docs))
    model = spark.sparkContext.broadcast(learn(docs, labels, vectors, per_class))

    def scored(batches):
        for rows, raw, offsets in slices(batches, 1):
            if isinstance(model.value, float):
                p = np.full(rows.num_rows, model.value)
            else:
                p = model.value.predict(features(raw, offsets, vectors.value).astype(float))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double")
            .select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
