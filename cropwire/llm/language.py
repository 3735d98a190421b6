"""Language ID by hierarchical discrimination.

A text is the square roots of its letter trigrams' shares, hashed to a fixed
number of dimensions. Linear support vector machines, one per family, pick the
language family; within it one machine per pair of languages votes.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from cropwire.llm.common import carried, held_out, read_table
from cropwire.llm.samples import sample_labels
from cropwire.llm.words import LOWER, slices

#: Labelled documents learned from, over all languages; at least ``LEAST_PER_CLASS`` of each where there are as many.
SAMPLE = 4000
LEAST_PER_CLASS = 40
DIMENSIONS = 4096
#: Texts of one dense block.
BLOCK = 128

# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv", "uralic": "fi et hu", "celtic": "ga cy br gd", "hellenic": "el",
    "indic": "hi mr ne bn pa gu ur", "iranian": "fa ku ps tg", "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am", "sinitic": "zh yue", "malayic": "id ms jv tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
LETTER = re.compile(r"[^\W\d_]")
_WORD = np.zeros(256, bool)
_WORD[97:123] = _WORD[128:] = True


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A unit vector per text from its byte trigrams, in lower case, with what is no letter as one space."""
    n = len(offsets) - 1
    b = LOWER[raw]
    if len(b) > 1:
        capital = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[1:] != 0x97)
        b[1:][capital] += 32
    b = np.where(_WORD[b], b, 32).astype(np.uint32)
    if len(b) < 3:
        return np.zeros((n, DIMENSIONS), np.float32)
    gram = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    owner = np.repeat(np.arange(n), np.diff(offsets))
    # A trigram lies in one text, and has a letter in its middle.
    keep = (owner[:-2] == owner[2:]) & (b[1:-1] != 32)
    slot = (gram[keep] * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    count = np.bincount(owner[:-2][keep] * DIMENSIONS + slot, minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    x = np.sqrt(count.astype(np.float32))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def blocks(batches, column: int):
    """(rows, features) in dense blocks of at most ``BLOCK`` texts."""
    for rows, raw, offsets in slices(batches, column):
        for at in range(0, rows.num_rows, BLOCK):
            to = min(rows.num_rows, at + BLOCK)
            yield rows.slice(at, to - at), features(raw[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])


class Sample:
    """Rows of features, kept as what is not 0; dense blocks of them are made one at a time, so the driver holds no copies."""

    def __init__(self, slots: list[np.ndarray], values: list[np.ndarray], dimensions: int = DIMENSIONS):
        self.slots, self.values, self.dimensions = slots, values, dimensions

    @classmethod
    def of(cls, x: np.ndarray) -> "Sample":
        slots = [np.flatnonzero(v) for v in x]
        return cls(slots, [v[s] for v, s in zip(x, slots)], x.shape[1])

    def __len__(self) -> int:
        return len(self.slots)

    def take(self, at: np.ndarray) -> "Sample":
        return Sample([self.slots[i] for i in at], [self.values[i] for i in at], self.dimensions)

    def dense(self, bias: bool = True, dtype: type = np.float32) -> np.ndarray:
        """All rows, with ``bias`` a last column of ones."""
        x = np.zeros((len(self), self.dimensions + bias), dtype)
        for row, slots, values in zip(x, self.slots, self.values):
            row[slots] = values
        if bias:
            x[:, -1] = 1
        return x


def svm(x: np.ndarray, positive: np.ndarray, c: float = 10.0, steps: int = 150) -> np.ndarray:
    """A linear support vector machine (squared hinge, balanced) by accelerated gradient; the last column of ``x`` is 1, its weight the bias."""
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    weight = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(np.float32) * len(x) * c
    rate = 1.0 / (1.0 + 4.0 * weight.sum())
    w = previous = np.zeros(x.shape[1], np.float32)
    # The Lipschitz constant by power iteration; the sum above only bounds it.
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = x.T @ (2 * weight * (x @ v))
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    rate = max(rate, 0.9 / (1.0 + norm))
    for t in range(1, steps + 1):
        ahead = w + (t - 1) / (t + 2) * (w - previous)
        slack = np.maximum(0, 1 - y * (x @ ahead))
        previous, w = w, ahead - rate * (ahead - x.T @ (2 * weight * slack * y))
    return w


class Discriminator:
    """Family machines, then pair machines; ``predict`` gives labels and scores."""

    def __init__(self, x: np.ndarray | Sample, labels: list[str]):
        rows = x if isinstance(x, Sample) else Sample.of(x)
        self.languages = sorted(set(labels))
        of = np.array([FAMILY_OF.get(v.lower(), f"other:{v}") for v in labels])
        label = np.array(labels)
        self.families = sorted(set(of))
        self.members = {f: sorted(set(label[of == f])) for f in self.families}
        self.family = None
        if len(self.families) > 1:
            dense = rows.dense()
            self.family = np.array([svm(dense, of == f) for f in self.families])
            del dense
        self.pairs = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                at = np.flatnonzero((label == a) | (label == b))
                self.pairs[a, b] = svm(rows.take(at).dense(), label[at] == a)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.column_stack([x, np.ones(len(x), np.float32)])
        label, score = np.empty(len(x), object), np.ones(len(x))
        family = np.zeros(len(x), int)
        if self.family is not None:
            margin = 2 * x @ self.family.T
            share = np.exp(margin - margin.max(axis=1, keepdims=True))
            family = margin.argmax(axis=1)
            score = share.max(axis=1) / share.sum(axis=1)
        for k, f in enumerate(self.families):
            at = np.flatnonzero(family == k)
            names = self.members[f]
            # The probability of a language: how surely it wins each of its pairs, then shared out.
            won, votes = np.zeros((len(at), len(names))), np.zeros((len(at), len(names)))
            for i, j in combinations(range(len(names)), 2):
                p = 1 / (1 + np.exp(-2 * (x[at] @ self.pairs[names[i], names[j]])))
                won[:, i] += np.log(np.maximum(p, 1e-9))
                won[:, j] += np.log(np.maximum(1 - p, 1e-9))
                votes[:, i] += p >= 0.5
                votes[:, j] += p < 0.5
            if len(names) > 1:
                best = (votes + 1e-3 * np.exp(won)).argmax(axis=1)
                score[at] *= np.exp(won[np.arange(len(at)), best] / (len(names) - 1))
            else:
                best = np.zeros(len(at), int)
            label[at] = np.array(names, object)[best]
        return label, np.clip(score, 0, 1)


def learn(docs: DataFrame, modulus: int = 4, remainder: int = 2, sample: int = SAMPLE) -> Discriminator | None:
    """Fit on a bounded sample of the training rows with a language; none if there are none."""
    rows = docs.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id", modulus, remainder)).select(F.col("lang").alias("label"), "doc_id", "text")
    ids = rows.select("label", "doc_id").distinct()
    known = ids.select("label").distinct().count()
    if not known:
        return None
    # Every language is learned: the sample has SAMPLE rows in all, or LEAST_PER_CLASS for each language if that is more.
    picked = sample_labels(ids, max(LEAST_PER_CLASS, sample // known))

    def measured(batches):
        for part, x in blocks(batches, 1):
            x = x.astype(np.float16)
            slots = [np.flatnonzero(v).astype(np.uint16) for v in x]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([v.tobytes() for v in c], pa.binary())
                                                                for c in (slots, [v[s] for v, s in zip(x, slots)]))], ["label", "slots", "x"])

    # Text and language are of one row, also where an id repeats; one text for an id and language, so the sample bounds the rows too.
    texts = (rows.filter(F.col("text").isNotNull()).join(F.broadcast(picked), ["label", "doc_id"])
             .groupBy("label", "doc_id").agg(F.min("text").alias("text")).select("label", "text"))
    got = texts.mapInArrow(measured, "label string, slots binary, x binary").toArrow()
    if not len(got):
        return None
    label = np.array(got["label"].to_pylist(), object)
    rows = Sample(*([np.frombuffer(v, t) for v in got[c].to_pylist()] for c, t in (("slots", np.uint16), ("x", np.float16))))
    # By label, then by the bytes of the whole row: one order, however the rows came.
    order = [at[i] for k in sorted(set(label)) for at in [np.flatnonzero(label == k)] for i in _order(rows.take(at))]
    return Discriminator(rows.take(order), list(label[order]))


def _order(rows: Sample) -> list[int]:
    """Places of the rows by the bytes of their dense form."""
    keys = [v.tobytes() for v in rows.dense(bias=False, dtype=np.float16)]
    return sorted(range(len(keys)), key=keys.__getitem__)


def identify_language(docs: DataFrame, modulus: int = 4, remainder: int = 2, sample: int = SAMPLE, whole_rows: bool = False) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score (0 to 1), languages (how many were learned).

    ``docs`` has doc_id, text and lang; only rows whose crc32(doc_id) modulo
    ``modulus`` is not ``remainder`` and whose lang is not null are learned
    from. A null or empty text, or one without a letter, is ``und`` with score
    0, as are all if there is nothing to learn from. Repeated rows get equal
    results; an empty table gives no rows; other columns are ignored, or come
    along with ``whole_rows`` (see ``common.carried``).
    """
    learned = learn(docs, modulus, remainder, sample)
    model = docs.sparkSession.sparkContext.broadcast(learned)

    def predicted(batches):
        for part, x in blocks(batches, 1):
            texts = part.column(1).to_pylist()
            some = np.array([bool(t) and LETTER.search(t) is not None for t in texts], bool)
            label, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if model.value is not None and some.any():
                label[some], score[some] = model.value.predict(x[some])
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in kept), pa.array(label, pa.string()), pa.array(score, pa.float64())],
                                             [*names, "lang_pred", "score"])

    rows = carried(docs, whole_rows)
    kept = [i for i, c in enumerate(rows.columns) if whole_rows or c != "text"]
    names = [rows.columns[i] for i in kept]
    schema = StructType([rows.schema[i] for i in kept]).add("lang_pred", StringType()).add("score", DoubleType())
    return (rows.mapInArrow(predicted, schema)
            .select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "lang_pred", "score",
                    F.lit(len(learned.languages) if learned else 0).alias("languages"), *names[1:]))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    return identify_language(read_table(spark, sf_dir, "documents"))
