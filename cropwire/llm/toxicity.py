"""Toxicity by a weighted lexicon.

Texts are folded: lower case, homoglyphs, digit substitutions and unusual
accents replaced by the letter they stand for, everything else a space. The
accented letters of Latin-1 stay, as languages tell words apart by them.
An Aho-Corasick automaton finds the lexicon's terms (word beginnings, or whole
words) and its exception phrases; a term inside an exception phrase does not
count. The weights' sum and the sum per word go through a logistic curve.
Terms, weights, exceptions and curve are learned from a bounded sample of
labelled documents.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from cropwire.llm.common import carried, held_out, read_table
from cropwire.llm.partenum import shingle_sets
from cropwire.llm.samples import labelled_texts
from cropwire.llm.words import slices

#: Labelled documents learned from, per class.
PER_CLASS = 6000
#: A learned term occurs in at least so many toxic documents of the sample ...
LEAST_DOCS = 8
#: ... and its share among toxic documents is at least e^this times that among others.
LEAST_WEIGHT = 1.8
#: Lengths of the word beginnings that may become terms.
STEM = (5, 6, 7, 8)
#: A word beginning replaces the words that begin with it if it covers so many times more documents.
STEM_GAIN = 1.25
#: Weight of a term that no label speaks about.
SEED_WEIGHT = 3.0
THRESHOLD = 0.7

# General insults that start the lexicon, phrases in which a term is harmless,
# and the letters that look-alike characters stand for.
SEEDS = ("idiot", "moron", "imbecile", "stupid", "scum", "worthless", "pathetic", "disgusting", "loser", "bastard", "asshole")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof", "pond scum", "not stupid")
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "հ": "h", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "s", "ς": "s", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i",
}


class _Fold(dict):
    """Character table for ``str.translate``, filled as characters occur."""

    def __missing__(self, code: int):
        char = chr(code)
        plain = char.lower() if "à" <= char.lower() <= "ÿ" else unicodedata.normalize("NFKD", char.lower())[:1] or " "
        plain = HOMOGLYPHS.get(char.lower(), HOMOGLYPHS.get(plain, plain))
        if unicodedata.category(char)[0] == "M" or char in "­​‌‍⁠﻿":
            out = None  # combining marks and invisible characters do not part a word
        elif plain.isalpha():
            # 1 stands for i and for l, so the two fold together.
            out = "i" if plain == "l" else plain
        else:
            out = " "
        self[code] = out
        return out


FOLD = _Fold()


def fold(text: str) -> str:
    """The folded text between two spaces."""
    return f" {text.translate(FOLD)} "


def terms_of(folded: str) -> set[str]:
    """Candidate terms of a document: ' stem' for word beginnings, ' word ' for whole words."""
    words = set(folded.split())
    return {f" {w} " for w in words if 3 <= len(w) <= 24} | {f" {w[:n]}" for w in words for n in STEM if len(w) >= n}


class Lexicon:
    """Terms with weights, exception phrases and the logistic curve."""

    def __init__(self, weights: dict[str, float], exceptions: Iterable[str], curve: tuple[float, float, float]):
        self.weights, self.exceptions, self.curve = dict(weights), tuple(exceptions), curve
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick
            a = ahocorasick.Automaton()
            for t, w in self.weights.items():
                a.add_word(t, (len(t), w))
            for phrase in self.exceptions:
                a.add_word(fold(phrase), (len(fold(phrase)), None))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def features(self, text: str | None) -> tuple[float, float, int]:
        """The weights' sum, the sum per 100 words, and the number of hits."""
        folded = fold(text or "")
        hits, excused = [], []
        for end, (n, w) in (self.automaton.iter(folded) if self.weights or self.exceptions else ()):
            (hits if w is not None else excused).append((end - n + 1, end, w))
        if excused:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= z for a, z, _ in excused)]
        # Terms may begin at one word (a stem and the whole word): the heaviest counts.
        by_word: dict[int, float] = {}
        for a, _, w in hits:
            by_word[a] = max(by_word.get(a, 0.0), w)
        total = sum(by_word.values())
        words = max(1, folded.count(" ") - 1) if by_word else 1
        return total, 100.0 * total / words, len(by_word)

    def score(self, text: str | None) -> tuple[float, int]:
        """The score and the number of hits."""
        total, dense, hits = self.features(text)
        a, b, c = self.curve
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, a + b * math.log1p(total) + c * math.log1p(dense))))), hits


def learn(sample: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Terms, weights, exceptions and curve from (doc_id, text, label) rows, label 1 being toxic."""
    seeds = [f" {fold(s).strip()}" for s in SEEDS]
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Lexicon(dict.fromkeys(seeds, SEED_WEIGHT), exceptions, (-4.0, 3.0, 0.0))
    counts = (_count(sample, terms_of).filter(F.col("toxic") >= LEAST_DOCS)
              .withColumn("weight", F.log(((F.col("toxic") + 0.5) / toxic) / ((F.col("clean") + 0.5) / clean))))
    # No more than the sample's own words and their beginnings, so the sample bounds them.
    found = counts.filter(F.col("weight") >= LEAST_WEIGHT).orderBy(F.desc(F.col("toxic") * F.col("weight")), "term").collect()
    docs = {r["term"]: r["toxic"] for r in found}
    # A word beginning is a term if it covers clearly more documents than any longer term that begins with it.
    longest: dict[str, int] = {}
    for t, seen in docs.items():
        for i in range(2, len(t)):
            longest[t[:i]] = max(longest.get(t[:i], 0), seen)
    weights: dict[str, float] = {}
    for r in found:
        t = r["term"]
        if t[-1] == " " or r["toxic"] >= STEM_GAIN * longest.get(t, 0):
            weights[t] = r["weight"]
    for t in seeds:
        if not any(t.startswith(w.rstrip()) or w.startswith(t) for w in weights):
            weights[t] = SEED_WEIGHT
    phrases = [r["term"] for r in _count(sample, lambda t: _phrases(t, weights))
               .filter((F.col("clean") >= LEAST_DOCS) & (F.col("clean") / clean > F.col("toxic") / toxic))
               .orderBy(F.desc("clean"), "term").collect()]
    lexicon = Lexicon(weights, [*exceptions, *phrases], (0.0, 0.0, 0.0))

    def measured(batches):
        for b in batches:
            got = [lexicon.features(t)[:2] for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array([g[i] for g in got], pa.float64()) for i in (0, 1))],
                                             ["label", "total", "dense"])

    rows = sample.select("text", "label").mapInArrow(measured, "label int, total double, dense double").toPandas()
    return Lexicon(weights, lexicon.exceptions, _logistic(rows["total"].to_numpy(), rows["dense"].to_numpy(), rows["label"].to_numpy()))


def _one_of_copies(sample: DataFrame) -> DataFrame:
    """The sample without most copies and near copies, which would speak for their every word.

    Texts with the same least shingle hash count once (that with the least id);
    two texts have it in common as likely as their sets are similar.
    """
    kind = sample.schema["doc_id"].dataType.simpleString()

    def least(batches):
        for rows, raw, offsets in slices(batches, 1):
            grams, edges = shingle_sets(raw, offsets)
            some = np.diff(edges) > 0
            first = np.where(some, grams.view(np.int64)[np.minimum(edges[:-1], max(0, len(grams) - 1))] if len(grams) else 0, 0)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(first, pa.int64())], ["doc_id", "text", "label", "least"])

    return (sample.select("doc_id", "text", "label").mapInArrow(least, f"doc_id {kind}, text string, label int, least long")
            .groupBy("least").agg(F.min_by(F.struct("doc_id", "text", "label"), F.struct("doc_id", "text", "label")).alias("row")).select("row.*"))


def _phrases(folded: str, weights: dict[str, float]) -> set[str]:
    """A lexicon word with the word before it or after it."""
    words = folded.split()
    known = [i for i, w in enumerate(words) if f" {w} " in weights or any(f" {w[:n]}" in weights for n in range(2, len(w) + 1))]
    return {" ".join(words[a:a + 2]) for i in known for a in (i - 1, i) if 0 <= a < len(words) - 1}


def _count(sample: DataFrame, terms) -> DataFrame:
    """(term, toxic, clean): documents of either label that hold the term."""
    def counted(batches):
        for b in batches:
            got: dict[str, Counter] = {}
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in terms(fold(text or "")):
                    got.setdefault(t, Counter())[label] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), *(pa.array([c[k] for c in got.values()], pa.int64()) for k in (1, 0))],
                                             ["term", "toxic", "clean"])

    return (sample.select("text", "label").mapInArrow(counted, "term string, toxic long, clean long")
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def _logistic(total: np.ndarray, dense: np.ndarray, label: np.ndarray) -> tuple[float, float, float]:
    """Balanced, ridge-regularised logistic curve by Newton steps; its slopes are not negative."""
    x = np.column_stack([np.ones(len(label)), np.log1p(total), np.log1p(dense)])
    weight = np.where(label == 1, 0.5 / max(1, (label == 1).sum()), 0.5 / max(1, (label == 0).sum())) * 1000
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.array([0.0, 1.0, 1.0]) * 0.05
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9), x.T @ (weight * (label - p)) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(max(0.0, w[1])), float(max(0.0, w[2]))


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, threshold: float = THRESHOLD, whole_rows: bool = False) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score (0 to 1), predicted, hits.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1); other
    columns are ignored. Learned from labelled rows whose crc32(doc_id) mod 3
    is not 1. A null or empty text has no hits and gets the score of a text
    without hits. Repeated documents get equal rows; without labels of both
    kinds the built-in terms are used alone; an empty table gives no rows.
    With ``whole_rows`` the other columns of ``docs`` come along (see ``common.carried``).
    """
    lexicon = learn(_one_of_copies(labelled_texts(docs, labels, "toxic", 3, 1, per_class)))

    def scored(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = [lexicon.score(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64())],
                    [*names, "score", "hits"])

    rows = carried(docs, whole_rows)
    kept = [i for i, c in enumerate(rows.columns) if whole_rows or c != "text"]
    names = [rows.columns[i] for i in kept]
    schema = StructType([rows.schema[i] for i in kept]).add("score", DoubleType()).add("hits", LongType())
    return (rows.mapInArrow(scored, schema)
            .select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"), "hits", *names[1:]))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
