"""Bounded, repeatable samples of labelled rows for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm.common import held_out

#: Steps of the sampling fraction.
STEPS = 1 << 24


def training_labels(labels: DataFrame, label: str, modulus: int, remainder: int) -> DataFrame:
    """(doc_id, label) of the rows that may be learned from; null ids and labels are left out."""
    return (labels.select("doc_id", F.col(label).alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id", modulus, remainder)))


def sample_labels(rows: DataFrame, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each label, by a hash of the id.

    ``rows`` has doc_id and label. The result has about
    ``per_class`` rows of every label at most (all of a label that has fewer).
    """
    counts = rows.groupBy("label").count().collect()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(STEPS))
    keep = F.lit(False)
    whole = [r["label"] for r in counts if r["count"] <= per_class]
    if whole:
        keep = F.col("label").isin(whole)
    for r in counts:
        if r["count"] > per_class:
            keep = keep | ((F.col("label") == F.lit(r["label"])) & (share < int(STEPS * per_class / r["count"])))
    return rows.filter(keep)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the training rows; of repeated labels the largest holds."""
    picked = (sample_labels(training_labels(labels, label, modulus, remainder).dropDuplicates(), per_class)
              .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    # About twice per_class ids, so the broadcast is bounded. Many rows may repeat one of them: each gives one text.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
