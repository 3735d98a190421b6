"""The corpus pipeline: toxicity, language ID, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that the one
before it kept, and returns a DataFrame; ``run`` writes it as Parquet and reads it
again for the next. All but the last return the columns of ``documents``. Every
row is decided on by itself, also where doc_id is null or repeated. Empty input
gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropwire.llm.common import cut, read_table, restored
from cropwire.llm.language import identify_language
from cropwire.llm.mixing import content_hash, mix_sources
from cropwire.llm.packing import pack_documents
from cropwire.llm.partenum import jaccard_components
from cropwire.llm.toxicity import score_toxicity

#: A language found with less certainty than this is no language that was learned, where up to four were;
#: it falls as more are, since they share the certainty.
LEAST_LANGUAGE_SCORE = 0.2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"), whole_rows=True)
    return restored(scored.filter("predicted = 0"), docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; ``und`` and very unsure ones go."""
    found = identify_language(docs, whole_rows=True)
    return restored(found.filter((F.col("lang_pred") != "und") & (F.col("score") * F.greatest("languages", F.lit(4)) >= 4 * LEAST_LANGUAGE_SCORE)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the one with the least doc_id (null last). Texts without words are linked only to rows with their id and text.

    Rows are compared under numbers of their own, so that neither a repeated nor a missing id links or parts texts.
    """
    rows = cut(docs.withColumn("row_", F.monotonically_increasing_id()), "rows")
    groups = jaccard_components(rows.select(F.col("row_").alias("doc_id"), "text")).select(F.col("doc_id").alias("of_"), "n_shingles", "component_id")
    blank = F.col("n_shingles") == 0
    # A null id is no id that two rows share.
    group = [F.when(~blank, F.col("component_id")), F.when(blank, F.col("doc_id")),
             F.when(blank & F.col("doc_id").isNull(), F.col("of_")), F.when(blank, F.col("hash_"))]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "hash_", "of_")
    ids = rows.select("row_", "doc_id", F.xxhash64("text", F.col("text").isNull()).alias("hash_"))
    first = (ids.join(groups, F.col("row_") == F.col("of_"))
             .groupBy(*[g.alias(f"group_{i}_") for i, g in enumerate(group)]).agg(F.min(order)["of_"].alias("of_")))
    return rows.join(first, F.col("row_") == F.col("of_"), "left_semi").select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix reads it."""
    mixed = mix_sources(docs)
    # Rows of one id, source and text, of which the stage before leaves one, are read equally often.
    decisions = mixed.groupBy("doc_id", "source", "content").agg(F.max("copies").alias("copies")).filter("copies > 0")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", content_hash("text").alias("content")).alias("d")
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("doc_id", "source", "content")]
    again = rows.join(decisions.alias("m"), same[0] & same[1] & same[2])
    return again.select("d.row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return pack_documents(docs, added_tokens=True)


STAGES = [("toxicity", toxicity), ("language", language), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

#: Learned models, similarity components and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it wrote."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
