"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropwire.session import scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a re-run of all that
    came before. The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame, others: bool) -> DataFrame:
    """doc_id and text; with ``others`` the other columns behind them, under names that clash with none."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")] if others else []
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"carried_{i}_") for i, c in enumerate(more)])


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` from those of ``carried``."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]
    return rows.select(*[F.col(c) if c not in more else F.col(f"carried_{more.index(c)}_").alias(c) for c in docs.columns])


def held_out(col: Column | str, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``, equals ``remainder``; a null id is never held out."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bits_for(rows: int, per_bucket: int) -> int:
    """Bits of a bucket number so that a bucket holds about ``per_bucket`` rows."""
    return max(0, math.ceil(math.log2(max(1, rows / per_bucket))))


def place_of(*cols: str) -> Column:
    """A shuffled place that depends on the columns alone: a number of 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def top_bits(place: Column, bits: int) -> Column:
    """The ``bits`` highest bits of a place: the number of its range."""
    return F.shiftright(place, 63 - bits)


def offsets(totals: DataFrame, keys: list[str], bucket: str, value: str, bits: int) -> DataFrame:
    """Sum of ``value`` over the earlier buckets of the same keys, as column ``before``.

    ``totals`` has one row per (keys, bucket). Two levels, so that no window
    holds more than about the square root of the number of buckets.
    """
    low = bits // 2
    t = totals.withColumn("hi_", F.shiftright(F.col(bucket), low))
    inner = Window.partitionBy(*keys, "hi_").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("hi_").rowsBetween(Window.unboundedPreceding, -1)
    coarse = (t.groupBy(*keys, "hi_").agg(F.sum(value).alias("sum_"))
              .select(*keys, "hi_", F.coalesce(F.sum("sum_").over(outer), F.lit(0)).alias("outer_")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "hi_"]]
    fine = t.withColumn("inner_", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    on = same[0]
    for c in same[1:]:
        on = on & c
    return (fine.alias("a").join(coarse.alias("b"), on)
            .select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{bucket}").alias(bucket),
                    (F.col("inner_") + F.col("outer_")).alias("before")))
