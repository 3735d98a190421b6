"""Producer dimension: scan, ids, lookup, existence, unknown keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropwire.schemas import DIMENSION_SCHEMA, PRODUCERS


def producer_dimension(spark: SparkSession, table: DataFrame | None = None,
                       ordinal: str = "ordinal") -> DataFrame:
    """The producer dimension with an explicit ``ordinal`` (definition order).

    Without ``table`` this is the built-in 25-row dimension. A table supplied
    by the caller is normalised to the same schema; missing descriptive columns
    become NULL.
    """
    if table is None:
        rows = [(i, *p) for i, p in enumerate(PRODUCERS)]
        # Spark cannot know the size of rows from the driver; these are 25.
        return F.broadcast(spark.createDataFrame(rows, DIMENSION_SCHEMA))
    cols = set(table.columns)

    def opt(name: str, dtype: str):
        return (F.col(name) if name in cols else F.lit(None)).cast(dtype).alias(name)

    return table.select(
        F.col(ordinal).cast("bigint").alias("ordinal"),
        F.col("producer_id").cast("string").alias("producer_id"),
        opt("producer_name", "string"), opt("commodity_type", "string"),
        opt("latitude", "double"), opt("longitude", "double"),
    )


def producer_ids(dim: DataFrame) -> DataFrame:
    """All ids in definition order."""
    return dim.select("ordinal", "producer_id").orderBy("ordinal")


def lookup_producers(docs: DataFrame, dim: DataFrame, key: str = "producer_id") -> DataFrame:
    """Left lookup: dimension columns, NULL when the key is unknown.

    Spark broadcasts the dimension where its size in bytes allows (the built-in
    one always) and shuffles, splitting hot keys, where it does not.
    """
    return docs.join(dim.withColumnRenamed("producer_id", key), key, "left")


def producers_exist(docs: DataFrame, dim: DataFrame, key: str = "producer_id") -> DataFrame:
    """Rows whose key is in the dimension (semi join)."""
    return docs.join(dim.select(F.col("producer_id").alias(key)), key, "left_semi")


def unknown_producers(docs: DataFrame, dim: DataFrame, key: str = "producer_id") -> DataFrame:
    """Rows whose key is not in the dimension (anti join); they yield no data."""
    return docs.join(dim.select(F.col("producer_id").alias(key)), key, "left_anti")
