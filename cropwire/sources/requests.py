"""Request planning: symbol lists, date windows and request manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cropwire.functions.dates import date_window
from cropwire.functions.text import java_split
from cropwire.schemas import (
    API_KEY_PLACEHOLDER, CLIMATE_DAYS, CLIMATE_URL_TEMPLATE, MARKET_URL_TEMPLATE,
)


def symbol_list(spark: SparkSession, symbols: str | DataFrame, column: str = "symbols") -> DataFrame:
    """Comma list(s) of symbols to ``(pos, symbol)`` rows, in list order.

    No trimming and no de-duplication: a repeated symbol is processed twice.
    A DataFrame input holds one list per row in ``column``; its other columns
    are carried along.
    """
    if isinstance(symbols, str):
        symbols = spark.createDataFrame([(symbols,)], f"{column} string")
    rest = [c for c in symbols.columns if c != column]
    return symbols.select(*rest, F.posexplode(java_split(F.col(column))).alias("pos", "symbol"))


def climate_request_manifest(dim: DataFrame, as_of: Column | str | None = None,
                             days: int = CLIMATE_DAYS) -> DataFrame:
    """One request URL per producer for the trailing window ending at ``as_of``.

    ``as_of`` defaults to ``current_date()``; pass a date (or a column) to make
    the run repeatable. Coordinates print like Java's ``%s`` of a double.
    """
    if as_of is None:
        as_of_col = F.current_date()
    elif isinstance(as_of, str):
        as_of_col = F.to_date(F.lit(as_of))
    else:
        as_of_col = as_of
    w = date_window(as_of_col, days)
    return dim.select(
        "ordinal", "producer_id",
        w["start_date"].alias("start_date"), w["end_date"].alias("end_date"),
        F.format_string(CLIMATE_URL_TEMPLATE, F.col("longitude"), F.col("latitude"),
                        w["start_date"], w["end_date"]).alias("url"),
    )


def market_request_manifest(symbols: DataFrame, symbol: str = "symbol") -> DataFrame:
    """One request URL per symbol; the API key stays a placeholder in the data."""
    return symbols.withColumn(
        "url", F.format_string(MARKET_URL_TEMPLATE, F.col(symbol), F.lit(API_KEY_PLACEHOLDER))
    )
