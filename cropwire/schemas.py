"""Schemas, DDL strings and the built-in producer dimension."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values that must equal the reference for identical results. ----
# Producer dimension rows in definition order:
# (producer_id, producer_name, commodity_type, latitude, longitude)
PRODUCERS = [
    ("WHEAT_1", "Beauce - France", "WHEAT", 48.10, 1.75),
    ("WHEAT_2", "Henan - China", "WHEAT", 34.75, 113.62),
    ("WHEAT_3", "Punjab - India", "WHEAT", 31.15, 75.34),
    ("WHEAT_4", "Krasnodar Krai - Russia", "WHEAT", 45.04, 38.98),
    ("WHEAT_5", "Kansas - USA", "WHEAT", 38.50, -98.00),
    ("CORN_1", "Iowa - USA", "CORN", 42.03, -93.58),
    ("CORN_2", "Jilin - China", "CORN", 43.90, 125.32),
    ("CORN_3", "Mato Grosso - Brazil", "CORN", -12.64, -55.42),
    ("CORN_4", "Cordoba - Argentina", "CORN", -31.42, -64.19),
    ("CORN_5", "Baragan Plain - Romania", "CORN", 44.50, 27.50),
    ("SOY_1", "Mato Grosso - Brazil", "SOY_BEANS", -12.64, -55.42),
    ("SOY_2", "Illinois - USA", "SOY_BEANS", 40.00, -89.20),
    ("SOY_3", "Cordoba - Argentina", "SOY_BEANS", -31.42, -64.19),
    ("SOY_4", "Heilongjiang - China", "SOY_BEANS", 47.86, 127.76),
    ("SOY_5", "Alto Parana - Paraguay", "SOY_BEANS", -25.45, -54.90),
    ("COFFEE_1", "Minas Gerais - Brazil", "COFFEE", -18.51, -44.56),
    ("COFFEE_2", "Dak Lak - Vietnam", "COFFEE", 12.71, 108.24),
    ("COFFEE_3", "Antioquia - Colombia", "COFFEE", 6.55, -75.57),
    ("COFFEE_4", "Lampung - Indonesia", "COFFEE", -4.56, 105.41),
    ("COFFEE_5", "Oromia - Ethiopia", "COFFEE", 7.55, 40.63),
    ("NATGAS_1", "Texas - USA", "NATURAL_GAS", 31.00, -99.00),
    ("NATGAS_2", "Pennsylvania - USA", "NATURAL_GAS", 41.20, -77.19),
    ("NATGAS_3", "Louisiana - USA", "NATURAL_GAS", 31.00, -92.00),
    ("NATGAS_4", "West Virginia - USA", "NATURAL_GAS", 38.60, -80.45),
    ("NATGAS_5", "Oklahoma - USA", "NATURAL_GAS", 35.59, -97.49),
]
# Request URL templates; placeholders are filled in order.
CLIMATE_URL_TEMPLATE = (
    "https://power.larc.nasa.gov/api/temporal/daily/point"
    "?parameters=PRECTOTCORR,GWETROOT,T2M_MAX,T2M_MIN"
    "&community=AG&longitude=%s&latitude=%s&start=%s&end=%s&format=JSON"
)
MARKET_URL_TEMPLATE = (
    "https://www.alphavantage.co/query?function=TIME_SERIES_WEEKLY_ADJUSTED"
    "&symbol=%s&apikey=%s"
)
# Document keys.
CLIMATE_SERIES = ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")
MARKET_SERIES_KEY = "Weekly Adjusted Time Series"
MARKET_ERROR_KEY = "Error Message"
MARKET_NOTE_KEY = "Note"
MARKET_FIELDS = (
    "1. open", "2. high", "3. low", "4. close",
    "5. adjusted close", "6. volume", "7. dividend amount",
)
# Defaults of the reference programs.
CLIMATE_DAYS = 30
MARKET_MAX_WEEKS = 520
EVENT_SOURCE = "market-feeder"
TOPIC = "CommodityPrice"
# --------------------------------------------------------------------------

API_KEY_PLACEHOLDER = "{api_key}"

DIMENSION_SCHEMA = T.StructType([
    T.StructField("ordinal", T.LongType(), False),
    T.StructField("producer_id", T.StringType(), False),
    T.StructField("producer_name", T.StringType(), True),
    T.StructField("commodity_type", T.StringType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
])

# Leaves are read as STRING and cast with try_cast afterwards: a JSON number
# read straight into DOUBLE is fine, but a quoted number would become NULL.
_SERIES = "MAP<STRING, STRING>"
CLIMATE_JSON_SCHEMA = (
    "header STRUCT<fill_value: STRING>, messages ARRAY<STRING>, "
    "properties STRUCT<parameter: STRUCT<"
    + ", ".join(f"{s}: {_SERIES}" for s in CLIMATE_SERIES)
    + ">>"
)
MARKET_ENTRY_SCHEMA = "STRUCT<" + ", ".join(f"`{f}`: STRING" for f in MARKET_FIELDS) + ">"
MARKET_JSON_SCHEMA = (
    f"`{MARKET_ERROR_KEY}` STRING, `{MARKET_NOTE_KEY}` STRING, "
    f"`{MARKET_SERIES_KEY}` MAP<STRING, {MARKET_ENTRY_SCHEMA}>"
)
# Fallback when one entry of the series is not an object (the typed parse
# above then drops the whole map): entries as raw text, parsed one by one.
MARKET_SERIES_TEXT_SCHEMA = f"`{MARKET_SERIES_KEY}` MAP<STRING, STRING>"

CLIMATE_OBSERVATION_COLUMNS = [
    "producer_id", "producer_name", "commodity_type", "date",
    "precipitation", "root_zone_soil_wetness", "temperature_max", "temperature_min",
]

CLIMATE_TABLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("producer_id", T.StringType(), False),
    T.StructField("producer_name", T.StringType(), False),
    T.StructField("commodity_type", T.StringType(), False),
    T.StructField("date", T.StringType(), False),
    T.StructField("precipitation", T.DoubleType(), True),
    T.StructField("root_zone_soil_wetness", T.DoubleType(), True),
    T.StructField("temperature_max", T.DoubleType(), True),
    T.StructField("temperature_min", T.DoubleType(), True),
    T.StructField("captured_at", T.StringType(), False),
])
CLIMATE_KEYS = ["producer_id", "date"]
CLIMATE_NOT_NULL = ["producer_id", "producer_name", "commodity_type", "date"]

MARKET_TABLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("price_timestamp", T.StringType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adjusted_close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("dividend_amount", T.DoubleType(), True),
    T.StructField("captured_at", T.StringType(), False),
])
MARKET_KEYS = ["symbol", "price_timestamp"]
MARKET_NOT_NULL = ["symbol", "price_timestamp"]
