"""Documents derived from the test tables inside Spark.

The test tables hold no weather or prices, so price documents are built from
``lineitem`` x ``part`` (one per brand) and weather documents from ``events``
(one per user), with deterministic faults. The operators then parse these
documents back; an oracle computes the same rows from the tables directly.
Every group below is pre-aggregated (per week / per day) before it is
collected, so a document's size is bounded by the calendar, not by row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_KEPT = 64  # readers kept; the oldest goes first
_TABLES: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (read-only input); the reader is kept so its schema is inferred once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        if len(_TABLES) >= _KEPT:
            del _TABLES[next(iter(_TABLES))]
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def fx_market_docs(spark: SparkSession, sf_dir: str, ascending: bool = False) -> DataFrame:
    """One weekly-price document per brand, newest week first (or oldest first)."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    b = li.join(part, li.l_partkey == part.p_partkey).selectExpr(
        "p_brand AS symbol", "CAST(date_trunc('week', l_shipdate) AS DATE) AS wk", "l_extendedprice AS px",
        "CAST(l_quantity AS BIGINT) AS qty", "l_discount AS dis",
        "struct(l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS o")
    a = b.groupBy("symbol", "wk").agg(
        F.min_by("px", "o").alias("op"), F.max("px").alias("hi"), F.min("px").alias("lo"),
        F.max_by("px", "o").alias("cl"), F.sum("qty").alias("v"), F.max("dis").alias("d"))
    order = "true" if ascending else "false"
    return a.groupBy("symbol").agg(
        F.expr("collect_list(struct(CAST(wk AS STRING) AS k, op, hi, lo, cl, v, d))").alias("e")
    ).selectExpr(
        "symbol", "CAST(substr(symbol, 7) AS INT) AS sn", "CAST(substr(symbol, 7) AS BIGINT) AS doc_seq",
        "200 AS http_status",
        f"""to_json(named_struct('Weekly Adjusted Time Series', map_from_entries(transform(
            sort_array(e, {order}),
            x -> struct(x.k, map('1. open', CAST(x.op AS STRING), '2. high', CAST(x.hi AS STRING),
              '3. low', CAST(x.lo AS STRING), '4. close', CAST(x.cl AS STRING),
              '5. adjusted close', CAST(x.cl AS STRING), '6. volume', CAST(x.v AS STRING),
              '7. dividend amount', CAST(x.d AS STRING))))))) AS raw""")


def fx_market_docs_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand documents with faults by brand number: error, note, no series, bad third entry, 503, text behind the object."""
    return fx_market_docs(spark, sf_dir).selectExpr(
        "symbol", "sn", "doc_seq", "CASE WHEN sn % 7 = 0 THEN 503 ELSE 200 END AS http_status",
        """CASE WHEN sn = 24 THEN raw || ' xx' ELSE CASE sn % 5 WHEN 0 THEN '{"Error Message":"bad symbol"}' WHEN 1 THEN IF(sn % 2 = 0, '{Note:"rate limit"}', '{"Note":"rate limit"}')
             WHEN 2 THEN '{"Information":"x"}'
             WHEN 3 THEN to_json(named_struct('Weekly Adjusted Time Series', map_from_entries(transform(
               map_entries(from_json(raw, '`Weekly Adjusted Time Series` MAP<STRING,MAP<STRING,STRING>>').`Weekly Adjusted Time Series`),
               (e, i) -> struct(e.key, IF(i = 2, map('1. open', 'x'), e.value))))))
             ELSE IF(sn = 34, '/* weekly */ ' || raw || ' // end', raw) END END AS raw""")


def fx_climate_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily-weather document per user with deterministic faults."""
    ev = table(spark, sf_dir, "events")
    day = ev.groupBy(
        "user_id", F.date_format("ts", "yyyyMMdd").alias("d"), F.col("event_type").alias("t")
    ).agg(F.max_by("value", "ts").alias("v"),
          F.max_by(F.expr("CAST(get_json_object(props, '$.k') AS INT)"), "ts").alias("k"))
    x = day.selectExpr(
        "user_id", "t",
        """struct(d, CASE WHEN k % 10 = 0 THEN '-999.0' WHEN k % 10 = 1 AND t = 'purchase' THEN IF(user_id % 2 = 0, 'inf', 'oops')
             WHEN k % 10 = 2 AND t = 'click' THEN NULL ELSE CAST(v AS STRING) END) AS e""")

    def series(t: str):
        return F.map_from_entries(F.collect_list(F.when(F.col("t") == t, F.col("e"))))

    m = x.groupBy("user_id").agg(series("view").alias("a"), series("click").alias("b"),
                                 series("purchase").alias("c"), series("signup").alias("f"))
    docs = m.selectExpr(
        "concat('P', user_id) AS producer_id", "user_id", "CAST(user_id AS BIGINT) AS doc_seq",
        "200 AS http_status",
        """to_json(named_struct(
             'header', IF(user_id % 11 = 7, NULL, named_struct('fill_value', -999.0D)),
             'messages', IF(user_id % 4 = 1, array(concat('late data ', user_id)), array()),
             'properties', CASE WHEN user_id % 11 = 5 THEN NULL
               WHEN user_id % 11 = 8 THEN named_struct('parameter', NULL)
               ELSE named_struct('parameter', named_struct('PRECTOTCORR', a, 'GWETROOT', b, 'T2M_MAX', c,
                 'T2M_MIN', IF(user_id % 11 = 3, NULL, f))) END)) AS raw""")
    # Two kinds of text behind the object, and documents with bare names and comments.
    return docs.withColumn("raw", F.expr(r"""CASE
        WHEN user_id % 44 = 16 THEN concat(raw, ',{"__end":"1"}] {}')
        WHEN user_id % 22 = 16 THEN concat(raw, ' {}')
        WHEN user_id % 11 = 1 THEN concat('/* daily */ ', regexp_replace(raw, r'"(header|messages|properties|parameter|fill_value)":', '$1:'), ' // end')
        ELSE raw END"""))


def fx_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A producer dimension table from ``customer`` (every 7th key left out: unknown producers)."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS ordinal", "concat('P', c_custkey) AS producer_id", "c_name AS producer_name",
        "c_mktsegment AS commodity_type").filter("c_custkey % 7 <> 0")


def fx_store_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` rows as keyed batches: ``cycle = l_suppkey % 3``, key (l_orderkey, l_linenumber)."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_extendedprice", "CAST(l_suppkey % 3 AS INT) AS cycle",
        "l_partkey", "l_suppkey", "l_shipdate")


STORE_KEYS = ["l_orderkey", "l_linenumber"]
STORE_ARRIVAL = ["cycle", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
STORE_COLUMNS = ["l_orderkey", "l_linenumber", "l_extendedprice", "cycle"]
