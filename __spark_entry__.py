"""

``entry(spark)`` runs the flagship market cycle on sf0.001. ``queries()``
maps each operator key to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
gives the same result as DuckDB SQL over the raw test tables (no JSON), so
every key is checked end to end: documents built from the tables, parsed back
by the operators, compared with rows computed directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cropwire.schemas import CLIMATE_URL_TEMPLATE

SF0001 = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the market cycle (status gate, parse, first-N, casts, events) on sf0.001."""
    from cropwire.plans.queries import market_cycle_q
    return market_cycle_q(spark, SF0001)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from cropwire.plans.queries import KEYS
    return dict(KEYS) | _optional()[0]


def _optional() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators; none if that subpackage or the pipeline is not there."""
    try:
        import corpus_pipeline
        from cropwire.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as gone:
        if (gone.name or "").split(".")[:2] not in (["corpus_pipeline"], ["cropwire", "llm"]):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, ORACLES | sql


# Shared WITH-prefixes. P_M: weekly prices per brand; P_C: daily values per
# user; P_S: lineitem as keyed batches with the first writer marked.
P_M = """WITH b AS (SELECT p_brand symbol, CAST(date_trunc('week', l_shipdate) AS DATE) wk, l_extendedprice px,
  CAST(l_quantity AS BIGINT) qty, l_discount dis, l_shipdate s, l_orderkey a, l_linenumber n, l_partkey p, l_suppkey u
  FROM lineitem JOIN part ON l_partkey = p_partkey),
mk AS (SELECT symbol, wk, CAST(substr(symbol, 7) AS INT) sn, first(px ORDER BY s,a,n,p,u,px) AS open, max(px) AS high,
  min(px) AS low, last(px ORDER BY s,a,n,p,u,px) AS close, CAST(sum(qty) AS BIGINT) AS volume, max(dis) AS dividend_amount,
  row_number() OVER (PARTITION BY symbol ORDER BY wk DESC) rn, row_number() OVER (PARTITION BY symbol ORDER BY wk) ra
  FROM b GROUP BY symbol, wk),
sy AS (SELECT DISTINCT symbol, sn FROM mk)
"""

P_C = """WITH l AS (SELECT user_id, strftime(ts, '%Y%m%d') d, event_type t, arg_max(value, ts) v,
  arg_max(CAST(regexp_extract(props, '[0-9]+') AS INT), ts) k FROM events GROUP BY 1, 2, 3),
c AS (SELECT user_id, 'P' || user_id AS producer_id, d AS date, t, v, k,
  (k % 10 = 1 AND t = 'purchase') bad, (k % 10 = 2 AND t = 'click') nul,
  CASE WHEN k % 10 <> 0 THEN v WHEN user_id % 11 = 7 THEN -999.0 END x FROM l
  WHERE t IN ('view','click','purchase','signup') AND user_id % 11 NOT IN (3, 5, 8)),
g AS (SELECT user_id, producer_id, date, bool_or(t = 'view') drv, count(*) FILTER (WHERE NOT nul) = 4 AS complete,
  bool_or(bad) bad, max(x) FILTER (WHERE t = 'view') precipitation, max(x) FILTER (WHERE t = 'click') root_zone_soil_wetness,
  max(x) FILTER (WHERE t = 'purchase') temperature_max, max(x) FILTER (WHERE t = 'signup') temperature_min
  FROM c GROUP BY 1, 2, 3),
u AS (SELECT DISTINCT user_id, 'P' || user_id AS producer_id FROM events),
dim AS (SELECT 'P' || c_custkey AS producer_id, c_name AS producer_name, c_mktsegment AS commodity_type FROM customer WHERE c_custkey % 7 <> 0)
"""

P_S = """WITH r AS (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_suppkey % 3 AS INT) AS cycle, l_partkey p, l_suppkey s, l_shipdate d,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey % 3, l_partkey, l_suppkey, l_extendedprice, l_shipdate) rn FROM lineitem)
"""

_OBS = ("SELECT producer_id, producer_name, commodity_type, date, precipitation, root_zone_soil_wetness, "
        "temperature_max, temperature_min FROM g JOIN dim USING (producer_id) WHERE complete AND NOT bad")
_EVENTS = ("SELECT '2024-03-01T00:00:00Z' AS ts, 'market-feeder' AS ss, symbol, CAST(wk AS VARCHAR) || 'T00:00:00Z' "
           "AS price_timestamp, close FROM mk WHERE rn <= 10")
_STORE = "SELECT l_orderkey, l_linenumber, l_extendedprice FROM r WHERE rn = 1"
_DIM_TABLE = ("SELECT CAST(c_custkey AS BIGINT) AS ordinal, 'P' || c_custkey AS producer_id, c_name AS producer_name, "
              "c_mktsegment AS commodity_type, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude "
              "FROM customer WHERE c_custkey % 7 <> 0")

_TOPIC = ("SELECT 'CommodityPrice' AS topic, '2024-03-01T00:00:00Z' AS ts, 'market-feeder' AS ss, symbol, "
          "CAST(wk AS VARCHAR) || 'T00:00:00Z' AS price_timestamp, close FROM mk WHERE rn <= 10")
_CLIMATE_URL = CLIMATE_URL_TEMPLATE.replace("%s", "' || {} || '").format("lon", "lat", "'20240201'", "'20240301'")

_ORACLES = {
    "producer_dimension": _DIM_TABLE,
    "producer_ids": f"SELECT ordinal, producer_id FROM ({_DIM_TABLE})",
    "producer_lookup": P_C + "SELECT u.producer_id, producer_name, commodity_type FROM u LEFT JOIN dim USING (producer_id)",
    "producer_exists": P_C + "SELECT producer_id FROM u WHERE producer_id IN (SELECT producer_id FROM dim)",
    "unknown_producers": P_C + "SELECT producer_id FROM u WHERE producer_id NOT IN (SELECT producer_id FROM dim)",
    "symbol_list": ("SELECT p_partkey, CAST(u.i - 1 AS INT) AS pos, [p_brand, '', p_type, p_brand][u.i] AS symbol "
                    "FROM part, (SELECT unnest([1, 2, 3, 4]) AS i) u"),
    "climate_date_window": ("SELECT 'P' || user_id AS producer_id, strftime(CAST(max(ts) AS DATE) - 29, '%Y%m%d') AS start_date, "
                            "strftime(CAST(max(ts) AS DATE), '%Y%m%d') AS end_date FROM events GROUP BY user_id"),
    "market_request_manifest": P_M + ("SELECT symbol, 'https://www.alphavantage.co/query?function=TIME_SERIES_WEEKLY_ADJUSTED&symbol=' "
                                      "|| symbol || '&apikey={api_key}' AS url FROM sy"),
    "climate_request_manifest": (
        "WITH d AS (SELECT 'P' || c_custkey AS producer_id, CAST(c_custkey % 360 - 180 + 0.5 AS DOUBLE) AS lon, "
        "CAST(c_custkey % 180 - 90 + 0.5 AS DOUBLE) AS lat FROM customer WHERE c_custkey % 7 <> 0) "
        "SELECT producer_id, '20240201' AS start_date, '20240301' AS end_date, '" + _CLIMATE_URL + "' AS url FROM d"),
    "climate_raw_scan": P_C + ("SELECT producer_id, CAST(user_id AS BIGINT) AS doc_seq, 200 AS http_status, "
                               "CASE WHEN user_id % 11 IN (5, 8) THEN -1 ELSE coalesce(n, 0) END AS days, "
                               "CASE WHEN user_id % 11 NOT IN (5, 8) THEN coalesce(t, 0.0) END AS total FROM u LEFT JOIN "
                               "(SELECT user_id, count(*) n, sum(CASE WHEN k % 10 = 0 THEN -999.0 ELSE v END) t FROM l "
                               "WHERE t = 'view' GROUP BY 1) USING (user_id)"),
    "market_raw_scan": P_M + ("SELECT symbol, CAST(any_value(sn) AS BIGINT) AS doc_seq, 200 AS http_status, count(*) AS weeks, "
                              "sum(close) AS close_total FROM mk JOIN sy USING (symbol, sn) GROUP BY symbol"),
    "response_status_gate": P_M + "SELECT symbol, sn % 7 <> 0 AS accepted FROM sy",
    "climate_parse": P_C + ("SELECT producer_id, user_id % 22 <> 16 AS is_object, user_id % 11 NOT IN (5, 8) AS has_parameter, "
                            "CASE WHEN user_id % 22 <> 16 THEN CAST(user_id % 4 = 1 AS BIGINT) END AS messages, "
                            "CASE WHEN user_id % 11 IN (5, 8) THEN -1 ELSE coalesce(n, 0) END AS days FROM u LEFT JOIN "
                            "(SELECT user_id, count(*) n FROM l WHERE t = 'purchase' GROUP BY 1) USING (user_id)"),
    "climate_structure_gate": P_C + ("SELECT producer_id, CASE WHEN user_id % 22 = 16 THEN 'unparsable' WHEN user_id % 11 = 5 THEN 'missing_properties' ELSE 'missing_parameter' END "
                                     "AS reason FROM u WHERE user_id % 11 IN (5, 8)"),
    "climate_required_series": P_C + "SELECT u.producer_id FROM u WHERE user_id % 11 NOT IN (3, 5, 8)",
    "climate_messages": P_C + "SELECT producer_id, 'late data ' || user_id AS message FROM u WHERE user_id % 4 = 1",
    "climate_fill_value": P_C + "SELECT producer_id, CASE WHEN user_id % 11 <> 7 AND user_id % 22 <> 16 THEN CAST(-999.0 AS DOUBLE) END AS fill_value FROM u",
    "climate_align": P_C + ("SELECT producer_id, date, max(y) FILTER (WHERE t = 'view') AS precipitation, "
                            "max(y) FILTER (WHERE t = 'click') AS root_zone_soil_wetness, max(y) FILTER (WHERE t = 'purchase') AS temperature_max, "
                            "max(y) FILTER (WHERE t = 'signup') AS temperature_min FROM (SELECT *, CASE WHEN NOT bad AND NOT nul THEN x END y FROM c) "
                            "GROUP BY 1, 2 HAVING bool_or(t = 'view')"),
    "climate_complete_days": P_C + "SELECT producer_id, date FROM g WHERE complete",
    "climate_incomplete_days": P_C + "SELECT producer_id, date FROM g WHERE drv AND NOT complete",
    "climate_bad_days": P_C + "SELECT producer_id, date FROM g WHERE complete AND bad",
    "climate_fill_to_nan": P_C + ("SELECT producer_id, date, precipitation, precipitation IS NULL AS is_fill "
                                  "FROM g WHERE complete AND NOT bad"),
    "climate_ordered_days": P_C + ("SELECT producer_id, date, CAST(row_number() OVER (PARTITION BY producer_id ORDER BY date DESC) - 1 AS INT) "
                                   "AS pos FROM g WHERE complete AND NOT bad"),
    "climate_observations": P_C + _OBS,
    "climate_stored_values": P_C + _OBS,
    "climate_cycle": P_C + _OBS,
    "climate_table_schema": P_C + ("SELECT CAST(row_number() OVER (ORDER BY user_id, date DESC) AS BIGINT) AS id, producer_id, producer_name, "
                                   "commodity_type, date, precipitation, root_zone_soil_wetness, temperature_max, temperature_min, "
                                   "'2024-03-01T00:00:00Z' AS captured_at FROM g JOIN dim USING (producer_id) WHERE complete AND NOT bad"),
    "climate_insert_or_ignore": P_C + ("SELECT producer_id, date, precipitation FROM g JOIN dim USING (producer_id) "
                                       "WHERE complete AND NOT bad"),
    "climate_quarantine": P_C + ("SELECT producer_id AS key, CAST(NULL AS VARCHAR) AS detail_key, CASE WHEN producer_id NOT IN "
                                 "(SELECT producer_id FROM dim) THEN 'unknown_producer' WHEN user_id % 22 = 16 THEN 'unparsable' WHEN user_id % 11 = 5 THEN 'missing_properties' "
                                 "WHEN user_id % 11 = 8 THEN 'missing_parameter' ELSE 'missing_series' END AS reason FROM u "
                                 "WHERE producer_id NOT IN (SELECT producer_id FROM dim) OR user_id % 11 IN (3, 5, 8) "
                                 "UNION ALL SELECT producer_id, date, 'bad_number' FROM g WHERE complete AND bad "
                                 "AND producer_id IN (SELECT producer_id FROM dim)"),
    "market_parse": P_M + ("SELECT symbol, count(*) AS weeks, sum(close) AS close_total, CAST(sum(volume) AS BIGINT) AS volume_total "
                           "FROM mk GROUP BY 1"),
    "market_error_gate": P_M + ("SELECT symbol, CASE sn % 5 WHEN 0 THEN 'provider_error' ELSE 'provider_note' END AS reason, "
                                "CASE sn % 5 WHEN 0 THEN 'bad symbol' ELSE 'rate limit' END AS detail FROM sy WHERE sn % 5 IN (0, 1)"),
    "market_series_gate": P_M + "SELECT symbol, 'missing_series' AS reason FROM sy WHERE sn % 5 = 2",
    "market_ordered_weeks": P_M + "SELECT symbol, CAST(rn - 1 AS INT) AS pos, CAST(wk AS VARCHAR) AS week FROM mk",
    "market_first_n_weeks": P_M + "SELECT symbol, CAST(wk AS VARCHAR) AS week FROM mk WHERE ra <= 10",
    "market_cast": P_M + "SELECT symbol, CAST(wk AS VARCHAR) AS week, open, high, low, close, volume FROM mk",
    "market_price_instant": P_M + "SELECT symbol, CAST(epoch(wk) AS BIGINT) AS price_epoch FROM mk",
    "market_document_abort": P_M + ("SELECT 10 AS n, symbol, count(*) AS weeks FROM mk WHERE sn % 5 = 4 AND sn <> 24 AND rn <= 10 GROUP BY symbol "
                                    "UNION ALL SELECT 2, symbol, count(*) FROM mk WHERE sn % 5 IN (3, 4) AND sn <> 24 AND rn <= 2 GROUP BY symbol"),
    "market_observations": P_M + ("SELECT symbol, CAST(epoch(wk) AS BIGINT) AS price_epoch, open, high, low, close, close AS adjusted_close, "
                                  "volume, dividend_amount FROM mk WHERE rn <= 10"),
    "market_table_schema": P_M + ("SELECT CAST(row_number() OVER (ORDER BY sn, wk DESC) AS BIGINT) AS id, symbol, CAST(wk AS VARCHAR) || 'T00:00:00Z' "
                                  "AS price_timestamp, open, high, low, close, close AS adjusted_close, volume, dividend_amount, "
                                  "'2024-03-01T00:00:00Z' AS captured_at FROM mk WHERE rn <= 10"),
    "market_rows_insert_or_ignore": P_M + ("SELECT symbol, CAST(wk AS VARCHAR) || 'T00:00:00Z' AS price_timestamp, close "
                                           "FROM mk WHERE rn <= 10"),
    "no_data_report": P_M + "SELECT symbol FROM sy WHERE sn % 7 = 0 OR sn % 5 <> 4 OR sn = 24",
    "market_events": P_M + _EVENTS,
    "event_json": P_M + _EVENTS,
    "topic_publish": P_M + _TOPIC,
    "topic_replay": P_M + _TOPIC,
    "topic_order": P_M + ("SELECT symbol, CAST(rn - 1 AS INT) AS place, CAST(wk AS VARCHAR) || 'T00:00:00Z' AS price_timestamp "
                          "FROM mk WHERE rn <= 10 AND sn % 7 <> 0 AND sn % 5 = 4 AND sn <> 24"),
    "market_cycle": P_M + ("SELECT symbol, CAST(wk AS VARCHAR) || 'T00:00:00Z' AS price_timestamp, open, high, low, close, volume "
                           "FROM mk WHERE rn <= 10 AND sn % 7 <> 0 AND sn % 5 = 4 AND sn <> 24"),
    "cycle_report": P_M + ("SELECT sy.symbol, count(mk.wk) AS published FROM sy LEFT JOIN mk ON sy.symbol = mk.symbol AND rn <= 10 "
                           "AND sy.sn % 7 <> 0 AND sy.sn % 5 = 4 AND sy.sn <> 24 GROUP BY 1"),
    "quarantine": P_M + ("SELECT symbol AS key, CASE WHEN sn % 7 = 0 THEN 'http_503' WHEN sn = 24 THEN 'unparsable' WHEN sn % 5 = 0 THEN 'provider_error' "
                         "WHEN sn % 5 = 1 THEN 'provider_note' WHEN sn % 5 = 2 THEN 'missing_series' ELSE 'bad_entry' END AS reason "
                         "FROM sy WHERE sn % 7 = 0 OR sn % 5 <> 4 OR sn = 24"),
    "market_insert_or_ignore": P_S + _STORE,
    "capture_stamp": P_S + ("SELECT '2024-01-0' || (cycle + 1) || 'T00:00:00Z' AS captured_at, count(*) AS n FROM r WHERE rn = 1 GROUP BY 1"),
    "surrogate_id": P_S + ("SELECT CAST(row_number() OVER (ORDER BY cycle, p, s, l_orderkey, l_linenumber) AS BIGINT) AS id, "
                           "l_orderkey, l_linenumber FROM r WHERE rn = 1"),
    "not_null_gate": ("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels USING (doc_id) "
                      "WHERE quality IS NOT NULL AND d.doc_id IS NOT NULL"),
    "batch_replay_idempotent": P_S + _STORE,
    "partitioned_insert_or_ignore": P_S + ("SELECT l_orderkey % 1500 AS part, l_orderkey, l_linenumber, l_extendedprice FROM r WHERE rn = 1"),
    "missing_documents": P_C + ("SELECT producer_id AS key, 'no_document' AS reason FROM dim WHERE producer_id NOT IN (SELECT producer_id FROM u)"),
    "climate_report": P_C + ("SELECT a.producer_id, count(g.date) AS rows FROM (SELECT producer_id FROM dim UNION SELECT producer_id FROM u) a "
                             "LEFT JOIN g ON g.producer_id = a.producer_id AND complete AND NOT bad AND a.producer_id IN (SELECT producer_id FROM dim) GROUP BY 1"),
    "stream_missing": P_C + ("SELECT CAST(r.run + 1 AS INT) AS cycle, a.producer_id AS key, 'no_document' AS reason FROM (SELECT unnest([0, 1]) AS run) r, "
                             "(SELECT producer_id FROM dim UNION SELECT producer_id FROM u) a "
                             "WHERE a.producer_id NOT IN (SELECT producer_id FROM u WHERE user_id % 2 = r.run)"),
    "cycle_log": P_C + ("""SELECT CAST(r.run AS BIGINT) AS epoch, (SELECT count(*) FROM u WHERE user_id % 2 = r.run) AS documents,
        (SELECT count(*) FROM g JOIN dim USING (producer_id) WHERE user_id % 2 = r.run AND complete AND NOT bad) AS rows,
        (SELECT count(*) FROM g JOIN dim USING (producer_id) WHERE user_id % 2 = r.run AND complete AND NOT bad) AS inserted,
        (SELECT count(*) FROM u WHERE user_id % 2 = r.run AND (user_id % 11 IN (3, 5, 8) OR producer_id NOT IN (SELECT producer_id FROM dim)))
        + (SELECT count(*) FROM g JOIN dim USING (producer_id) WHERE user_id % 2 = r.run AND complete AND bad) AS quarantined
        FROM (SELECT unnest([0, 1]) AS run) r"""),
    "two_cycle_table": P_S + "SELECT cycle, count(*) AS n FROM r WHERE rn = 1 GROUP BY 1",
}


for _same, _of in (("climate_table_created", "climate_table_schema"), ("market_table_created", "market_table_schema"),
                   ("quarantine_replay", "quarantine"), ("cycle_report_replay", "cycle_report")):
    _ORACLES[_same] = _ORACLES[_of]


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES) | _optional()[1]
