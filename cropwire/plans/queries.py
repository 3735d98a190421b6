"""Registered queries: one per operator key, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the test tables or documents Spark derives from them
(:mod:`cropwire.fixtures`). Queries that exercise a sink write to a fresh
folder under ``spark.checkpoint.dir`` and read the result back. Fixed
parameters: first ``N = 10`` weeks, ``as_of = 2024-03-01``, event ``ts`` and
``captured_at`` of ``2024-03-01T00:00:00Z``. NaN is projected as NULL and
instants as ISO text or epoch seconds so that results do not depend on the
session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cropwire import fixtures as fx
from cropwire.functions.dates import date_window, epoch_seconds, iso_instant
from cropwire.functions.json import LENIENT, last_wins_entries
from cropwire.functions.numbers import nan_to_null
from cropwire.operators import climate as cl
from cropwire.operators import market as mk
from cropwire.operators.events import (
    event_json, market_events, publish_topic, read_topic, topic_messages,
)
from cropwire.operators.keyed_sink import create_table_if_absent, insert_or_ignore, not_null_gate, read_table
from cropwire.plans.cycles import (
    climate_cycle, market_cycle, market_store_rows, run_climate_cycle, run_market_cycle,
)
from cropwire.schemas import (
    CLIMATE_KEYS, CLIMATE_NOT_NULL, CLIMATE_OBSERVATION_COLUMNS, CLIMATE_TABLE_SCHEMA, MARKET_KEYS,
    MARKET_NOT_NULL, MARKET_SERIES_KEY, MARKET_TABLE_SCHEMA, TOPIC,
)
from cropwire.session import scratch_path
from cropwire.sources import (
    climate_request_manifest, land_documents, lookup_producers, market_request_manifest, producer_dimension, producer_ids,
    producers_exist, scan_documents, status_gate, symbol_list, unknown_producers,
)
from cropwire.streaming import stream_climate, stream_keyed

N = 10
AS_OF = "2024-03-01"
STAMP = "2024-03-01T00:00:00Z"
VALUES = ["precipitation", "root_zone_soil_wetness", "temperature_max", "temperature_min"]

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _dim(spark, sf):
    return producer_dimension(spark, fx.fx_producers(spark, sf))


def _null_nan(df: DataFrame, cols=VALUES) -> DataFrame:
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ A ----

@query
def producer_dimension_scan(spark, sf):
    return _dim(spark, sf)


@query
def producer_ids_in_order(spark, sf):
    return producer_ids(_dim(spark, sf))


@query
def producer_lookup(spark, sf):
    docs = fx.fx_climate_docs(spark, sf).select("producer_id")
    return lookup_producers(docs, _dim(spark, sf)).select("producer_id", "producer_name", "commodity_type")


@query
def producer_exists(spark, sf):
    docs = fx.fx_climate_docs(spark, sf).select("producer_id")
    return producers_exist(docs, _dim(spark, sf)).select("producer_id")


@query
def unknown_producers_q(spark, sf):
    docs = fx.fx_climate_docs(spark, sf).select("producer_id")
    return unknown_producers(docs, _dim(spark, sf)).select("producer_id")


@query
def symbol_list_q(spark, sf):
    # One comma list per part, of words of its own columns, with an empty entry inside.
    lists = fx.table(spark, sf, "part").select("p_partkey", F.concat_ws(",", "p_brand", F.lit(""), "p_type", "p_brand").alias("symbols"))
    return symbol_list(spark, lists).select("p_partkey", "pos", "symbol")


@query
def climate_date_window(spark, sf):
    # Trailing 30-day window ending at each producer's last reported day.
    last = fx.table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    w = date_window(F.to_date("last_ts"), 30)
    return last.select(F.concat(F.lit("P"), F.col("user_id")).alias("producer_id"),
                       w["start_date"].alias("start_date"), w["end_date"].alias("end_date"))


@query
def market_request_manifest_q(spark, sf):
    return market_request_manifest(fx.fx_market_docs(spark, sf).select("symbol")).select("symbol", "url")


@query
def climate_request_manifest_q(spark, sf):
    # Coordinates by arithmetic on the customer key; half degrees print alike everywhere.
    dim = _dim(spark, sf).select("ordinal", "producer_id", (F.col("ordinal") % 360 - 180 + 0.5).cast("double").alias("longitude"),
                                 (F.col("ordinal") % 180 - 90 + 0.5).cast("double").alias("latitude"))
    return climate_request_manifest(dim, AS_OF).select("producer_id", "start_date", "end_date", "url")


@query
def climate_raw_scan(spark, sf):
    """Landed documents read back whole: status, sequence, and what the bodies say."""
    path = scratch_path(spark, "landing-climate")
    land_documents(fx.fx_climate_docs(spark, sf).drop("user_id"), path, fmt="json")
    docs = scan_documents(spark, path, "producer_id", fmt="json")
    body = F.from_json("raw", "properties STRUCT<parameter: STRUCT<PRECTOTCORR: MAP<STRING, STRING>>>", LENIENT)
    values = F.map_values(body["properties"]["parameter"]["PRECTOTCORR"])
    return docs.select("producer_id", "doc_seq", "http_status", F.coalesce(F.size(values), F.lit(-1)).cast("bigint").alias("days"),
                       F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(v.try_cast("double"), F.lit(0.0))).alias("total"))


@query
def market_raw_scan(spark, sf):
    path = scratch_path(spark, "landing-market")
    land_documents(fx.fx_market_docs(spark, sf).drop("sn"), path, fmt="json")
    docs = scan_documents(spark, path, "symbol", fmt="json")
    weeks = F.map_values(F.from_json("raw", f"`{MARKET_SERIES_KEY}` MAP<STRING, MAP<STRING, STRING>>")[MARKET_SERIES_KEY])
    return docs.select("symbol", "doc_seq", "http_status", F.size(weeks).cast("bigint").alias("weeks"),
                       F.aggregate(weeks, F.lit(0.0), lambda a, w: a + w["4. close"].cast("double")).alias("close_total"))


@query
def response_status_gate(spark, sf):
    return status_gate(fx.fx_market_docs_faulty(spark, sf)).select("symbol", "accepted")


# ------------------------------------------------------------------ B ----

def _climate_staged(spark, sf):
    return cl.stage_climate(fx.fx_climate_docs(spark, sf))


def _climate_gated(spark, sf):
    return cl.gate_climate(fx.fx_climate_docs(spark, sf))


@query
def climate_parse(spark, sf):
    parsed = cl.parse_climate(fx.fx_climate_docs(spark, sf))
    parameter = F.col("doc.properties.parameter")
    return parsed.select("producer_id", F.col("doc").isNotNull().alias("is_object"), parameter.isNotNull().alias("has_parameter"),
                         F.size(F.col("doc.messages")).cast("bigint").alias("messages"),
                         F.coalesce(F.size(parameter["T2M_MAX"]), F.lit(-1)).cast("bigint").alias("days"))


@query
def climate_structure_gate(spark, sf):
    return (_climate_gated(spark, sf).select("producer_id", F.col("fault").alias("reason"))
            .filter(F.col("reason").isin("unparsable", "missing_properties", "missing_parameter")))


@query
def climate_required_series(spark, sf):
    return _climate_gated(spark, sf).filter(F.col("fault").isNull()).select("producer_id")


@query
def climate_messages(spark, sf):
    return cl.climate_messages(_climate_gated(spark, sf))


@query
def climate_fill_value(spark, sf):
    return _climate_gated(spark, sf).select("producer_id", "fill_value")


@query
def climate_align(spark, sf):
    return cl.climate_aligned_days(_climate_staged(spark, sf)).select(
        "producer_id", "date", *[nan_to_null(F.col(c)).alias(c) for c in VALUES])


@query
def climate_complete_days(spark, sf):
    return cl.climate_complete_days(_climate_staged(spark, sf))


@query
def climate_incomplete_days(spark, sf):
    return cl.climate_incomplete_days(_climate_staged(spark, sf))


@query
def climate_bad_days(spark, sf):
    return cl.climate_bad_days(_climate_staged(spark, sf))


@query
def climate_fill_to_nan(spark, sf):
    days = cl.climate_ordered_days(_climate_staged(spark, sf))
    return days.select("producer_id", "date", nan_to_null(F.col("precipitation")).alias("precipitation"),
                       F.isnan("precipitation").alias("is_fill"))


@query
def climate_ordered_days(spark, sf):
    return cl.climate_ordered_days(_climate_staged(spark, sf)).select("producer_id", "date", "pos")


@query
def climate_observations(spark, sf):
    obs = climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf)).observations
    return _null_nan(obs.select(*CLIMATE_OBSERVATION_COLUMNS))


def _climate_table(spark, sf, captured_at=STAMP) -> str:
    table = scratch_path(spark, "climate_table")
    run_climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf), table, captured_at=captured_at)
    return table


@query
def climate_stored_values(spark, sf):
    table = scratch_path(spark, "climate_values")
    obs = climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf)).observations
    insert_or_ignore(obs, table, keys=CLIMATE_KEYS, arrival=["doc_seq", "pos"],
                     columns=CLIMATE_OBSERVATION_COLUMNS, not_null=CLIMATE_NOT_NULL, captured_at=STAMP)
    return read_table(spark, table).select(*CLIMATE_OBSERVATION_COLUMNS)


@query
def climate_cycle_q(spark, sf):
    return read_table(spark, _climate_table(spark, sf)).select(*CLIMATE_OBSERVATION_COLUMNS)


@query
def climate_table_schema(spark, sf):
    return read_table(spark, _climate_table(spark, sf))


@query
def climate_insert_or_ignore(spark, sf):
    table = scratch_path(spark, "climate_ioi")
    obs = climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf)).observations
    kw = dict(keys=CLIMATE_KEYS, arrival=["doc_seq", "pos"], columns=CLIMATE_OBSERVATION_COLUMNS,
              not_null=CLIMATE_NOT_NULL)
    insert_or_ignore(obs, table, captured_at=STAMP, **kw)
    insert_or_ignore(obs.withColumn("precipitation", F.col("precipitation") + 1), table,
                     captured_at="2024-03-02T00:00:00Z", **kw)
    return read_table(spark, table).select("producer_id", "date", "precipitation")


# ------------------------------------------------------------------ C ----

def _market_staged(docs, max_weeks=N):
    return mk.stage_market(docs, max_weeks)


@query
def market_parse(spark, sf):
    parsed = mk.parse_market(fx.fx_market_docs(spark, sf))
    weeks = last_wins_entries(F.col("doc")[MARKET_SERIES_KEY])
    return parsed.select("symbol", F.size(weeks).cast("bigint").alias("weeks"),
                         F.aggregate(weeks, F.lit(0.0), lambda a, e: a + e["value"]["4. close"].cast("double")).alias("close_total"),
                         F.aggregate(weeks, F.lit(0).cast("bigint"), lambda a, e: a + e["value"]["6. volume"].cast("bigint")).alias("volume_total"))


@query
def market_error_gate(spark, sf):
    st = _market_staged(fx.fx_market_docs_faulty(spark, sf))
    return (st.filter(F.col("fault").isin("provider_error", "provider_note"))
            .select("symbol", F.col("fault").alias("reason"), "detail"))


@query
def market_series_gate(spark, sf):
    st = _market_staged(fx.fx_market_docs_faulty(spark, sf))
    return st.filter(F.col("fault") == "missing_series").select("symbol", F.col("fault").alias("reason"))


@query
def market_ordered_weeks(spark, sf):
    return mk.market_ordered_weeks(_market_staged(fx.fx_market_docs(spark, sf), None))


@query
def market_first_n_weeks(spark, sf):
    obs = mk.market_observations(_market_staged(fx.fx_market_docs(spark, sf, ascending=True)))
    return obs.select("symbol", "week")


@query
def market_cast(spark, sf):
    obs = mk.market_observations(_market_staged(fx.fx_market_docs(spark, sf), None))
    return obs.select("symbol", "week", "open", "high", "low", "close", "volume")


@query
def market_price_instant(spark, sf):
    obs = mk.market_observations(_market_staged(fx.fx_market_docs(spark, sf), None))
    return obs.select("symbol", epoch_seconds(F.col("price_timestamp")).alias("price_epoch"))


@query
def market_document_abort(spark, sf):
    docs = fx.fx_market_docs_faulty(spark, sf)
    out = None
    for n in (10, 2):
        st = _market_staged(docs, n).filter(F.col("fault").isNull())
        part = st.select(F.lit(n).alias("n"), "symbol", F.size("rows").cast("bigint").alias("weeks")) \
            .filter(F.col("weeks") > 0)
        out = part if out is None else out.unionByName(part)
    return out


@query
def market_observations(spark, sf):
    obs = mk.market_observations(_market_staged(fx.fx_market_docs(spark, sf)))
    return obs.select("symbol", epoch_seconds(F.col("price_timestamp")).alias("price_epoch"), "open", "high",
                      "low", "close", "adjusted_close", "volume", "dividend_amount")


@query
def market_table_schema(spark, sf):
    table = scratch_path(spark, "market_table")
    run_market_cycle(fx.fx_market_docs(spark, sf), None, table, max_weeks=N, captured_at=STAMP)
    return read_table(spark, table)


@query
def market_insert_or_ignore_rows(spark, sf):
    """E4 on market rows: a repeated symbol later in the list, and a second offer, with other prices are ignored."""
    table = scratch_path(spark, "market_ioi")
    obs = market_store_rows(mk.market_observations(
        _market_staged(fx.fx_market_docs(spark, sf)), carry=("doc_seq",)))
    kw = dict(keys=MARKET_KEYS, arrival=["doc_seq", "pos"], not_null=MARKET_NOT_NULL,
              columns=["symbol", "price_timestamp", "open", "close"])
    repeated = obs.withColumn("doc_seq", F.col("doc_seq") + 1000).withColumn("close", F.col("close") / 2)
    insert_or_ignore(repeated.unionByName(obs), table, captured_at=STAMP, **kw)
    insert_or_ignore(obs.withColumn("close", F.col("close") * 2), table, **kw)
    return read_table(spark, table).select("symbol", "price_timestamp", "close")


# ------------------------------------------------------------------ D ----

def _events(spark, sf):
    obs = mk.market_observations(_market_staged(fx.fx_market_docs(spark, sf)), publishable_only=True)
    return market_events(obs, ts=STAMP)


@query
def no_data_report_q(spark, sf):
    return market_cycle(fx.fx_market_docs_faulty(spark, sf), N, STAMP).no_data.select("symbol")


@query
def market_events_q(spark, sf):
    ev = _events(spark, sf)
    return ev.select(F.col("event.ts").alias("ts"), F.col("event.ss").alias("ss"),
                     F.col("event.data.symbol").alias("symbol"),
                     iso_instant(F.col("event.data.priceTimestamp")).alias("price_timestamp"),
                     F.col("event.data.close").alias("close"))


@query
def event_json_q(spark, sf):
    js = event_json(_events(spark, sf)).select("value")
    g = lambda p: F.get_json_object("value", p)
    return js.select(g("$.ts").alias("ts"), g("$.ss").alias("ss"), g("$.data.symbol").alias("symbol"),
                     g("$.data.priceTimestamp").alias("price_timestamp"),
                     g("$.data.close").cast("double").alias("close"))


def _published(topic: DataFrame) -> DataFrame:
    g = lambda p: F.get_json_object("value", p)
    return topic.select("topic", g("$.ts").alias("ts"), g("$.ss").alias("ss"), g("$.data.symbol").alias("symbol"),
                        g("$.data.priceTimestamp").alias("price_timestamp"), g("$.data.close").cast("double").alias("close"))


@query
def topic_publish(spark, sf):
    path = scratch_path(spark, "topic")
    publish_topic(topic_messages(event_json(_events(spark, sf))), path)
    return _published(read_topic(spark, path, TOPIC))


@query
def topic_replay(spark, sf):
    """A replayed batch replaces its own messages in the file topic."""
    path = scratch_path(spark, "topic")
    for _ in range(2):
        publish_topic(topic_messages(event_json(_events(spark, sf))), path, batch_id=3)
    return _published(read_topic(spark, path, TOPIC))


@query
def topic_order(spark, sf):
    """Each symbol's messages by their place in the topic's files."""
    path = scratch_path(spark, "topic")
    run_market_cycle(fx.fx_market_docs_faulty(spark, sf), path, max_weeks=N, ts=STAMP, batch_id=1)
    read = read_topic(spark, path, TOPIC).select("key", "value", "_metadata.file_name", "_metadata.row_index")
    place = F.row_number().over(Window.partitionBy("key").orderBy("file_name", "row_index")) - 1
    return read.select(F.col("key").alias("symbol"), place.cast("int").alias("place"),
                       F.get_json_object("value", "$.data.priceTimestamp").alias("price_timestamp"))


# ------------------------------------------------------------------ E ----

def _store(spark, sf, cycles, captured=None) -> str:
    table = scratch_path(spark, "store")
    batches = fx.fx_store_batches(spark, sf)
    for c in cycles:
        stamp = captured(c) if captured else STAMP
        insert_or_ignore(batches.filter(F.col("cycle") == c), table, keys=fx.STORE_KEYS,
                         arrival=fx.STORE_ARRIVAL, columns=fx.STORE_COLUMNS, captured_at=stamp)
    return table


@query
def market_insert_or_ignore(spark, sf):
    return read_table(spark, _store(spark, sf, [0, 1, 2])).select("l_orderkey", "l_linenumber",
                                                                  "l_extendedprice")


@query
def capture_stamp(spark, sf):
    t = _store(spark, sf, [0, 1, 2], captured=lambda c: f"2024-01-0{c + 1}T00:00:00Z")
    return read_table(spark, t).groupBy("captured_at").agg(F.count(F.lit(1)).alias("n"))


@query
def surrogate_id(spark, sf):
    return read_table(spark, _store(spark, sf, [0, 1, 2])).select("id", "l_orderkey", "l_linenumber")


@query
def not_null_gate_q(spark, sf):
    docs = fx.table(spark, sf, "documents").select("doc_id")
    joined = docs.join(fx.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    passing, _ = not_null_gate(joined, ["doc_id", "quality"])
    return passing.select("doc_id", "quality")


@query
def batch_replay_idempotent(spark, sf):
    return read_table(spark, _store(spark, sf, [0, 0, 1, 2])).select("l_orderkey", "l_linenumber",
                                                                     "l_extendedprice")


@query
def partitioned_insert_or_ignore(spark, sf):
    """E3 on a table partitioned by a key column with very many values; the later batches do not name the layout."""
    table = scratch_path(spark, "store-partitioned")
    batches = fx.fx_store_batches(spark, sf).withColumn("part", F.col("l_orderkey") % 1500)
    for c, by in ((0, ("part",)), (1, None), (2, None), (0, ("part",))):
        insert_or_ignore(batches.filter(F.col("cycle") == c), table, keys=["part", *fx.STORE_KEYS], arrival=fx.STORE_ARRIVAL,
                         columns=[*fx.STORE_COLUMNS, "part"], captured_at=STAMP, partition_by=by)
    return read_table(spark, table).select("part", "l_orderkey", "l_linenumber", "l_extendedprice")


@query
def climate_table_created(spark, sf):
    """The declared table first, then the cycle's rows."""
    table = scratch_path(spark, "climate_created")
    create_table_if_absent(spark, table, CLIMATE_TABLE_SCHEMA)
    run_climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf), table, captured_at=STAMP)
    return read_table(spark, table)


@query
def market_table_created(spark, sf):
    """The same for the market table."""
    table = scratch_path(spark, "market_created")
    create_table_if_absent(spark, table, MARKET_TABLE_SCHEMA)
    run_market_cycle(fx.fx_market_docs(spark, sf), None, table, max_weeks=N, captured_at=STAMP)
    return read_table(spark, table)


# ------------------------------------------------------------------ F ----

@query
def two_cycle_table(spark, sf):
    landing = scratch_path(spark, "landing-store")
    target = scratch_path(spark, "stream-table")
    ckpt = scratch_path(spark, "stream-ckpt")
    batches = fx.fx_store_batches(spark, sf)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in batches.schema.fields)
    for c in (0, 1, 2):  # one scheduled run per landed cycle
        batches.filter(F.col("cycle") == c).write.mode("append").parquet(landing)
        stream_keyed(spark, landing, schema, target, ckpt, keys=fx.STORE_KEYS, arrival=fx.STORE_ARRIVAL,
                     columns=fx.STORE_COLUMNS, captured_at=STAMP)
    return read_table(spark, target).groupBy("cycle").agg(F.count(F.lit(1)).alias("n"))


@query
def market_cycle_q(spark, sf):
    cyc = market_cycle(fx.fx_market_docs_faulty(spark, sf), N, STAMP)
    ev = cyc.events
    return ev.select(F.col("event.data.symbol").alias("symbol"),
                     iso_instant(F.col("event.data.priceTimestamp")).alias("price_timestamp"),
                     *[F.col(f"event.data.{c}").alias(c) for c in ("open", "high", "low", "close", "volume")])


@query
def cycle_report(spark, sf):
    return market_cycle(fx.fx_market_docs_faulty(spark, sf), N, STAMP).report.select("symbol", "published")


@query
def quarantine(spark, sf):
    return market_cycle(fx.fx_market_docs_faulty(spark, sf), N, STAMP).quarantine.select("key", "reason")


@query
def climate_quarantine(spark, sf):
    """F4 on the climate side: document faults and bad days in one table."""
    return climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf)).quarantine.select(
        "key", "detail_key", "reason")


def _asked(spark, sf):
    """Requested producers: every user with events and, landed or not, those of the dimension."""
    return _dim(spark, sf).select("producer_id").union(fx.fx_climate_docs(spark, sf).select("producer_id")).distinct()


@query
def missing_documents_q(spark, sf):
    """requested producers of which nothing landed."""
    cyc = climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf), _asked(spark, sf))
    return cyc.quarantine.filter("reason = 'no_document'").select("key", "reason")


@query
def climate_report(spark, sf):
    """F5 on the climate side: rows per requested producer, landed or not."""
    cyc = climate_cycle(fx.fx_climate_docs(spark, sf), _dim(spark, sf), _asked(spark, sf))
    return cyc.report.select("producer_id", "rows")


def _two_runs(spark, sf, *outputs: str) -> list[str]:
    """Two runs of the climate stream: producers of even users land before the first, of odd users before the second."""
    landing, table, ckpt, q, rep, log = (scratch_path(spark, f"runs-{n}") for n in ("landing", "table", "ckpt", "quarantine", "report", "log"))
    asked, docs = _asked(spark, sf), fx.fx_climate_docs(spark, sf).repartition(4, "producer_id").persist()
    try:
        for run in (0, 1):
            land_documents(docs.filter(F.col("user_id") % 2 == run).drop("user_id"), landing)
            stream_climate(spark, landing, _dim(spark, sf), table, ckpt, q, requested=asked, report_path=rep, log_path=log, captured_at=STAMP)
    finally:
        docs.unpersist()
    paths = {"quarantine": q, "report": rep, "log": log}
    return [paths[o] for o in outputs]


@query
def stream_missing(spark, sf):
    """F5 in a stream: each run reports the requested producers that did not land since the run before."""
    quarantine, = _two_runs(spark, sf, "quarantine")
    rows = spark.read.parquet(quarantine).filter("reason = 'no_document'")
    return rows.select(F.element_at(F.split("batch_id", "-"), -1).cast("int").alias("cycle"), "key", "reason")


@query
def cycle_log(spark, sf):
    """F5 in a stream: what each batch wrote, from its log."""
    log, = _two_runs(spark, sf, "log")
    return spark.read.parquet(log).select("epoch", "documents", "rows", "inserted", "quarantined")


def _replayed(spark, sf, output: str) -> DataFrame:
    """A side output of one market batch that ran twice under its id."""
    paths = {k: scratch_path(spark, f"replay-{k}") for k in ("topic", "quarantine", "report")}
    for _ in range(2):
        run_market_cycle(fx.fx_market_docs_faulty(spark, sf), paths["topic"], quarantine_path=paths["quarantine"],
                         report_path=paths["report"], max_weeks=N, ts=STAMP, batch_id=7)
    return spark.read.parquet(paths[output])


@query
def quarantine_replay(spark, sf):
    return _replayed(spark, sf, "quarantine").select("key", "reason")


@query
def cycle_report_replay(spark, sf):
    return _replayed(spark, sf, "report").select("symbol", "published")


# Registered key -> function (keys are the operator names of the blueprint).
KEYS: dict[str, Query] = {
    "producer_dimension": producer_dimension_scan,
    "producer_ids": producer_ids_in_order,
    "producer_lookup": producer_lookup,
    "producer_exists": producer_exists,
    "unknown_producers": unknown_producers_q,
    "symbol_list": symbol_list_q,
    "climate_date_window": climate_date_window,
    "market_request_manifest": market_request_manifest_q,
    "climate_raw_scan": climate_raw_scan,
    "market_raw_scan": market_raw_scan,
    "response_status_gate": response_status_gate,
    "climate_parse": climate_parse,
    "climate_structure_gate": climate_structure_gate,
    "climate_required_series": climate_required_series,
    "climate_messages": climate_messages,
    "climate_fill_value": climate_fill_value,
    "climate_align": climate_align,
    "climate_complete_days": climate_complete_days,
    "climate_incomplete_days": climate_incomplete_days,
    "climate_bad_days": climate_bad_days,
    "climate_fill_to_nan": climate_fill_to_nan,
    "climate_ordered_days": climate_ordered_days,
    "climate_observations": climate_observations,
    "climate_stored_values": climate_stored_values,
    "climate_cycle": climate_cycle_q,
    "climate_table_schema": climate_table_schema,
    "climate_insert_or_ignore": climate_insert_or_ignore,
    "climate_quarantine": climate_quarantine,
    "market_parse": market_parse,
    "market_error_gate": market_error_gate,
    "market_series_gate": market_series_gate,
    "market_ordered_weeks": market_ordered_weeks,
    "market_first_n_weeks": market_first_n_weeks,
    "market_cast": market_cast,
    "market_price_instant": market_price_instant,
    "market_document_abort": market_document_abort,
    "market_observations": market_observations,
    "market_table_schema": market_table_schema,
    "market_rows_insert_or_ignore": market_insert_or_ignore_rows,
    "no_data_report": no_data_report_q,
    "market_events": market_events_q,
    "event_json": event_json_q,
    "topic_publish": topic_publish,
    "market_cycle": market_cycle_q,
    "cycle_report": cycle_report,
    "quarantine": quarantine,
    "market_insert_or_ignore": market_insert_or_ignore,
    "capture_stamp": capture_stamp,
    "surrogate_id": surrogate_id,
    "not_null_gate": not_null_gate_q,
    "batch_replay_idempotent": batch_replay_idempotent,
    "two_cycle_table": two_cycle_table,
    "climate_request_manifest": climate_request_manifest_q,
    "partitioned_insert_or_ignore": partitioned_insert_or_ignore,
    "climate_table_created": climate_table_created,
    "market_table_created": market_table_created,
    "topic_replay": topic_replay,
    "topic_order": topic_order,
    "stream_missing": stream_missing,
    "cycle_log": cycle_log,
    "missing_documents": missing_documents_q,
    "climate_report": climate_report,
    "quarantine_replay": quarantine_replay,
    "cycle_report_replay": cycle_report_replay,
}
