"""Dimension, request planning, status gate, events and topic sink."""

import json

import pytest
from pyspark.sql import functions as F

from cropwire.functions.dates import iso_instant
from cropwire.operators.events import broker_rows, event_json, market_events, publish_topic, read_topic, topic_messages
from cropwire.session import scratch_path
from cropwire.sources import (
    climate_request_manifest, land_documents, lookup_producers, market_request_manifest,
    producer_dimension, producer_ids, scan_documents, status_gate, symbol_list, unknown_producers,
)


def test_builtin_dimension(spark):
    dim = producer_dimension(spark)
    rows = dim.orderBy("ordinal").collect()
    assert len(rows) == 25 and rows[0]["producer_id"] == "WHEAT_1" and rows[24]["producer_id"] == "NATGAS_5"
    assert {r["commodity_type"] for r in rows} == {"WHEAT", "CORN", "SOY_BEANS", "COFFEE", "NATURAL_GAS"}
    assert [r["producer_id"] for r in producer_ids(dim).collect()][:3] == ["WHEAT_1", "WHEAT_2", "WHEAT_3"]


def test_lookup_and_unknown(spark):
    dim = producer_dimension(spark)
    docs = spark.createDataFrame([("CORN_1",), ("NOPE",)], "producer_id string")
    got = {r["producer_id"]: r["producer_name"] for r in lookup_producers(docs, dim).collect()}
    assert got == {"CORN_1": "Iowa - USA", "NOPE": None}
    assert [r[0] for r in unknown_producers(docs, dim).collect()] == ["NOPE"]


def test_symbol_list_java_split(spark):
    assert [(r.pos, r.symbol) for r in symbol_list(spark, "a,,b,,").collect()] == [(0, "a"), (1, ""), (2, "b")]
    assert [r.symbol for r in symbol_list(spark, "WEAT,CORN,WEAT").collect()] == ["WEAT", "CORN", "WEAT"]
    assert [r.symbol for r in symbol_list(spark, "").collect()] == [""]
    assert symbol_list(spark, ",,").count() == 0


def test_climate_manifest_urls(spark):
    m = climate_request_manifest(producer_dimension(spark), "2024-03-01").orderBy("ordinal").collect()
    assert m[0]["start_date"] == "20240201" and m[0]["end_date"] == "20240301"
    assert "longitude=1.75&latitude=48.1&start=20240201&end=20240301&format=JSON" in m[0]["url"]
    assert "longitude=-98.0&latitude=38.5" in m[4]["url"]


def test_market_manifest_keeps_placeholder(spark):
    syms = symbol_list(spark, "WEAT")
    url = market_request_manifest(syms).first()["url"]
    assert url.endswith("symbol=WEAT&apikey={api_key}")


def test_status_gate(spark):
    docs = spark.createDataFrame([("a", 200, "{}"), ("b", 503, "{}"), ("c", 204, None)],
                                 "symbol string, http_status int, raw string")
    got = {r.symbol: (r.accepted, r.status_reason) for r in status_gate(docs).collect()}
    assert got == {"a": (True, None), "b": (False, "http_503"), "c": (False, "empty_body")}


def test_wholetext_scan(spark, tmp_path):
    (tmp_path / "WHEAT_1.json").write_text('{"properties": {}}')
    (tmp_path / "CORN_1.json").write_text('{"a": 1}')
    got = {r.producer_id: r.raw for r in scan_documents(spark, str(tmp_path), "producer_id", "wholetext").collect()}
    assert got == {"WHEAT_1": '{"properties": {}}', "CORN_1": '{"a": 1}'}


def test_land_and_scan_roundtrip(spark):
    path = scratch_path(spark, "t-landing")
    docs = spark.createDataFrame([("S", 1, 200, "{}")], "symbol string, doc_seq bigint, http_status int, raw string")
    land_documents(docs, path)
    assert scan_documents(spark, path, "symbol").collect()[0].asDict() == docs.collect()[0].asDict()


def _obs(spark):
    return spark.createDataFrame(
        [("WEAT", 1709251200, 5.1, 5.3, 5.0, 5.2, 5.2, 100, 0.0)],
        "symbol string, t bigint, open double, high double, low double, close double, adjusted_close double, "
        "volume bigint, dividend_amount double").withColumn("price_timestamp", F.timestamp_seconds("t")).drop("t")


def test_event_json_shape(spark):
    js = event_json(market_events(_obs(spark), ts="2024-03-01T10:00:00.123Z")).first()["value"]
    assert json.loads(js) == {"ts": "2024-03-01T10:00:00.123Z", "ss": "market-feeder", "data": {
        "symbol": "WEAT", "priceTimestamp": "2024-03-01T00:00:00Z", "open": 5.1, "high": 5.3, "low": 5.0,
        "close": 5.2, "adjustedClose": 5.2, "volume": 100, "dividendAmount": 0.0}}
    assert list(json.loads(js)) == ["ts", "ss", "data"]


def test_event_json_is_safe_in_html(spark):
    obs = _obs(spark).withColumn("symbol", F.lit("ZC=F <a&b> 'x' \u2028\\"))
    js = event_json(market_events(obs, ts="t")).first()["value"]
    assert '"symbol":"ZC\\u003dF \\u003ca\\u0026b\\u003e \\u0027x\\u0027 \\u2028\\\\"' in js
    assert json.loads(js)["data"]["symbol"] == "ZC=F <a&b> 'x' \u2028\\"


def test_topic_sink_appends(spark):
    path = scratch_path(spark, "t-topic")
    msgs = topic_messages(event_json(market_events(_obs(spark), ts="x")))
    publish_topic(msgs, path)
    publish_topic(msgs, path)  # no de-dup: each cycle re-emits
    assert read_topic(spark, path).count() == 2


def _messages(spark, n=300):
    """Messages of 7 symbols, one of them with two thirds of all, dealt out in a wrong order."""
    rows = [("HOT" if i % 3 else f"S{i % 7}", i % 5, i, f"{i % 5}-{i:04d}") for i in range(n)]
    return (spark.createDataFrame(rows, "key string, doc_seq bigint, pos int, value string").withColumn("topic", F.lit("T"))
            .orderBy(F.desc("value")).repartition(5))


@pytest.fixture
def uncoalesced(spark):
    """As many tasks as there are shuffle partitions, however small the data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_broker_rows_keep_a_symbols_order_in_one_task(spark, uncoalesced):
    rows = broker_rows(_messages(spark), batch_id=42)
    assert rows.dtypes == [("topic", "string"), ("key", "string"), ("value", "string"), ("headers", "array<struct<key:string,value:binary>>")]
    assert [(h.key, bytes(h.value)) for h in rows.first().headers] == [("batch_id", b"42")]
    assert broker_rows(_messages(spark)).columns == ["topic", "key", "value"]
    sent = rows.select("key", "value", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")).orderBy("at").collect()
    tasks, values = {}, {}
    for r in sent:
        tasks.setdefault(r.key, set()).add(r.task)
        values.setdefault(r.key, []).append(r.value)
    assert len(sent) == 300 and all(len(t) == 1 for t in tasks.values()) and len(set.union(*tasks.values())) > 1
    assert all(v == sorted(v) for v in values.values())


def test_files_keep_the_order_of_a_run(spark, uncoalesced):
    path = scratch_path(spark, "t-order")
    for batch in (1, 1, 2):
        publish_topic(_messages(spark), path, batch_id=batch)
    for batch in (1, 2):
        rows = (read_topic(spark, path, "T").filter(F.col("batch_id") == batch)
                .select("doc_seq", "key", "pos", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect())
        assert len(rows) == 300 and len({r.file_name for r in rows}) > 1
        assert [r[:3] for r in rows] == sorted(r[:3] for r in rows)
        assert len({r.file_name for r in rows if r.key == "HOT"}) > 1  # a hot symbol is split


def test_iso_instant_zone_free(spark):
    df = spark.createDataFrame([(1709251200123456,), (-1,)], "m bigint").select(iso_instant(F.timestamp_micros("m")))
    assert [r[0] for r in df.collect()] == ["2024-03-01T00:00:00.123456Z", "1969-12-31T23:59:59.999999Z"]


def test_utc_now_iso_fraction():
    import datetime as dt
    from cropwire.functions.dates import utc_now_iso
    t = dt.datetime(2024, 3, 1, 10, 15, 30, tzinfo=dt.timezone.utc)
    assert utc_now_iso(t) == "2024-03-01T10:15:30Z"
    assert utc_now_iso(t.replace(microsecond=123000)) == "2024-03-01T10:15:30.123Z"
    assert utc_now_iso(t.replace(microsecond=123456)) == "2024-03-01T10:15:30.123456Z"
