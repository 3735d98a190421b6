"""Whole-text parsing and the exact spellings of numbers."""

import json

import pytest
from pyspark.sql import functions as F

from cropwire.functions.json import parse_whole
from cropwire.functions.numbers import read_double, read_long
from cropwire.operators.climate import stage_climate
from cropwire.operators.market import stage_market
from cropwire.plans.cycles import run_climate_cycle, run_market_cycle
from cropwire.session import scratch_path
from cropwire.sources import producer_dimension, producer_ids

FIELDS = ("1. open", "2. high", "3. low", "4. close", "5. adjusted close", "6. volume", "7. dividend amount")
DOCS = "symbol string, doc_seq bigint, http_status int, raw string"


@pytest.mark.parametrize("raw, whole", [
    ('{"a":"1"}', True), (' {"a":"1"} \n', True), ('{}', True), ('{"a":"1"} xx', False), ('{"a":"1"}{}', False),
    ('{a:"1"}', True), ('/* c */ {"a":/* d */"1"} // e', True), ('{"a":"1"} // e\n', True), ('{"a":"1"} /* open', False), ("{'a':'1'}", True), ('{"a":"x\ny"}', True),
    ('{"a":"1"},{"__end":"1"}] rest', False), ('{"a":"1"}\n,{"__end":"' + "0" * 64 + '"}]', False), ('{"a":"1"} // e\n{}', False),
    ('{"a":"1"},{}', False), ('{"a":"1"}] x', False), ('{"a":"1"}}', False), ('{"a":"1"', False), ("[1]", False), ("12", False), ("", False), (None, False)])
def test_only_one_whole_object_parses(spark, raw, whole):
    got = spark.createDataFrame([(raw,)], "raw string").select(parse_whole(F.col("raw"), "a STRING").isNotNull()).first()[0]
    assert got == whole


def test_number_spellings(spark):
    texts = ["1", " 1.5 ", "NaN", "Infinity", "-Infinity", "nan", "inf", "+inf", "infinity", "INFINITY", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(read_double(F.col("t")).alias("d")).collect()
    assert [r.d is not None for r in rows] == [True, True, True, True, True] + [False] * 7
    longs = spark.createDataFrame([(t,) for t in ("12", "-3", "+4", "12.0", " 12 ", "1e3", None)], "t string") \
        .select(read_long(F.col("t")).alias("n")).collect()
    assert [r.n for r in longs] == [12, -3, 4, None, None, None, None]


def market(**volumes):
    return '{"Weekly Adjusted Time Series": {%s}}' % ", ".join(
        '"%s": {%s}' % (day.replace("d", "2024-03-0"), ", ".join('"%s": %s' % (f, v if f == FIELDS[5] else '"1"') for f in FIELDS))
        for day, v in volumes.items())


@pytest.mark.parametrize("volumes, read", [
    ({"d1": "12.0", "d2": '"7"'}, [12, 7]), ({"d1": "1e3"}, [1000]), ({"d1": "12.9"}, [12]), ({"d1": "5"}, [5]),
    ({"d1": '"12.0"'}, None), ({"d1": '" 12 "'}, None), ({"d1": "3.5", "d2": '"3.5"'}, None)])
def test_quoted_volumes_are_strict_and_numbers_are_cut(spark, volumes, read):
    docs = spark.createDataFrame([("A", 1, 200, market(**volumes))], DOCS)
    r = stage_market(docs, 10).first()
    assert (r.fault, [x.volume for x in r.rows] if r.rows else None) == ((None, read) if read else ("bad_entry", None))


def test_text_behind_the_document_is_refused(spark):
    assert stage_market(spark.createDataFrame([("A", 1, 200, market(d1="1") + " xx")], DOCS), 10).first().fault == "unparsable"
    s = {"20240101": 1.0}
    raw = json.dumps({"properties": {"parameter": {k: s for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})
    docs = spark.createDataFrame([("WHEAT_1", raw), ("CORN_1", raw + "{}")], "producer_id string, raw string")
    assert {r.producer_id: r.fault for r in stage_climate(docs).collect()} == {"WHEAT_1": None, "CORN_1": "unparsable"}


def test_replayed_batches_replace_their_side_outputs(spark):
    q, rep, msg, table, topic = (scratch_path(spark, n) for n in ("r-q", "r-rep", "r-msg", "r-table", "r-topic"))
    s = {"20240101": 1.0, "20240102": "inf"}
    raw = json.dumps({"messages": ["late"], "properties": {"parameter": {k: s for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})
    dim = producer_dimension(spark)
    docs = spark.createDataFrame([("WHEAT_1", 1, 200, raw), ("NOPE", 2, 200, raw)], DOCS.replace("symbol", "producer_id"))
    for _ in range(2):
        run_climate_cycle(docs, dim, table, q, report_path=rep, messages_path=msg, batch_id=4, requested=producer_ids(dim))
    got = [(r.key, r.detail_key, r.reason) for r in spark.read.parquet(q).collect()]
    assert sorted(x[2] for x in got) == ["bad_number"] + ["no_document"] * 24 + ["unknown_producer"]
    assert ("WHEAT_1", "20240102", "bad_number") in got
    assert spark.read.parquet(rep).count() == 26 and spark.read.parquet(msg).count() == 1
    for _ in range(2):
        run_market_cycle(spark.createDataFrame([("A", 1, 200, market(d1="1"))], DOCS), topic, batch_id=9, ts="t")
    assert spark.read.parquet(topic).count() == 1


def test_symbol_list_position_is_the_arrival_order(spark):
    table = scratch_path(spark, "r-order")
    asked = spark.createDataFrame([(0, "B"), (1, "A"), (2, "C")], "pos int, symbol string")
    docs = spark.createDataFrame([("A", 200, market(d1="1")), ("B", 200, market(d1="2"))], "symbol string, http_status int, raw string")
    run = run_market_cycle(docs, None, table, scratch_path(spark, "r-oq"), requested=asked)
    assert run.quarantined == 1  # C never landed
    assert [(r.id, r.symbol) for r in spark.read.parquet(table).orderBy("id").collect()] == [(1, "B"), (2, "A")]


def test_a_feed_creates_its_table_before_anything_lands(spark):
    import os

    from cropwire.operators.keyed_sink import read_table
    from cropwire.schemas import CLIMATE_TABLE_SCHEMA
    from cropwire.streaming import stream_climate
    landing, table, ckpt = (scratch_path(spark, n) for n in ("e-land", "e-table", "e-ckpt"))
    os.makedirs(landing.removeprefix("file://"))
    stream_climate(spark, landing, producer_dimension(spark), table, ckpt, partition_by=("commodity_type",))
    got = read_table(spark, table)
    assert got.count() == 0 and set(got.columns) == {f.name for f in CLIMATE_TABLE_SCHEMA.fields}


def test_lenient_documents_read_like_strict_ones(spark):
    s = {"20240101": 1.0, "20240102": "2"}
    strict = json.dumps({"header": {"fill_value": -999.0}, "messages": ["m"], "properties": {"parameter": {k: s for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})
    bare = "/* daily\n*/ " + strict.replace('"properties":', "properties:").replace('"20240101":', "20240101 /* day */ :") + " // end"
    docs = spark.createDataFrame([("A", strict), ("B", bare)], "producer_id string, raw string")
    a, b = (r.days for r in stage_climate(docs).orderBy("producer_id").collect())
    assert a == b and len(a) == 2
    note = spark.createDataFrame([("A", 1, 200, "{Note: null}"), ("B", 1, 200, '// n\n{"Error Message": "x"}'), ("C", 1, 200, "/**/" + market(d1="5") + "//")], DOCS)
    assert [r.fault for r in stage_market(note, 10).orderBy("symbol").collect()] == ["provider_note", "provider_error", None]


def test_gate_queries_do_not_align_days(spark):
    from cropwire.plans.queries import KEYS
    sf = "/root/testdata/sf0.001"
    for name in ("climate_fill_value", "climate_messages", "climate_structure_gate", "climate_required_series"):
        plan = KEYS[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "sort_array" not in plan and plan.count("from_json") == 1, name
    assert "sort_array" in KEYS["climate_complete_days"](spark, sf)._jdf.queryExecution().executedPlan().toString()
