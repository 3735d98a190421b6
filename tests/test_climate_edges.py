"""Hand-written climate documents and their expected verdicts."""

import json
import math

import pytest
from pyspark.sql import functions as F

from cropwire.operators import climate as cl


def stage(spark, *raws):
    rows = [(f"P{i}", i, 200, r) for i, r in enumerate(raws)]
    docs = spark.createDataFrame(rows, "producer_id string, doc_seq bigint, http_status int, raw string")
    return cl.stage_climate(docs)


def doc(p=None, g=None, x=None, n=None, header={"fill_value": -999.0}, messages=None, drop=()):
    series = {"PRECTOTCORR": p or {}, "GWETROOT": g or {}, "T2M_MAX": x or {}, "T2M_MIN": n or {}}
    for d in drop:
        series.pop(d)
    body = {"properties": {"parameter": series}}
    if header is not None:
        body["header"] = header
    if messages is not None:
        body["messages"] = messages
    return json.dumps(body)


def faults(spark, *raws):
    return [r["fault"] for r in stage(spark, *raws).orderBy("doc_seq").collect()]


def obs(spark, raw):
    st = stage(spark, raw).withColumn("producer_name", F.lit("n")).withColumn("commodity_type", F.lit("c"))
    return [r.asDict() for r in cl.climate_observations(st).orderBy("pos").collect()]


@pytest.mark.parametrize("raw", ["not json", "[1]", '"x"', ""])
def test_unparsable_documents_are_quarantined(spark, raw):
    assert faults(spark, raw) == ["unparsable"]


def test_structure_reasons(spark):
    got = faults(spark, '{"properties": [1]}', '{"properties": {"parameter": "text"}}', '{"header": {}}',
                 doc(drop=("T2M_MIN",)), json.dumps({"properties": {"parameter": {
                     "PRECTOTCORR": {}, "GWETROOT": [1], "T2M_MAX": {}, "T2M_MIN": {}}}}))
    assert got == ["missing_properties", "missing_parameter", "missing_properties", "missing_series",
                   "missing_series"]


def test_empty_series_pass_with_no_rows(spark):
    st = stage(spark, doc())
    r = st.collect()[0]
    assert r["fault"] is None and r["days"] == []


def test_alignment_driven_by_first_series(spark):
    d = doc(p={"20240101": 1}, g={"20240101": 2, "20240102": 9}, x={"20240101": 3}, n={"20240101": 4})
    days = cl.climate_aligned_days(stage(spark, d)).collect()
    assert [r["date"] for r in days] == ["20240101"]


def test_null_and_bad_values_drop_only_that_day(spark):
    d = doc(p={"20240103": 1, "20240102": 1, "20240101": 1},
            g={"20240103": None, "20240102": "oops", "20240101": 2},
            x={"20240103": 1, "20240102": 1, "20240101": 3},
            n={"20240103": 1, "20240102": 1, "20240101": "4.5"})
    st = stage(spark, d)
    assert [r["date"] for r in cl.climate_incomplete_days(st).collect()] == ["20240103"]
    assert [r["date"] for r in cl.climate_bad_days(st).collect()] == ["20240102"]
    rows = obs(spark, d)
    assert [(r["date"], r["temperature_min"]) for r in rows] == [("20240101", 4.5)]


def test_fill_becomes_nan_row_kept(spark):
    d = doc(p={"20240102": -999.0, "20240101": 0.0}, g={"20240102": 1, "20240101": -0.0},
            x={"20240102": 1, "20240101": 1}, n={"20240102": 1, "20240101": 1}, header={"fill_value": 0.0})
    rows = obs(spark, d)
    assert [r["date"] for r in rows] == ["20240102", "20240101"]  # date text descending
    assert rows[0]["precipitation"] == -999.0  # fill is 0.0 here
    assert math.isnan(rows[1]["precipitation"])  # 0.0 == fill
    assert rows[1]["root_zone_soil_wetness"] == 0.0 and math.copysign(1, rows[1]["root_zone_soil_wetness"]) < 0


@pytest.mark.parametrize("header", [None, {"fill_value": "abc"}, {"fill_value": None}, {}, 5])
def test_no_fill_no_substitution(spark, header):
    d = doc(p={"20240101": -999.0}, g={"20240101": 1}, x={"20240101": 1}, n={"20240101": 1}, header=header)
    assert obs(spark, d)[0]["precipitation"] == -999.0


def test_date_key_kept_as_text(spark):
    d = doc(p={"not-a-date": 1}, g={"not-a-date": 1}, x={"not-a-date": 1}, n={"not-a-date": 1})
    assert obs(spark, d)[0]["date"] == "not-a-date"


def test_duplicate_date_last_value_wins(spark):
    raw = ('{"properties":{"parameter":{"PRECTOTCORR":{"20240101":1,"20240101":7},'
           '"GWETROOT":{"20240101":2},"T2M_MAX":{"20240101":3},"T2M_MIN":{"20240101":4}}}}')
    rows = obs(spark, raw)
    assert len(rows) == 1 and rows[0]["precipitation"] == 7.0


def test_misaligned_series_use_lookup(spark):
    d = doc(p={"20240101": 1, "20240102": 2}, g={"20240102": 20, "20240101": 10},
            x={"20240101": 1, "20240102": 1}, n={"20240101": 1, "20240102": 1})
    rows = obs(spark, d)
    assert [(r["date"], r["root_zone_soil_wetness"]) for r in rows] == [("20240102", 20.0), ("20240101", 10.0)]


def test_messages_reported(spark):
    st = stage(spark, doc(messages=["a", {"b": 1}]), doc(messages="x"), doc(messages=[]))
    got = sorted((r["producer_id"], r["message"]) for r in cl.climate_messages(st).collect())
    assert got == [("P0", "a"), ("P0", '{"b":1}')]


def test_single_parse_in_plan(spark):
    st = stage(spark, doc())
    plan = st._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_bad_day_quarantine_names_the_series(spark):
    from cropwire.plans.cycles import climate_cycle
    from cropwire.sources import producer_dimension
    d = doc(p={"20240101": 1}, g={"20240101": "oops"}, x={"20240101": 1}, n={"20240101": True})
    docs = spark.createDataFrame([("WHEAT_1", d)], "producer_id string, raw string")
    q = climate_cycle(docs, producer_dimension(spark)).quarantine.collect()
    assert [(r.key, r.detail_key, r.reason, r.detail) for r in q] == [
        ("WHEAT_1", "20240101", "bad_number", "GWETROOT,T2M_MIN")]
