"""Random documents against a small pure-Python model of the parsing rules.

Each example is one batch of many documents, so one Spark job checks many
shapes at once: missing keys, JSON nulls, unreadable values, misaligned and
partial series, fill values, non-object entries, first-N cut-offs.
"""

import json
import math
import re
import struct

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cropwire.operators import climate as cl
from cropwire.operators import market as mk

SERIES = ["PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN"]
VALUES = st.one_of(st.sampled_from([1.5, -999.0, 0.0, -0.0, 12, "3.25", "-999.0", "oops", None, True, {}, [1]]),
                   st.floats(min_value=-1e6, max_value=1e6, allow_nan=False).map(lambda x: round(x, 3)))
DATES = st.sampled_from(["20240101", "20240102", "20240103", "20240104", "20240105"])


def _double(v):
    if isinstance(v, bool) or v is None or isinstance(v, (dict, list)):
        raise ValueError
    if isinstance(v, (int, float)):
        return float(v)
    if re.fullmatch(r"\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*", v):
        return float(v)
    raise ValueError


def _bits(x):
    return struct.pack(">d", x)


def climate_model(raw):
    obj = _load(raw)
    props = obj.get("properties")
    if not isinstance(props, dict):
        return "missing_properties", []
    param = props.get("parameter")
    if not isinstance(param, dict):
        return "missing_parameter", []
    series = [param.get(s) for s in SERIES]
    if not all(isinstance(s, dict) for s in series):
        return "missing_series", []
    fill = None
    header = obj.get("header")
    if isinstance(header, dict) and "fill_value" in header:
        try:
            fill = _double(header["fill_value"])
        except ValueError:
            fill = None
    rows = []
    for d in sorted(series[0], reverse=True):
        vals = [s.get(d) for s in series]
        if any(v is None for v in vals):
            continue
        try:
            nums = [_double(v) for v in vals]
        except ValueError:
            continue
        rows.append((d, tuple("nan" if fill is not None and _bits(x) == _bits(fill) else x for x in nums)))
    return None, rows


def _obj(pairs):
    """JSON object text from (key, value) pairs; repeated keys are kept in the text."""
    if pairs == "__array__":
        return "[1]"
    return "{" + ",".join(f"{json.dumps(k)}:{json.dumps(v)}" for k, v in pairs) + "}"


def _climate_text(series, header, drop):
    param = ",".join(f"{json.dumps(k)}:{_obj(v)}" for k, v in zip(SERIES, series) if k not in drop)
    head = f'"header":{json.dumps(header)},' if header != "absent" else ""
    return "{" + head + '"properties":{"parameter":{' + param + "}}}"


def _load(text):
    """The JSON model: an object keeps the last value of a repeated key at its first position."""
    return json.loads(text, object_pairs_hook=dict)


climate_docs = st.builds(
    _climate_text,
    st.lists(st.one_of(st.lists(st.tuples(DATES, VALUES), max_size=6), st.just("__array__")), min_size=4,
             max_size=4),
    st.sampled_from(["absent", {"fill_value": -999.0}, {"fill_value": 0.0}, {"fill_value": "abc"}, 7]),
    st.sets(st.sampled_from(SERIES), max_size=1),
)


def _spark_rows(st_df):
    out = {}
    for r in st_df.collect():
        days = [d for d in (r["days"] or []) if d["complete"] and not d["bad"]]
        vals = lambda d: tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in
                               (d["precipitation"], d["root_zone_soil_wetness"], d["temperature_max"],
                                d["temperature_min"]))
        out[r["doc_seq"]] = (r["fault"], [(d["date"], vals(d)) for d in days])
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(climate_docs, min_size=20, max_size=40))
def test_climate_matches_model(spark, docs):
    df = spark.createDataFrame([(f"P{i}", i, 200, d) for i, d in enumerate(docs)],
                               "producer_id string, doc_seq bigint, http_status int, raw string")
    got = _spark_rows(cl.stage_climate(df))
    for i, d in enumerate(docs):
        assert got[i] == climate_model(d), d


FIELDS = ["1. open", "2. high", "3. low", "4. close", "5. adjusted close", "6. volume", "7. dividend amount"]
WEEKS = st.sampled_from(["2024-01-05", "2024-01-12", "2024-01-19", "2024-1-26", "2024-02-30", "2024-03-01"])
FIELD_VALUES = st.sampled_from(["5.5", "100", "12.0", "x", 7, None])


def market_model(raw, n):
    obj = _load(raw)
    if "Error Message" in obj:
        return "provider_error", []
    if "Note" in obj:
        return "provider_note", []
    series = obj.get("Weekly Adjusted Time Series")
    if not isinstance(series, dict):
        return "missing_series", []
    rows = []
    for week, v in list(series.items())[:max(n, 0)]:
        try:
            if not isinstance(v, dict) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", week):
                raise ValueError
            y, m, d = map(int, week.split("-"))
            import datetime
            datetime.date(y, m, d)
            nums = []
            for f in FIELDS:
                x = v.get(f)
                if f == "6. volume":
                    if not (isinstance(x, str) and re.fullmatch(r"[-+]?\d+", x)) and not (
                            isinstance(x, int) and not isinstance(x, bool)):
                        raise ValueError
                    nums.append(int(x))
                else:
                    nums.append(_double(x))
        except (ValueError, TypeError):
            return "bad_entry", []
        rows.append((week, tuple(nums)))
    return None, rows


entries = st.one_of(st.fixed_dictionaries({f: FIELD_VALUES if f in ("1. open", "6. volume") else st.just("1.0")
                                           for f in FIELDS}),
                    st.just("not an object"))
market_docs = st.builds(
    lambda series, top: json.dumps(top)[:-1] + ("," if top else "") + '"Weekly Adjusted Time Series":'
    + _obj(series) + "}",
    st.lists(st.tuples(WEEKS, entries), max_size=6),
    st.sampled_from([{}, {}, {}, {"Note": "n"}, {"Error Message": None}]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(st.lists(market_docs, min_size=20, max_size=40), st.integers(min_value=0, max_value=4))
def test_market_matches_model(spark, docs, n):
    df = spark.createDataFrame([(f"S{i}", i, 200, d) for i, d in enumerate(docs)],
                               "symbol string, doc_seq bigint, http_status int, raw string")
    got = {}
    for r in mk.stage_market(df, n).collect():
        rows = [(x["week"], (x["open"], x["high"], x["low"], x["close"], x["adjusted_close"], x["volume"],
                             x["dividend_amount"])) for x in (r["rows"] or [])]
        got[r["doc_seq"]] = (r["fault"], rows)
    for i, d in enumerate(docs):
        assert got[i] == market_model(d, n), d


def test_long_misaligned_series_is_fast_and_exact(spark):
    import time
    dates = [f"{2000 + i // 365:04d}{i % 365:04d}" for i in range(4000)]
    p = {d: float(i) for i, d in enumerate(dates)}
    g = {d: 1.0 for d in reversed(dates)}          # same dates, other order
    x = {d: 2.0 for d in dates[1:]}                 # one date missing
    n = {d: 3.0 for d in dates}
    raw = json.dumps({"properties": {"parameter": {"PRECTOTCORR": p, "GWETROOT": g, "T2M_MAX": x, "T2M_MIN": n}}})
    df = spark.createDataFrame([("P", 0, 200, raw)], "producer_id string, doc_seq bigint, http_status int, raw string")
    t0 = time.time()
    got = _spark_rows(cl.stage_climate(df))[0]
    assert time.time() - t0 < 60
    assert got == climate_model(raw) and len(got[1]) == 3999
