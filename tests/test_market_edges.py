"""Hand-written market documents and their expected verdicts."""

import json

import pytest

from cropwire.operators import market as mk


def entry(v="5.0", vol="100"):
    return {"1. open": v, "2. high": v, "3. low": v, "4. close": v, "5. adjusted close": v,
            "6. volume": vol, "7. dividend amount": "0.0000"}


def series(*weeks, bad=None):
    s = {}
    for w in weeks:
        s[w] = bad if bad and w == bad[0] else entry()
    return s


def stage(spark, raws, n=10):
    rows = [(f"S{i}", i, 200, r) for i, r in enumerate(raws)]
    docs = spark.createDataFrame(rows, "symbol string, doc_seq bigint, http_status int, raw string")
    return mk.stage_market(docs, n)


def verdicts(spark, raws, n=10):
    return [(r["fault"], r["detail"]) for r in stage(spark, raws, n).orderBy("doc_seq").collect()]


def weeks(spark, raw, n=10):
    obs = mk.market_observations(stage(spark, [raw], n))
    return [r["week"] for r in obs.orderBy("pos").collect()]


def doc(s, **top):
    return json.dumps({**top, "Weekly Adjusted Time Series": s})


@pytest.mark.parametrize("raw", ["not json", "[1]", '"x"', ""])
def test_unparsable(spark, raw):
    assert verdicts(spark, [raw])[0][0] == "unparsable"


def test_error_and_note_win_over_series(spark):
    good = series("2024-01-05")
    got = verdicts(spark, [doc(good, Note="slow down"), '{"Error Message": null}',
                           doc(good, **{"Error Message": "bad"}), '{"Information": "x"}'])
    assert got == [("provider_note", "slow down"), ("provider_error", None), ("provider_error", "bad"),
                   ("missing_series", None)]


def test_first_n_in_document_order(spark):
    raw = doc(series("2024-01-05", "2024-01-12", "2024-01-19"))
    assert weeks(spark, raw, 1) == ["2024-01-05"]
    assert weeks(spark, raw, 0) == []
    assert weeks(spark, raw, -3) == []


def test_bad_entry_within_n_aborts_beyond_n_passes(spark):
    s = {"2024-01-05": entry(), "2024-01-12": entry(), "2024-01-19": entry("x")}
    assert verdicts(spark, [doc(s)], 3)[0][0] == "bad_entry"
    assert verdicts(spark, [doc(s)], 2)[0][0] is None
    s2 = {"2024-01-05": entry(), "2024-01-12": "not an object"}
    assert verdicts(spark, [doc(s2)], 1)[0][0] is None
    assert weeks(spark, doc(s2), 1) == ["2024-01-05"]
    assert verdicts(spark, [doc(s2)], 2)[0][0] == "bad_entry"


@pytest.mark.parametrize("key", ["2024-1-5", "2024", "2024-02-30"])
def test_strict_dates(spark, key):
    assert verdicts(spark, [doc({key: entry()})])[0][0] == "bad_entry"


def test_volume_must_be_integer_text(spark):
    assert verdicts(spark, [doc({"2024-01-05": entry(vol="12.0")})])[0][0] == "bad_entry"


def test_missing_field_aborts(spark):
    e = entry()
    del e["7. dividend amount"]
    assert verdicts(spark, [doc({"2024-01-05": e})])[0][0] == "bad_entry"


def test_repeated_date_last_value_first_position(spark):
    raw = ('{"Weekly Adjusted Time Series": {"2024-01-05": {"1. open": "1"}, "2024-01-12": '
           + json.dumps(entry("2")) + ', "2024-01-05": ' + json.dumps(entry("3")) + '}}')
    obs = mk.market_observations(stage(spark, [raw], 10)).orderBy("pos").collect()
    assert [(r["week"], r["open"]) for r in obs] == [("2024-01-05", 3.0), ("2024-01-12", 2.0)]


def test_non_finite_stops_publishing_from_that_event(spark):
    s = {"2024-01-05": entry(), "2024-01-12": entry("NaN"), "2024-01-19": entry()}
    st = stage(spark, [doc(s)]).collect()[0]
    assert st["fault"] is None and st["publish_fault"] == "non_finite"
    assert len(st["rows"]) == 3 and [r["week"] for r in st["publishable"]] == ["2024-01-05"]


def test_price_instant_is_utc_midnight(spark):
    from pyspark.sql import functions as F
    obs = mk.market_observations(stage(spark, [doc(series("2024-03-01"))]))
    assert obs.select(F.unix_seconds("price_timestamp")).first()[0] == 1709251200
