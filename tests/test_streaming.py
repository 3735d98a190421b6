"""Repeated cycles over a landing folder with availableNow runs."""

import json

from pyspark.sql import functions as F

from cropwire.operators.keyed_sink import read_table
from cropwire.session import scratch_path
from cropwire.sources import producer_dimension
from cropwire.streaming import stream_climate, stream_keyed, stream_market

DOCS = "producer_id string, doc_seq bigint, http_status int, raw string"


def climate_doc(v):
    s = {"20240101": v, "20240102": v}
    return json.dumps({"header": {"fill_value": -999.0},
                       "properties": {"parameter": {"PRECTOTCORR": s, "GWETROOT": s, "T2M_MAX": s, "T2M_MIN": s}}})


def test_climate_stream_first_writer_wins(spark):
    landing, table, ckpt = (scratch_path(spark, n) for n in ("s-land", "s-table", "s-ckpt"))
    dim = producer_dimension(spark)
    spark.createDataFrame([("WHEAT_1", 1, 200, climate_doc(1.0)), ("NOPE", 2, 200, climate_doc(1.0))], DOCS) \
        .write.mode("append").parquet(landing)
    stream_climate(spark, landing, dim, table, ckpt)
    assert read_table(spark, table).count() == 2
    stream_climate(spark, landing, dim, table, ckpt)  # nothing new landed: no change
    assert read_table(spark, table).count() == 2
    spark.createDataFrame([("WHEAT_1", 3, 200, climate_doc(5.0)), ("CORN_1", 4, 200, climate_doc(2.0))], DOCS) \
        .write.mode("append").parquet(landing)
    stream_climate(spark, landing, dim, table, ckpt)
    rows = read_table(spark, table).filter(F.col("producer_id") == "WHEAT_1").collect()
    assert {r.precipitation for r in rows} == {1.0}  # later correction ignored
    assert read_table(spark, table).count() == 4
    assert sorted(r.id for r in read_table(spark, table).collect()) == [1, 2, 3, 4]


def test_market_stream_publishes_every_cycle(spark):
    landing, topic, ckpt, table = (scratch_path(spark, n) for n in ("m-land", "m-topic", "m-ckpt", "m-table"))
    raw = json.dumps({"Weekly Adjusted Time Series": {"2024-03-01": {
        "1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. adjusted close": "1.5",
        "6. volume": "10", "7. dividend amount": "0"}}})
    schema = "symbol string, doc_seq bigint, http_status int, raw string"
    for cycle in range(2):
        spark.createDataFrame([("WEAT", cycle, 200, raw)], schema).write.mode("append").parquet(landing)
        stream_market(spark, landing, topic, ckpt, table=table, ts=f"t{cycle}")
    assert spark.read.parquet(topic).count() == 2  # re-emitted each cycle
    assert read_table(spark, table).count() == 1   # stored once


def test_keyed_stream_two_cycles(spark):
    landing, table, ckpt = (scratch_path(spark, n) for n in ("k-land", "k-table", "k-ckpt"))
    schema = "k string, v double, cycle int"
    kw = dict(keys=["k"], arrival=["cycle"], columns=["k", "v", "cycle"], captured_at="c")
    spark.createDataFrame([("a", 1.0, 0)], schema).write.mode("append").parquet(landing)
    stream_keyed(spark, landing, schema, table, ckpt, **kw)
    spark.createDataFrame([("a", 2.0, 1), ("b", 3.0, 1)], schema).write.mode("append").parquet(landing)
    stream_keyed(spark, landing, schema, table, ckpt, **kw)
    assert {(r.k, r.v, r.cycle) for r in read_table(spark, table).collect()} == {("a", 1.0, 0), ("b", 3.0, 1)}


def test_climate_stream_over_whole_text_files(spark):
    import os
    landing, table, ckpt = (scratch_path(spark, n) for n in ("w-land", "w-table", "w-ckpt"))
    os.makedirs(landing)
    with open(os.path.join(landing, "WHEAT_1.json"), "w") as f:
        f.write(climate_doc(1.0))
    stream_climate(spark, landing, producer_dimension(spark), table, ckpt, fmt="wholetext")
    with open(os.path.join(landing, "CORN_1.json"), "w") as f:
        f.write(climate_doc(2.0))
    stream_climate(spark, landing, producer_dimension(spark), table, ckpt, fmt="wholetext")
    got = {(r.producer_id, r.precipitation) for r in read_table(spark, table).collect()}
    assert got == {("WHEAT_1", 1.0), ("CORN_1", 2.0)}
