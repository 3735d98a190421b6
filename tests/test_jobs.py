"""Job entry points, run in-process."""

import json

from cropwire import jobs
from cropwire.operators.keyed_sink import read_table
from cropwire.session import scratch_path


def test_climate_and_market_jobs(spark):
    land_c, land_m, table, q, topic, out = (scratch_path(spark, n) for n in
                                           ("j-lc", "j-lm", "j-t", "j-q", "j-topic", "j-out"))
    s = {"20240101": 1.0}
    raw = json.dumps({"properties": {"parameter": {k: s for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})
    spark.createDataFrame([("WHEAT_1", 1, 200, raw), ("X", 2, 200, raw)],
                          "producer_id string, doc_seq bigint, http_status int, raw string").write.parquet(land_c)
    jobs.main(["climate", "--landing", land_c, "--table", table, "--quarantine", q])
    assert read_table(spark, table).count() == 1
    assert [r.reason for r in spark.read.parquet(q).collect()] == ["unknown_producer"]
    m = json.dumps({"Weekly Adjusted Time Series": {"2024-03-01": {
        "1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. adjusted close": "1",
        "6. volume": "1", "7. dividend amount": "0"}}})
    spark.createDataFrame([("WEAT", 1, 200, m)], "symbol string, doc_seq bigint, http_status int, raw string") \
        .write.parquet(land_m)
    jobs.main(["market", "--landing", land_m, "--topic-path", topic])
    assert spark.read.parquet(topic).count() == 1
    jobs.main(["manifest", "--out", out, "--symbols", "WEAT,CORN", "--as-of", "2024-03-01"])
    assert spark.read.json(f"{out}/climate").count() == 25
    assert spark.read.json(f"{out}/market").count() == 2


def test_cycle_counts_come_from_observed_writes(spark):
    from cropwire.plans.cycles import run_market_cycle
    topic, q, rep = (scratch_path(spark, n) for n in ("o-topic", "o-q", "o-rep"))
    good = json.dumps({"Weekly Adjusted Time Series": {w: {
        "1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. adjusted close": "1",
        "6. volume": "1", "7. dividend amount": "0"} for w in ("2024-03-01", "2024-02-23")}})
    docs = spark.createDataFrame([("A", 1, 200, good), ("B", 2, 503, good), ("C", 3, 200, '{"Note": "x"}')],
                                 "symbol string, doc_seq bigint, http_status int, raw string")
    run = run_market_cycle(docs, topic, quarantine_path=q, report_path=rep, ts="t")
    assert (run.published, run.quarantined) == (2, 2)
    assert {(r.symbol, r.published) for r in spark.read.parquet(rep).collect()} == {("A", 2), ("B", 0), ("C", 0)}


def test_partitioned_climate_table_cycle(spark):
    from cropwire.plans.cycles import run_climate_cycle
    from cropwire.sources import producer_dimension
    table = scratch_path(spark, "p-climate")
    raw = lambda v: json.dumps({"properties": {"parameter": {
        k: {"20240101": v, "20240102": v} for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})
    schema = "producer_id string, doc_seq bigint, http_status int, raw string"
    dim = producer_dimension(spark)
    run_climate_cycle(spark.createDataFrame([("WHEAT_1", 1, 200, raw(1.0)), ("CORN_1", 2, 200, raw(2.0))], schema),
                      dim, table, partition_by=("commodity_type",), captured_at="c1")
    run_climate_cycle(spark.createDataFrame([("WHEAT_1", 3, 200, raw(9.0)), ("COFFEE_1", 4, 200, raw(3.0))], schema),
                      dim, table, partition_by=("commodity_type",), captured_at="c2")
    rows = read_table(spark, table).collect()
    got = {(r.producer_id, r.date): (r.id, r.precipitation, r.commodity_type) for r in rows}
    assert got[("WHEAT_1", "20240102")][1:] == (1.0, "WHEAT")
    assert sorted(r.id for r in rows) == [1, 2, 3, 4, 5, 6]
    assert {r.commodity_type for r in rows} == {"WHEAT", "CORN", "COFFEE"}


def test_stream_job_reports_missing_symbols_and_logs(spark):
    land, topic, ckpt, q, rep, log, archive = (scratch_path(spark, f"js-{n}") for n in ("land", "topic", "c", "q", "rep", "log", "arch"))
    m = json.dumps({"Weekly Adjusted Time Series": {"2024-03-01": {
        "1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. adjusted close": "1", "6. volume": "1", "7. dividend amount": "0"}}})
    spark.createDataFrame([("WEAT", 1, 200, m)], "symbol string, doc_seq bigint, http_status int, raw string").write.parquet(land)
    jobs.main(["market", "--landing", land, "--topic-path", topic, "--stream", "--checkpoint", ckpt, "--symbols", "WEAT,CORN", "--quarantine", q,
               "--report", rep, "--log", log, "--archive", archive])
    assert [(r.key, r.reason, r.batch_id) for r in spark.read.parquet(q).collect()] == [("CORN", "no_document", "cycle-1")]
    assert {(r.symbol, r.published) for r in spark.read.parquet(rep).collect()} == {("WEAT", 1), ("CORN", 0)}
    assert [(r.documents, r.published) for r in spark.read.parquet(log).collect()] == [(1, 1)]
