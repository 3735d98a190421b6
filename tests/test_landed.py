"""Files that cannot be read, cycles with requested keys, the cycle log, archived files and delays."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from cropwire.operators.keyed_sink import read_table
from cropwire.plans.cycles import run_climate_cycle, run_market_cycle
from cropwire.session import scratch_path
from cropwire.sources import producer_dimension, producer_ids, scan_landed
from cropwire.streaming import close_cycle, repeat_runs, stream_climate, stream_market

DOCS = "producer_id string, doc_seq bigint, http_status int, raw string"


def climate_doc(v):
    s = {"20240101": v, "20240102": v}
    return json.dumps({"properties": {"parameter": {k: s for k in ("PRECTOTCORR", "GWETROOT", "T2M_MAX", "T2M_MIN")}}})


def week(v="1"):
    return json.dumps({"Weekly Adjusted Time Series": {"2024-03-01": {
        f: v for f in ("1. open", "2. high", "3. low", "4. close", "5. adjusted close", "6. volume", "7. dividend amount")}}})


def one_file(spark, rows, folder, name, schema=DOCS, filler=0):
    """Write rows as one Parquet file with a name of our own."""
    tmp = scratch_path(spark, "one")
    spark.createDataFrame(rows, schema).coalesce(1).write.option("parquet.block.row.count.limit", filler or 1 << 20).parquet(tmp)
    os.makedirs(folder, exist_ok=True)
    part = next(f for f in os.listdir(tmp) if f.endswith(".parquet"))
    target = os.path.join(folder, name)
    with open(os.path.join(tmp, part), "rb") as f, open(target, "wb") as out:
        out.write(f.read())
    return target


@pytest.fixture
def landing(spark):
    """Good files, a truncated one, one with a broken middle, an empty one and an empty table."""
    folder = scratch_path(spark, "l-land")
    one_file(spark, [("WHEAT_1", 1, 200, climate_doc(1.0))], folder, "good.parquet")
    cut = one_file(spark, [("CORN_1", 2, 200, climate_doc(2.0))], folder, "cut [1].parquet")
    with open(cut, "rb+") as f:
        f.truncate(os.path.getsize(cut) - 20)
    broken = one_file(spark, [("COFFEE_1", 3, 200, climate_doc(3.0) + " " * i) for i in range(200)], folder, "broken.parquet")
    with open(broken, "rb+") as f:
        f.seek(4)
        f.write(b"\xff" * 400)
    one_file(spark, [], folder, "none.parquet")
    open(os.path.join(folder, "zero.parquet"), "w").close()
    one_file(spark, [("CORN_2", 4, 200, climate_doc(4.0)), ("NOPE", 5, 200, climate_doc(4.0))], folder, "more.parquet")
    return folder


def quarantined(spark, path):
    return sorted((os.path.basename(r.key).replace("%5B", "[").replace("%5D", "]").replace("%20", " "), r.reason) for r in spark.read.parquet(path).collect())


BAD = [("NOPE", "unknown_producer"), ("broken.parquet", "unreadable_file"), ("cut [1].parquet", "unreadable_file")]


def test_unreadable_parquet_files_cost_only_themselves(spark, landing):
    table, q = scratch_path(spark, "l-t"), scratch_path(spark, "l-q")
    run = run_climate_cycle(scan_landed(spark, landing, "producer_id"), producer_dimension(spark), table, q)
    assert {r.producer_id for r in read_table(spark, table).collect()} == {"WHEAT_1", "CORN_2"}
    assert quarantined(spark, q) == BAD and run.quarantined == 3


def test_unreadable_files_in_a_stream(spark, landing):
    table, q, ckpt, log = (scratch_path(spark, f"l-{n}") for n in ("st", "sq", "sc", "slog"))
    for _ in range(2):  # the second run finds nothing new
        stream_climate(spark, landing, producer_dimension(spark), table, ckpt, q, log_path=log)
    assert {r.producer_id for r in read_table(spark, table).collect()} == {"WHEAT_1", "CORN_2"}
    assert quarantined(spark, q) == BAD
    assert [(r.files, r.documents, r.rows, r.offered, r.inserted, r.quarantined) for r in spark.read.parquet(log).collect()] == [(5, 3, 4, 4, 4, 3)]  # the file without a byte is no file of a batch


def test_unreadable_json_lines(spark):
    folder, topic, q, rep = (scratch_path(spark, f"j-{n}") for n in ("land", "topic", "q", "rep"))
    os.makedirs(folder)
    line = lambda s: json.dumps({"symbol": s, "doc_seq": 1, "http_status": 200, "raw": week()})
    for name, text in (("good.json", line("A") + "\n" + line("B") + "\n"), ("half.json", line("C") + "\n" + line("D")[:40]), ("bad.json", "no json\n[1,\n"), ("empty.json", "")):
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    packed = gzip.compress((line("E") + "\n").encode() * 3)
    with open(os.path.join(folder, "cut.json.gz"), "wb") as f:
        f.write(packed[:len(packed) // 2])
    run = run_market_cycle(scan_landed(spark, folder, "symbol", "json"), topic, quarantine_path=q, report_path=rep)
    assert {r.key for r in spark.read.parquet(topic).collect()} == {"A", "B", "C"}
    got = quarantined(spark, q)
    assert ("half.json", "unreadable_line") in got and got.count(("bad.json", "unreadable_line")) == 2 and ("bad.json", "unreadable_file") in got
    assert ("cut.json.gz", "unreadable_file") in got and {k for k, _ in got} == {"half.json", "bad.json", "cut.json.gz"}
    assert sorted(r.symbol for r in spark.read.parquet(rep).collect()) == ["A", "B", "C"] and (run.documents, run.rows) == (3, 3)


def test_requested_and_landed_in_a_stream(spark):
    landing, table, ckpt, q, rep, log = (scratch_path(spark, f"r-{n}") for n in ("land", "t", "c", "q", "rep", "log"))
    dim = producer_dimension(spark)
    asked = producer_ids(dim)
    run = lambda: stream_climate(spark, landing, dim, table, ckpt, q, requested=asked, report_path=rep, log_path=log, max_files=1)
    one_file(spark, [("WHEAT_1", 1, 200, climate_doc(1.0))], landing, "a.parquet")
    one_file(spark, [("CORN_1", 2, 200, climate_doc(1.0)), ("NOPE", 3, 200, climate_doc(1.0))], landing, "b.parquet")
    run()  # two micro-batches, one cycle
    one_file(spark, [("CORN_1", 4, 200, climate_doc(2.0)), ("CORN_2", 5, 200, "{")], landing, "c.parquet")
    run()
    run()  # nothing landed: every requested key is missing
    rows = spark.read.parquet(q).filter("reason = 'no_document'").groupBy("batch_id").agg(F.collect_set("key").alias("k")).collect()
    gone = {r.batch_id: set(r.k) for r in rows}
    every = {r.producer_id for r in asked.collect()}
    assert gone == {"cycle-1": every - {"WHEAT_1", "CORN_1"}, "cycle-2": every - {"CORN_1", "CORN_2"}, "cycle-3": every}
    assert spark.read.parquet(f"{rep}/_cycles").count() == 3
    report = spark.read.parquet(rep)
    told = {r.batch_id: (r.d, r.n) for r in report.filter("doc_seq IS NOT NULL").groupBy("batch_id").agg(F.count("*").alias("d"), F.sum("rows").alias("n")).collect()}
    assert {str(r.epoch): (r.documents, r.rows) for r in spark.read.parquet(log).collect()} == told
    assert {str(r.epoch): (r.offered, r.inserted) for r in spark.read.parquet(log).collect()} == {"0": (2, 2), "1": (2, 2), "2": (2, 0)}
    with pytest.raises(ValueError, match="report_path"):
        stream_climate(spark, landing, dim, table, ckpt, requested=asked)


def test_a_close_that_broke_off_is_done_again(spark):
    rep, q = scratch_path(spark, "x-rep"), scratch_path(spark, "x-q")
    asked = spark.createDataFrame([("A",), ("B",), ("B",)], "symbol string")
    spark.createDataFrame([("A", 1, 5)], "symbol string, doc_seq bigint, published bigint").write.parquet(f"{rep}/batch_id=0")
    spark.createDataFrame([("A", None, 0)], "symbol string, doc_seq bigint, published bigint").write.parquet(f"{rep}/batch_id=cycle-1")  # half a close
    assert close_cycle(spark, asked, rep, "market", "symbol", "published", q) == 1
    assert [r.symbol for r in spark.read.parquet(f"{rep}/batch_id=cycle-1").collect()] == ["B"]
    assert close_cycle(spark, asked, rep, "market", "symbol", "published", q) == 2


def test_archived_files_are_not_read_again_and_runs_keep_their_distance(spark):
    landing, topic, ckpt, archive, log = (scratch_path(spark, f"a-{n}") for n in ("land", "topic", "c", "arch", "log"))
    schema = DOCS.replace("producer_id", "symbol")
    events, names = [], iter("abc")

    def run():
        events.append("run")
        one_file(spark, [("WEAT", 1, 200, week())], landing, f"{next(names)}.parquet", schema)
        stream_market(spark, landing, topic, ckpt, archive=archive, log_path=log, ts="t")
        events.append("end")

    repeat_runs(run, 30.0, runs=3, sleep=lambda s: events.append(s))
    assert events == ["run", "end", 30.0, "run", "end", 30.0, "run", "end"]  # the delay starts at the end, however slow the run
    assert spark.read.parquet(topic).count() == 3 and spark.read.parquet(log).count() == 3
    moved = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".parquet")]
    assert "a.parquet" in moved and "a.parquet" not in os.listdir(landing)
