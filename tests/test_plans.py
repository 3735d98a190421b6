"""Physical-plan properties that matter at scale (guards against regressions)."""

import contextlib
import io

from cropwire import fixtures as fx
from cropwire.operators.keyed_sink import _not_stored, first_writer, insert_or_ignore
from cropwire.plans.cycles import climate_cycle, market_cycle
from cropwire.session import scratch_path
from cropwire.sources import lookup_producers, producer_dimension, producers_exist, unknown_producers

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_builtin_dimension_is_broadcast(spark):
    docs = spark.createDataFrame([("CORN_1",)], "producer_id string")
    p = plan(lookup_producers(docs, producer_dimension(spark)))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_stored_table_is_probed_not_shuffled(spark):
    t = scratch_path(spark, "plan-sink")
    b = fx.fx_store_batches(spark, SF)
    kw = dict(keys=fx.STORE_KEYS, arrival=fx.STORE_ARRIVAL, columns=fx.STORE_COLUMNS, captured_at="x")
    insert_or_ignore(b.filter("cycle = 0"), t, **kw)
    cand = first_writer(b.filter("cycle = 1").select(*fx.STORE_COLUMNS, "l_partkey", "l_suppkey", "l_shipdate"),
                        fx.STORE_KEYS, fx.STORE_ARRIVAL)
    stored = spark.read.parquet(t)
    p = _formatted(_not_stored(spark, cand, t, stored.schema, fx.STORE_KEYS, {"l_orderkey": (5, 500), "l_linenumber": (1, 7)}))
    assert "BroadcastHashJoin LeftSemi" in p and "BroadcastHashJoin LeftAnti" in p
    assert "SortMergeJoin" not in p
    assert any("LessThanOrEqual(l_linenumber,7)" in line for line in p.splitlines() if line.startswith("PushedFilters"))
    # the stored side is scanned for its key columns only, with the batch's
    # leading-key values pushed into the scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in p
    assert any(line.startswith("PushedFilters") and "l_orderkey" in line and "GreaterThanOrEqual(l_orderkey,5)" in line
               for line in p.splitlines())


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fixture_scan_prunes_columns(spark):
    p = _formatted(fx.fx_market_docs(spark, SF))
    line = [x for x in p.splitlines() if x.startswith("ReadSchema") and "l_orderkey" in x][0]
    assert "l_tax" not in line and "l_returnflag" not in line


def test_cycles_parse_each_document_once(spark):
    dim = producer_dimension(spark, fx.fx_producers(spark, SF))
    c = climate_cycle(fx.fx_climate_docs(spark, SF), dim)
    assert plan(c.observations).count("from_json") == 1
    m = market_cycle(fx.fx_market_docs(spark, SF), 10, "t")
    # the typed parse, plus the lazily evaluated text readings of the series
    # (entries that are no objects, volumes that are no whole numbers)
    assert plan(m.events).count("from_json(") <= 5
    # the quarantine stages the documents once as well
    assert plan(c.quarantine).count("from_json") == 1
    assert plan(m.quarantine).count("from_json(") == plan(m.events).count("from_json(")


def test_lookups_gather_nothing_into_one_task(spark):
    dim, docs = producer_dimension(spark, fx.fx_producers(spark, SF)), fx.fx_climate_docs(spark, SF).select("producer_id")
    for op in (lookup_producers, producers_exist, unknown_producers):
        assert "SinglePartition" not in plan(op(docs, dim))


def test_first_writer_combines_map_side(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "k string, seq int, v double")
    p = _formatted(first_writer(df, ["k"], ["seq"]))
    # partial aggregate before the exchange, final after it
    assert p.count("Aggregate") >= 2 and "Exchange" in p and "Window" not in p
