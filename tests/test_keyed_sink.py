"""First-writer-wins tables: within and across batches, replay, ids, NULL keys, NaN."""

import math

import pytest
from pyspark.sql import functions as F

from cropwire.operators import keyed_sink
from cropwire.operators.keyed_sink import first_writer, insert_or_ignore, read_table, sequence_ids
from cropwire.session import scratch_path

SCHEMA = "k string, d string, v double, seq int"
KW = dict(keys=["k", "d"], arrival=["seq"], columns=["k", "d", "v"])


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, t):
    return {(r.k, r.d): (r.id, r.v, r.captured_at) for r in read_table(spark, t).collect()}


def test_first_writer_wins_within_and_across_batches(spark):
    t = scratch_path(spark, "t-sink")
    r1 = insert_or_ignore(batch(spark, [("a", "1", 1.0, 2), ("a", "1", 9.0, 1), ("b", "1", 2.0, 3)]), t,
                          captured_at="c1", **KW)
    assert (r1.offered, r1.inserted) == (2, 2)
    r2 = insert_or_ignore(batch(spark, [("a", "1", 5.0, 0), ("c", "1", 3.0, 0)]), t, captured_at="c2", **KW)
    assert (r2.offered, r2.inserted) == (2, 1)
    got = stored(spark, t)
    assert got == {("a", "1"): (1, 9.0, "c1"), ("b", "1"): (2, 2.0, "c1"), ("c", "1"): (3, 3.0, "c2")}


def test_replay_and_empty_batch_are_noops(spark):
    t = scratch_path(spark, "t-replay")
    b = batch(spark, [("a", "1", 1.0, 1)])
    insert_or_ignore(b, t, captured_at="c", **KW)
    assert insert_or_ignore(b, t, captured_at="c", **KW).inserted == 0
    assert insert_or_ignore(b.limit(0), t, captured_at="c", **KW).offered == 0
    assert read_table(spark, t).count() == 1


def test_null_keys_rejected_and_nan_stored_as_null(spark):
    t = scratch_path(spark, "t-null")
    res = insert_or_ignore(batch(spark, [(None, "1", 1.0, 1), ("a", "1", float("nan"), 2)]), t,
                           captured_at="c", **KW)
    assert res.rejected.count() == 1 and res.rejected.first()["null_columns"] == "k"
    assert stored(spark, t)[("a", "1")][1] is None


def test_first_seen_fill_sticks(spark):
    t = scratch_path(spark, "t-fill")
    insert_or_ignore(batch(spark, [("a", "1", float("nan"), 1)]), t, captured_at="c", **KW)
    insert_or_ignore(batch(spark, [("a", "1", 4.0, 1)]), t, captured_at="c", **KW)
    assert stored(spark, t)[("a", "1")][1] is None


def test_partitioned_table_prunes_and_keeps_semantics(spark):
    t = scratch_path(spark, "t-part")
    kw = dict(keys=["k", "d"], arrival=["seq"], columns=["k", "d", "v"], partition_by=("k",))
    insert_or_ignore(batch(spark, [("a", "1", 1.0, 1), ("b", "1", 2.0, 2)]), t, captured_at="c", **kw)
    insert_or_ignore(batch(spark, [("a", "1", 7.0, 1), ("a", "2", 3.0, 2)]), t, captured_at="c", **kw)
    got = stored(spark, t)
    assert got[("a", "1")][1] == 1.0 and got[("a", "2")][:2] == (3, 3.0)


def test_sequence_ids_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("x")).repartition(5)
    out, n = sequence_ids(df, ["x"], 10)
    out = out.collect()
    assert n == 1000
    assert sorted((r.id, r.x) for r in out) == [(i + 11, i) for i in range(1000)]


def test_shuffled_join_gives_the_same(spark):
    t = scratch_path(spark, "t-big")
    rows = [("k%d" % i, "1", float(i), i) for i in range(50)]
    insert_or_ignore(batch(spark, rows[:30]), t, captured_at="c", **KW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = insert_or_ignore(batch(spark, rows), t, captured_at="c", **KW)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert res.inserted == 20
    ids = sorted(r.id for r in read_table(spark, t).collect())
    assert ids == list(range(1, 51)) and not any(math.isnan(r.v) for r in read_table(spark, t).collect())


def test_high_water_mark_survives_a_lost_marker(spark):
    from cropwire.operators.keyed_sink import high_water_mark
    t = scratch_path(spark, "t-hwm")
    insert_or_ignore(batch(spark, [("a", "1", 1.0, 1), ("b", "1", 2.0, 2)]), t, captured_at="c", **KW)
    schema = read_table(spark, t).schema
    assert high_water_mark(spark, t, schema) == 2
    # an append whose marker never got written (crash between data and marker)
    spark.createDataFrame([(7, "x", "1", 0.0, "c")], schema).write.mode("append").parquet(t)
    assert high_water_mark(spark, t, schema) == 7
    insert_or_ignore(batch(spark, [("c", "1", 3.0, 1)]), t, captured_at="c", **KW)
    assert stored(spark, t)[("c", "1")][0] == 8
    assert high_water_mark(spark, t, schema) == 8


def test_partitioned_batch_then_stream_keeps_every_row(spark):
    from cropwire.streaming import stream_keyed
    t, landing, ckpt = (scratch_path(spark, n) for n in ("t-mixed", "t-mixed-land", "t-mixed-ckpt"))
    kw = dict(keys=["k", "d"], arrival=["seq"], columns=["k", "d", "v"], captured_at="c")
    insert_or_ignore(batch(spark, [("007", "1", 1.0, 1)]), t, partition_by=("k",), **kw)
    batch(spark, [("007", "1", 9.0, 1), ("008", "1", 2.0, 2)]).write.parquet(landing)
    stream_keyed(spark, landing, SCHEMA, t, ckpt, **kw)  # does not name the layout: the table's own holds
    assert stored(spark, t) == {("007", "1"): (1, 1.0, "c"), ("008", "1"): (2, 2.0, "c")}  # text keys stay text
    insert_or_ignore(batch(spark, [("008", "1", 5.0, 1), ("009", "1", 3.0, 2)]), t, partition_by=("k",), **kw)
    assert sorted(r.id for r in read_table(spark, t).collect()) == [1, 2, 3]


def test_another_partitioning_is_refused(spark):
    t = scratch_path(spark, "t-layout")
    insert_or_ignore(batch(spark, [("a", "1", 1.0, 1)]), t, captured_at="c", partition_by=("k",), **KW)
    with pytest.raises(ValueError, match="partitioned by"):
        insert_or_ignore(batch(spark, [("b", "1", 1.0, 1)]), t, captured_at="c", partition_by=("d",), **KW)


def test_many_partition_values(spark):
    t = scratch_path(spark, "t-many")
    rows = spark.range(2000).selectExpr("concat('p', id) AS k", "'1' AS d", "CAST(id AS DOUBLE) AS v", "CAST(id AS INT) AS seq")
    kw = dict(captured_at="c", **KW)
    insert_or_ignore(rows.filter("seq % 100 = 0"), t, partition_by=("k",), **kw)
    assert insert_or_ignore(rows.filter("seq % 10 = 0"), t, **kw).inserted == 180


def test_a_key_whose_partition_changes_is_stored_once(spark):
    t = scratch_path(spark, "t-moved")
    kw = dict(keys=["d"], arrival=["seq"], columns=["k", "d", "v"], captured_at="c", partition_by=("k",))
    insert_or_ignore(batch(spark, [("a", "1", 1.0, 1)]), t, **kw)
    assert insert_or_ignore(batch(spark, [("b", "1", 2.0, 1)]), t, **kw).inserted == 0


def test_equal_arrivals_are_decided_by_content(spark):
    rows = [("a", "1", float(v), 0) for v in (5, 3, 4)]
    for order in (rows, rows[::-1]):
        t = scratch_path(spark, "t-tie")
        insert_or_ignore(batch(spark, order).repartition(3), t, captured_at="c", **KW)
        assert stored(spark, t)[("a", "1")][1] == 3.0


def test_markers_are_folded(spark):
    from cropwire.operators import keyed_sink as ks
    t = scratch_path(spark, "t-markers")
    insert_or_ignore(batch(spark, [("a", "1", 1.0, 1)]), t, captured_at="c", **KW)
    schema = read_table(spark, t).schema
    before, ks.MARKERS = ks.MARKERS, 3
    try:
        for i in range(2, 6):
            insert_or_ignore(batch(spark, [(f"a{i}", "1", 1.0, 1)]), t, captured_at="c", **KW)
    finally:
        ks.MARKERS = before
    assert len(spark.read.parquet(f"{t}/_commits").inputFiles()) <= 3
    assert ks.high_water_mark(spark, t, schema) == 5


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_of_many_partitions_come_from_a_join(spark):
    settings = {"spark.sql.shuffle.partitions": "2000", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out, n = sequence_ids(spark.range(0, 30_000).select((F.col("id") * 7919 % 30_000).alias("x")), ["x"], 5)
        parts = out.withColumn("p", F.spark_partition_id()).groupBy().agg(F.count_distinct("p").alias("p"), F.count(F.lit(1)).alias("n"), F.sum((F.col("id") != F.col("x") + 6).cast("int")).alias("wrong")).first()
        assert (n, parts.n, parts.wrong) == (30_000, 30_000, 0) and parts.p > 1000
        assert "BroadcastHashJoin" in _plan(out) and "map(" not in _plan(out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _rows_scanned(df, column):
    """Rows that the scan with ``column`` of the executed plan gave: those of the row groups that it did not skip."""
    def scans(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            yield from scans(node.executedPlan())
        elif "QueryStage" in name:
            yield from scans(node.plan())
        elif name.startswith("Scan parquet"):
            yield node
        children = node.children()
        for i in range(children.size()):
            yield from scans(children.apply(i))
    df.collect()
    return sum(s.metrics().apply("numOutputRows").value() for s in scans(df._jdf.queryExecution().executedPlan()) if column in s.toString())


@pytest.mark.parametrize("keys", [["k"], ["k", "d"]])
def test_scattered_keys_skip_row_groups(spark, keys):
    from cropwire.operators import keyed_sink as ks
    t = scratch_path(spark, "t-bloom")
    rows = spark.range(0, 200_000).selectExpr("concat('k', lpad(CAST(id * 7919 % 200000 AS STRING), 7, '0')) AS k", "CAST(id % 50 AS STRING) AS d",
                                              "1.0D AS v", "CAST(id AS INT) AS seq")
    kw = dict(keys=keys, arrival=["seq"], columns=["k", "d", "v"], captured_at="c")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.row.count.limit", "200")  # many row groups
    try:
        insert_or_ignore(rows.filter("seq % 2 = 0"), t, **kw)
    finally:
        hadoop.unset("parquet.block.row.count.limit")
    # Keys all over the table's range; every other one is stored.
    batch = spark.range(0, 100).selectExpr("concat('k', lpad(CAST((id * 1999 + id % 2) * 7919 % 200000 AS STRING), 7, '0')) AS k",
                                           "CAST((id * 1999 + id % 2) % 50 AS STRING) AS d", "2.0D AS v", "CAST(id AS INT) AS seq").persist()
    schema = read_table(spark, t).schema
    ends = {k: tuple(batch.agg(F.min(k), F.max(k)).first()) for k in keys}
    ranged = ks._not_stored(spark, batch, t, schema, keys, ends)
    sought = ks._not_stored(spark, batch, t, schema, keys, ends, ks._few_keys(batch, keys, 100))
    want = sorted(r.k for r in ranged.collect())
    assert sorted(r.k for r in sought.collect()) == want
    all_rows, some = _rows_scanned(ranged, "k"), _rows_scanned(sought, "k")
    assert some < 0.5 * all_rows, (some, all_rows)
    assert insert_or_ignore(batch, t, **kw).inserted == len(want)
    assert ks._few_keys(batch, keys, ks.FEW_KEYS + 1) == {}


def test_persisted_frames_are_released(spark):
    from cropwire.operators import keyed_sink as ks
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    t = scratch_path(spark, "t-held")
    for v in (1.0, 2.0):
        ks.insert_or_ignore(batch(spark, [("a", str(v), v, 1)]), t, captured_at="c", **KW)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held


def test_first_writer_carries_the_row_once(spark):
    """The order holds the whole row, so no second copy of it is sorted and shuffled; maps go beside it."""
    rows = [("a", "1", float("nan"), 2), ("a", "1", None, 2), ("a", "1", 3.0, None), ("b", None, 0.5, 1), (None, None, 1.0, 4), (None, None, 1.0, 3)]
    df = batch(spark, rows)
    got = first_writer(df, ["k", "d"], ["seq"])
    assert "min_by" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.columns == df.columns
    assert {tuple(r) for r in got.collect()} == {("a", "1", 3.0, None), ("b", None, 0.5, 1), (None, None, 1.0, 3)}
    maps = df.withColumn("m", F.create_map(F.lit("seq"), "seq"))
    assert {(r.k, r.seq, r.m["seq"]) for r in first_writer(maps, ["k", "d"], ["seq"]).collect()} == {("a", None, None), ("b", 1, 1), (None, 3, 3)}


def test_many_keys_meet_the_stored_ones_in_one_join(spark, monkeypatch):
    """A batch of many keys: the same rows as with two joins, keys outside the range and null ones too."""
    kw = dict(keys=["k", "d"], arrival=["seq"], columns=["k", "d", "v"], captured_at="c", not_null=["k"])
    one = [(f"k{i}", "1", float(i), i) for i in range(40)] + [("n", None, 1.0, 99)]
    two = [(f"k{i}", "1", -1.0, i) for i in range(20, 60)] + [("n", None, 2.0, 98)]
    tables = []
    for many in (0, 1 << 20):
        monkeypatch.setattr(keyed_sink, "MANY_KEYS", many)
        tables.append(scratch_path(spark, "t-many"))
        insert_or_ignore(batch(spark, one), tables[-1], **kw)
        assert insert_or_ignore(batch(spark, two), tables[-1], **kw).inserted == 21
    a, b = (sorted((r.id, r.k, r.d or "", r.v) for r in read_table(spark, t).collect()) for t in tables)
    assert a == b and len(a) == 62
    cand = batch(spark, two)
    plan = keyed_sink._not_stored(spark, cand, tables[0], read_table(spark, tables[0]).schema, ["k", "d"], {}, many=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and "LeftSemi" not in plan
