"""Keyed table sinks with first-writer-wins semantics.

``insert_or_ignore`` is one operator shared by the climate and market tables
(and any other keyed table): rows whose key is already stored are ignored,
within a batch the earliest arrival wins, new rows get increasing surrogate
ids, and the batch is appended with one write. Replaying a batch adds nothing.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from cropwire.functions.dates import utc_now_iso
from cropwire.functions.numbers import nan_to_null

# Commit markers above which they are folded into one.
MARKERS = 64
# Partitions whose starts are summed together.
BLOCK_BITS = 7
# Rows of a batch whose key values are pushed into the scan of the stored table one by one.
FEW_KEYS = 1000
# Rows of a batch whose keys are too many to be sent to every executor.
MANY_KEYS = 1 << 20
# Values that a row group's Bloom filter is sized for at most (about a megabyte).
BLOOM_VALUES = 1 << 20


@dataclass
class SinkResult:
    offered: int
    inserted: int
    rejected: DataFrame


def table_exists(spark: SparkSession, path: str, schema: T.StructType | None = None) -> bool:
    """True when the table folder exists (an empty partitioned table has no files)."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        reader.parquet(path)
        return True
    except AnalysisException:
        return False


def _layout_path(target: str) -> str:
    # A folder starting with "_" is not part of the table for Spark's reader.
    return f"{target.rstrip('/')}/_layout"


def _record_layout(spark: SparkSession, target: str, schema: T.StructType, partition_by: tuple[str, ...]) -> None:
    spark.createDataFrame([(schema.json(), list(partition_by))], "schema string, partition_by array<string>") \
        .coalesce(1).write.mode("overwrite").parquet(_layout_path(target))


def table_layout(spark: SparkSession, target: str) -> tuple[T.StructType, tuple[str, ...]] | None:
    """The table's declared schema and partition columns; None for a table written without them."""
    try:
        r = spark.read.parquet(_layout_path(target)).first()
    except AnalysisException:
        return None
    return (T.StructType.fromJson(json.loads(r["schema"])), tuple(r["partition_by"])) if r else None


def create_table_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                           partition_by: tuple[str, ...] = ()) -> bool:
    """Create an empty table with ``schema`` unless one exists. True if created."""
    if table_exists(spark, path, schema):
        return False
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy(*partition_by).parquet(path)
    _record_layout(spark, path, schema, partition_by)
    return True


def not_null_gate(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(passing, violating)``; violating rows carry ``null_columns``."""
    if not columns:
        return df, df.limit(0).withColumn("null_columns", F.lit(None).cast("string"))
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.filter(~any_null), df.filter(any_null).withColumn("null_columns", names)


def first_writer(batch: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """One row per key: the earliest by ``arrival``, ties broken by the row's content.

    A ``min`` aggregate, not a window: it combines map-side, so a key
    holding a third of all rows still sends one row per map task. The order
    holds the whole row, which is sorted and shuffled once; only maps, which
    have no order, go beside it.
    """
    maps = [f.name for f in batch.schema.fields if isinstance(f.dataType, T.MapType)]
    names = list(dict.fromkeys([*arrival, *[c for c in batch.columns if c not in maps]]))
    order = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(names)])
    first = [F.min(order).alias("_w")]
    if maps:
        first.append(F.min_by(F.struct(*maps), order).alias("_m"))
    found = batch.groupBy(*keys).agg(*first)
    return found.select(*[found["_m"][c].alias(c) if c in maps else found["_w"][f"_{names.index(c)}"].alias(c) for c in batch.columns])


def _starts(counts: DataFrame, start: int) -> DataFrame:
    """``(_pid, _start)``: ``start`` and the rows of all earlier partitions, from ``(_pid, _n)``.

    Two levels: sums within blocks of partitions, and sums of whole blocks, so
    that no window holds more rows than about the square root of the partitions.
    """
    block = F.shiftright("_pid", BLOCK_BITS)
    inside = Window.partitionBy("_block").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (counts.groupBy(block.alias("_block")).agg(F.sum("_n").alias("_sum"))
              .select("_block", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead")))
    return (counts.withColumn("_block", block).withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
            .join(blocks, "_block").select("_pid", (F.col("_inside") + F.col("_ahead") + F.lit(start)).alias("_start")))


def _sequenced(df: DataFrame, order: list[str], start: int, id_col: str) -> tuple[DataFrame, int, list[DataFrame]]:
    """``sequence_ids`` and the persisted frames to release once the rows are written."""
    tagged = (df.orderBy(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .persist())
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).persist()
    total = int(counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"])
    # One row of 16 bytes for each partition, however many rows there are.
    starts = F.broadcast(_starts(counts, start))
    in_part = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    ids = (F.col("_start") + in_part + 1).cast("bigint")
    return tagged.join(starts, "_pid").withColumn(id_col, ids).drop("_pid", "_mid", "_start"), total, [tagged, counts]


def sequence_ids(df: DataFrame, order: list[str], start: int, id_col: str = "id") -> tuple[DataFrame, int]:
    """``start + 1, start + 2, ...`` in ``order``; returns ``(rows, count)``.

    ``order`` must be a total order (the caller appends the key). Distributed:
    a range-partitioned sort; each row's position inside its partition comes
    from ``monotonically_increasing_id``; per-partition row counts become the
    partitions' starts, which are data: a join looks them up, so neither the plan nor the work
    per row grows with the number of partitions.
    The sorted rows are persisted between the count and the write; a lost
    block is recomputed identically because the order is total and the range
    bounds are fixed in the plan.
    """
    rows, total, _ = _sequenced(df, order, start, id_col)
    return rows, total


def _not_stored(spark: SparkSession, cand: DataFrame, target: str, schema: T.StructType, keys: list[str],
                ranges: dict[str, tuple], few: dict[str, list] | None = None, many: bool = False) -> DataFrame:
    """Candidates whose key is not in the stored table (E3 anti join, planned for a large table).

    The batch's range of every key column is pushed into the scan of the
    stored keys, which skips files and row groups outside it; where a key
    column is a partition column, the join with the batch's keys prunes the folders
    to the batch's own values as well. A batch of few keys also pushes each column's values
    (``few``): the table's files are sorted by key and carry Bloom filters of the key columns, so
    row groups that hold none of them are skipped although they lie within the range. Spark sizes the persisted batch in bytes and
    broadcasts its keys where they are small, so the large table is then
    scanned once and never shuffled. With ``many`` keys the stored ones are shuffled
    anyhow, and one join does what else takes two.
    """
    stored, probe = spark.read.schema(schema).parquet(target).select(*keys), cand.select(*keys)
    for c, (low, high) in ranges.items():
        if low is not None:
            stored = stored.filter(F.col(c).between(F.lit(low), F.lit(high)))
            # Says no more than the range, but marks the probe as selective.
            probe = probe.filter(F.col(c) >= F.lit(low))
    for c, values in (few or {}).items():
        stored = stored.filter(F.col(c).isin(values))
    if many:
        return cand.join(stored, keys, "left_anti")
    hits = stored.join(probe, keys, "left_semi")
    return cand.join(hits, keys, "left_anti")


def _few_keys(cand: DataFrame, keys: list[str], offered: int) -> dict[str, list]:
    """The values of every key column of a batch of at most ``FEW_KEYS`` rows; nothing for a larger one."""
    if offered > FEW_KEYS:
        return {}
    rows = cand.select(*keys).collect()
    return {k: sorted({r[k] for r in rows if r[k] is not None}) for k in keys}


def _bloom_options(keys: list[str], rows: int) -> dict[str, str]:
    """Writer options for Bloom filters of the key columns, sized by the rows of the append."""
    options = {}
    for k in keys:
        options[f"parquet.bloom.filter.enabled#{k}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{k}"] = str(max(1, min(rows, BLOOM_VALUES)))
    return options


def _commits(target: str) -> str:
    return f"{target.rstrip('/')}/_commits"


def _record_commit(spark: SparkSession, target: str, last_id: int) -> None:
    """After an append: one tiny marker row with the batch's last id."""
    marker = spark.createDataFrame([(last_id,)], "last_id bigint").coalesce(1)
    # The newest marker has the largest id, so the older ones can go now and then.
    full = len(spark.read.schema("last_id bigint").parquet(_commits(target)).inputFiles()) >= MARKERS if path_exists(spark, _commits(target)) else False
    marker.write.mode("overwrite" if full else "append").parquet(_commits(target))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def high_water_mark(spark: SparkSession, target: str, schema: T.StructType, id_col: str = "id") -> int:
    """Largest stored id, without scanning the whole table.

    Each append records its last id in a marker written after the data. The
    mark is the largest recorded id, checked against the data files modified
    since the newest marker (normally none: ``_metadata`` filters prune files
    before reading). That covers an append whose marker was lost to a crash.
    A table without markers is scanned once (id column only).
    """
    mtime = F.col("_metadata.file_modification_time")
    data = spark.read.schema(schema).parquet(target)
    try:
        rec = spark.read.parquet(_commits(target)).agg(F.max("last_id").alias("m"), F.max(mtime).alias("t")).first()
    except AnalysisException:
        rec = None
    if rec is None or rec["m"] is None:
        return int(data.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"])
    tail = data.filter(mtime >= F.lit(rec["t"])).agg(F.max(id_col).alias("m")).first()["m"]
    return max(int(rec["m"]), int(tail or 0))


def insert_or_ignore(batch: DataFrame, target: str, *, keys: list[str], arrival: list[str],
                     columns: list[str], not_null: list[str] | None = None,
                     partition_by: tuple[str, ...] | None = None, captured_at: str | None = None,
                     id_col: str = "id", schema: T.StructType | None = None) -> SinkResult:
    """Append the rows of ``batch`` whose key is not stored yet.

    * ``keys``: the unique key; ``arrival``: order deciding the first writer
      within the batch (earlier batches always win over later ones; equal
      arrivals are decided by content).
    * ``columns``: stored columns besides ``id`` and ``captured_at``.
    * ``not_null``: rows with a NULL there are skipped and returned as rejected.
    * double columns are stored with NaN as NULL (E8).
    * ``captured_at``: one stamp for the whole batch (E5), default now (UTC).
    * ``partition_by``: partition columns of a new table. An existing table keeps
      its own; asking for others is an error.
    * ``schema``: the declared schema of a new table; default: that of the batch.
    """
    spark = batch.sparkSession
    stamp = captured_at or utc_now_iso()
    fields = {f.name: f.dataType for f in batch.schema.fields}
    if schema is None:
        schema = T.StructType(
            [T.StructField(id_col, T.LongType(), False)]
            + [T.StructField(c, fields[c], True) for c in columns]
            + [T.StructField("captured_at", T.StringType(), False)])
    # The table exists from the first call on, with its declared schema.
    wanted = tuple(partition_by or ())
    if any(c not in columns for c in wanted):
        raise ValueError("partition columns must be stored columns")
    layout = table_layout(spark, target)
    created = layout is None and create_table_if_absent(spark, target, schema, wanted)
    if layout is not None:
        schema, own = layout
    else:
        own = wanted if created else partition_columns(spark, target)
    if partition_by is not None and wanted != own:
        raise ValueError(f"{target} is partitioned by {list(own)}, not by {list(wanted)}")
    keep = list(dict.fromkeys(columns + keys + arrival + list(own)))
    gated, rejected = not_null_gate(batch.select(*keep), not_null if not_null is not None else keys)
    cand = first_writer(gated, keys, arrival).persist()
    store_cols = [id_col, *columns, "captured_at"]
    try:
        if created:
            # Nothing stored yet: every candidate is new and ids start at 1.
            fresh, base, offered = cand, 0, None
        else:
            # One pass over the persisted candidates: their number and the
            # range of every key column.
            st = cand.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{n}_{k}") for k in keys
                                                         for n, f in (("lo", F.min), ("hi", F.max))]).first()
            offered = int(st["n"])
            if offered == 0:  # E9: an empty batch is a no-op
                return SinkResult(0, 0, rejected)
            fresh = _not_stored(spark, cand, target, schema, keys, {k: (st[f"lo_{k}"], st[f"hi_{k}"]) for k in keys},
                                _few_keys(cand, keys, offered), many=offered > MANY_KEYS and not own)
            base = high_water_mark(spark, target, schema, id_col)
        ranked, inserted, held = _sequenced(fresh, arrival + [k for k in keys if k not in arrival], int(base), id_col)

        def stored_value(c: str) -> Column:
            if isinstance(fields[c], (T.DoubleType, T.FloatType)):
                return nan_to_null(F.col(c)).alias(c)
            return F.col(c)

        try:
            if inserted:
                out = ranked.select(F.col(id_col), *[stored_value(c) for c in columns],
                                    F.lit(stamp).alias("captured_at")).select(*store_cols)
                if own:  # few files per folder; Spark splits a large folder
                    out = out.hint("rebalance", *[F.col(c) for c in own])
                # Sorted by key, a row group holds a narrow range of keys.
                inside = [k for k in keys if k not in own]
                out = out.sortWithinPartitions(*own, *inside)
                out.write.mode("append").options(**_bloom_options(inside, inserted)).partitionBy(*own).parquet(target)
                _record_commit(spark, target, int(base) + inserted)
        finally:
            for frame in held:
                frame.unpersist()
        return SinkResult(inserted if offered is None else offered, inserted, rejected)
    finally:
        cand.unpersist()


def partition_columns(spark: SparkSession, target: str) -> tuple[str, ...]:
    """Partition columns of a table without a recorded layout, from its folder names."""
    names, path = [], spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    while True:
        inside = [x.getPath() for x in fs.listStatus(path) if x.isDirectory() and "=" in x.getPath().getName()]
        if not inside:
            return tuple(names)
        names.append(inside[0].getName().split("=")[0])
        path = inside[0]


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """The stored rows, with the declared types (a text partition value stays text)."""
    layout = table_layout(spark, target)
    return spark.read.schema(layout[0]).parquet(target) if layout else spark.read.parquet(target)
