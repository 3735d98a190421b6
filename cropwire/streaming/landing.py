"""Repeated cycles as a stream over a landing folder.

Each scheduled run is ``trigger(availableNow=True)``: it processes the files
landed since the previous run (the checkpoint remembers which), reports what was
requested and did not land, and stops; ``repeat_runs`` leaves a fixed delay
between the end of a run and the next. The
batch functions run unchanged inside ``foreachBatch``, where the keyed sink's
anti join against the table makes a replayed micro-batch harmless.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropwire.functions.dates import utc_now_iso
from cropwire.operators.keyed_sink import create_table_if_absent, insert_or_ignore, path_exists
from cropwire.plans.cycles import CycleRun, report_missing, run_climate_cycle, run_market_cycle
from cropwire.schemas import CLIMATE_TABLE_SCHEMA, MARKET_TABLE_SCHEMA
from cropwire.sources.documents import Landed, exact_path, landed_files, scan_landed

#: Files of a micro-batch unless the caller bounds them; their names come to the driver.
MAX_FILES = 10_000


def run_available(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                  processing_time: str | None = None):
    """Start ``stream`` with ``foreachBatch(handler)``; with no interval, drain and stop."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if processing_time:
        return writer.trigger(processingTime=processing_time).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_keyed(spark: SparkSession, landing: str, schema: str, target: str, checkpoint: str,
                 fmt: str = "parquet", **sink_kwargs):
    """Landed batches -> keyed table, first writer wins across runs."""
    stream = spark.readStream.schema(schema).format(fmt).load(landing)

    def handle(batch: DataFrame, epoch: int) -> None:
        insert_or_ignore(batch, target, **sink_kwargs)

    return run_available(stream, handle, checkpoint)


LOG_SCHEMA = ("epoch bigint, files bigint, documents bigint, rows bigint, offered bigint, inserted bigint, published bigint, "
              "quarantined bigint, started_at string, ended_at string")


def _run_files(spark: SparkSession, landing: str, key: str, checkpoint: str, run: Callable[[Landed, int], CycleRun], fmt: str,
               schema: str | None, max_files: int | None, archive: str | None, log_path: str | None, processing_time: str | None):
    """Stream the landed files' names and run a cycle over each batch of them.

    The handler opens the files itself, so that one that cannot be read costs
    its own documents only and is known by name (F4). ``log_path``: a row of
    counts for every batch, in a folder of its own that a replay replaces (F5).
    """
    files = landed_files(spark, landing, stream=True, max_files=max_files or MAX_FILES, archive=archive)

    def handle(batch: DataFrame, epoch: int) -> None:
        started = utc_now_iso()
        # At most max_files; a listing names a file twice when another's name looks like a pattern.
        paths = sorted({exact_path(r["path"]) for r in batch.select("path").collect()})
        if not paths:
            return
        done = run(scan_landed(spark, paths, key, fmt, schema), epoch)
        if log_path:
            sink = done.sink
            row = (epoch, len(paths), done.documents, done.rows, sink and sink.offered, sink and sink.inserted, done.published,
                   done.quarantined, started, utc_now_iso())
            spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/batch_id={epoch}")

    return run_available(files, handle, checkpoint, processing_time)


def close_cycle(spark: SparkSession, requested: DataFrame, report_path: str, feed: str, key: str, count: str,
                quarantine_path: str | None = None) -> int:
    """F5 at the end of a run: the keys that were requested and did not land since the last close, once each; their number.

    A cycle is all batches since the last close, also those of a run that
    broke off. Their reports say what landed. The close is recorded beside
    the reports; one that broke off is done again and replaces what it wrote.
    """
    report_path = report_path.rstrip("/")
    closes = f"{report_path}/_cycles"
    last = spark.read.parquet(closes).agg(F.max("cycle").alias("cycle"), F.max("last_epoch").alias("epoch")).first() if path_exists(spark, closes) else None
    first = last["epoch"] + 1 if last else 0
    epochs = []
    while path_exists(spark, f"{report_path}/batch_id={first + len(epochs)}"):
        epochs.append(first + len(epochs))
    cycle = (last["cycle"] if last else 0) + 1
    n = report_missing(spark, requested, [f"{report_path}/batch_id={e}" for e in epochs], feed, key, count, quarantine_path, report_path, f"cycle-{cycle}")
    spark.createDataFrame([(cycle, first + len(epochs) - 1, n)], "cycle bigint, last_epoch bigint, missing bigint").coalesce(1).write.mode("append").parquet(closes)
    return n


def _requested_needs(requested: DataFrame | None, report_path: str | None, processing_time: str | None) -> None:
    if requested is not None and (not report_path or processing_time):
        raise ValueError("requested keys need report_path, and runs that end (no processing_time)")


def stream_climate(spark: SparkSession, landing: str, dim: DataFrame, table: str, checkpoint: str,
                   quarantine_path: str | None = None, fmt: str = "parquet", schema: str | None = None,
                   max_files: int | None = None, processing_time: str | None = None, requested: DataFrame | None = None,
                   log_path: str | None = None, archive: str | None = None, **cycle_kwargs):
    """F1 + F3: landed climate documents -> climate table.

    ``max_files`` bounds a micro-batch (a backlog is then worked off in several);
    the epoch is the batch id of the side outputs, so a replayed micro-batch replaces its own.
    ``requested``: the producers that a run asked for; the end of the run reports those of which
    nothing landed (needs ``report_path``). ``log_path``: a row of counts for each batch. ``archive``: a folder outside
    ``landing`` to which files move once they are done.
    """
    _requested_needs(requested, cycle_kwargs.get("report_path"), processing_time)
    with_schema(spark, table, CLIMATE_TABLE_SCHEMA, cycle_kwargs.get("partition_by"))
    query = _run_files(spark, landing, "producer_id", checkpoint,
                       lambda landed, epoch: run_climate_cycle(landed, dim, table, quarantine_path, batch_id=epoch, **cycle_kwargs),
                       fmt, schema, max_files, archive, log_path, processing_time)
    if requested is not None:
        close_cycle(spark, requested, cycle_kwargs["report_path"], "climate", "producer_id", "rows", quarantine_path)
    return query


def stream_market(spark: SparkSession, landing: str, topic_path: str, checkpoint: str,
                  table: str | None = None, quarantine_path: str | None = None, fmt: str = "parquet",
                  schema: str | None = None, max_files: int | None = None, processing_time: str | None = None,
                  requested: DataFrame | None = None, log_path: str | None = None, archive: str | None = None, **cycle_kwargs):
    """F2 + F3: landed market documents -> topic (and optionally the market table); the rest as in ``stream_climate``."""
    _requested_needs(requested, cycle_kwargs.get("report_path"), processing_time)
    if table is not None:
        with_schema(spark, table, MARKET_TABLE_SCHEMA, cycle_kwargs.get("partition_by"))
    query = _run_files(spark, landing, "symbol", checkpoint,
                       lambda landed, epoch: run_market_cycle(landed, topic_path, table, quarantine_path, batch_id=epoch, **cycle_kwargs),
                       fmt, schema, max_files, archive, log_path, processing_time)
    if requested is not None:
        close_cycle(spark, requested, cycle_kwargs["report_path"], "market", "symbol", "published", quarantine_path)
    return query


def repeat_runs(run: Callable[[], object], delay_seconds: float, runs: int | None = None, sleep: Callable[[float], None] = time.sleep) -> None:
    """``run`` again and again, each time ``delay_seconds`` after the end of the one before (not at a rate); for ever unless ``runs`` is given."""
    done = 0
    while True:
        run()
        done += 1
        if done == runs:
            return
        sleep(delay_seconds)


def with_schema(spark: SparkSession, table: str, schema, partition_by: tuple[str, ...] | None) -> None:
    """The table exists as soon as a feed starts, before anything has landed."""
    create_table_if_absent(spark, table, schema, tuple(partition_by or ()))
