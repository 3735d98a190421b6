"""Job entry points: what the two feed programs run, as Spark jobs.

    spark-submit --py-files cropwire.zip cropwire/jobs.py climate --landing L --table T [--quarantine Q]
        [--stream --checkpoint C --interval-hours 24]
    spark-submit --py-files cropwire.zip cropwire/jobs.py market --landing L --topic-path P [--table T]
        [--max-weeks 520] [--stream ...]
    python -m cropwire.jobs manifest --out O [--symbols WEAT,CORN,SOYB,JO,UNG] [--as-of 2024-03-01]

Batch mode runs one cycle over everything landed under ``--landing``. With
``--stream`` the landing folder is read as a stream: ``--interval-hours 0``
drains what is new and stops (one scheduled run); a positive interval runs
again that long after the end of each run. In both modes a file or line that cannot be
read is quarantined and the others go on. The session comes from the cluster (spark-submit);
scratch and checkpoints belong under its ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cropwire.plans.cycles import run_climate_cycle, run_market_cycle
from cropwire.schemas import CLIMATE_DAYS, MARKET_MAX_WEEKS, TOPIC
from cropwire.sources import (
    climate_request_manifest, market_request_manifest, producer_dimension, producer_ids, scan_landed, symbol_list,
)
from cropwire.streaming.landing import repeat_runs, stream_climate, stream_market


def _dimension(spark: SparkSession, path: str | None):
    return producer_dimension(spark, spark.read.parquet(path) if path else None)


def _run(spark: SparkSession, a: argparse.Namespace, key: str, cycle, stream_cycle) -> None:
    """One batch cycle over the landing folder, or runs of the stream over it; both with the same outputs."""
    kw = dict(partition_by=tuple(a.partition_by) if a.partition_by else None, report_path=a.report)
    if not a.stream:
        cycle(scan_landed(spark, a.landing, key, a.format), dict(kw, batch_id=a.batch_id))
        return
    run = lambda: stream_cycle(dict(kw, fmt=a.format, max_files=a.max_files, log_path=a.log, archive=a.archive))
    repeat_runs(run, a.interval_hours * 3600, None if a.interval_hours > 0 else 1)


def climate(spark: SparkSession, a: argparse.Namespace) -> None:
    dim = _dimension(spark, a.dimension)
    more = dict(messages_path=a.messages, requested=producer_ids(dim) if a.requested else None)
    _run(spark, a, "producer_id",
         lambda docs, kw: run_climate_cycle(docs, dim, a.table, a.quarantine, **more, **kw),
         lambda kw: stream_climate(spark, a.landing, dim, a.table, a.checkpoint, a.quarantine, **more, **kw))


def market(spark: SparkSession, a: argparse.Namespace) -> None:
    asked = symbol_list(spark, a.symbols) if a.symbols else None
    more = dict(table=a.table, quarantine_path=a.quarantine, max_weeks=a.max_weeks, topic=a.topic, requested=asked)
    _run(spark, a, "symbol",
         lambda docs, kw: run_market_cycle(docs, a.topic_path, **more, **kw),
         lambda kw: stream_market(spark, a.landing, a.topic_path, a.checkpoint, **more, **kw))


def manifest(spark: SparkSession, a: argparse.Namespace) -> None:
    climate_request_manifest(_dimension(spark, a.dimension), a.as_of, a.days) \
        .write.mode("overwrite").json(f"{a.out}/climate")
    if a.symbols is not None:
        market_request_manifest(symbol_list(spark, a.symbols)).write.mode("overwrite").json(f"{a.out}/market")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cropwire.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("climate", "market"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--format", default="parquet", choices=["parquet", "json", "wholetext"])
        s.add_argument("--table")
        s.add_argument("--quarantine")
        s.add_argument("--stream", action="store_true")
        s.add_argument("--checkpoint")
        s.add_argument("--interval-hours", type=int, default=0)
        s.add_argument("--max-files", type=int, help="files of one micro-batch")
        s.add_argument("--log", help="stream: folder of the log, a row of counts for each batch")
        s.add_argument("--archive", help="stream: folder outside --landing that files move to when they are done")
        s.add_argument("--batch-id", help="batch mode: a repeated run with this id replaces its side outputs")
        s.add_argument("--report", help="folder of the per-document report")
        s.add_argument("--partition-by", nargs="*")
        if name == "climate":
            s.add_argument("--dimension", help="parquet producer table; default: built-in 25 producers")
            s.add_argument("--messages", help="folder of the provider's messages")
            s.add_argument("--requested", action="store_true", help="report every producer, landed or not (a stream: at the end of each run; needs --report)")
        else:
            s.add_argument("--topic-path")
            s.add_argument("--topic", default=TOPIC)
            s.add_argument("--symbols", help="requested symbols, comma list: missing documents (a stream needs --report) and, in batch mode, order of arrival")
            s.add_argument("--max-weeks", type=int, default=MARKET_MAX_WEEKS)
    s = sub.add_parser("manifest")
    s.add_argument("--out", required=True)
    s.add_argument("--symbols")
    s.add_argument("--as-of")
    s.add_argument("--days", type=int, default=CLIMATE_DAYS)
    s.add_argument("--dimension")
    return p


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    if a.job == "climate" and not a.table:
        raise SystemExit("--table is required")
    if getattr(a, "stream", False) and not a.checkpoint:
        raise SystemExit("--checkpoint is required with --stream")
    spark = SparkSession.builder.getOrCreate()
    {"climate": climate, "market": market, "manifest": manifest}[a.job](spark, a)


if __name__ == "__main__":
    main()
