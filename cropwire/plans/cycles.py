"""Climate and market cycles as single DataFrame plans over all documents.

A cycle is lazy until one of its ``run_*`` functions writes it. The staged
document-level frame (parsed once, gated, typed arrays inside the row) is
persisted while its several outputs are written, then released.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cropwire.functions.dates import iso_midnight_text
from cropwire.operators.climate import climate_observations, kept_days, stage_climate
from cropwire.operators.events import event_json, market_events, publish_topic, topic_messages
from cropwire.operators.keyed_sink import SinkResult, insert_or_ignore
from cropwire.operators.market import market_observations, stage_market
from cropwire.schemas import (
    CLIMATE_KEYS, CLIMATE_NOT_NULL, CLIMATE_OBSERVATION_COLUMNS, CLIMATE_TABLE_SCHEMA, MARKET_KEYS,
    MARKET_MAX_WEEKS, MARKET_NOT_NULL, MARKET_TABLE_SCHEMA, TOPIC,
)
from cropwire.sources.dimension import lookup_producers
from cropwire.sources.documents import Landed, status_fault

CLIMATE_STORE_COLUMNS = CLIMATE_OBSERVATION_COLUMNS
#: Characters kept of a line that is no JSON.
UNREADABLE_CHARS = 200
MARKET_STORE_COLUMNS = ["symbol", "price_timestamp", "open", "high", "low", "close",
                        "adjusted_close", "volume", "dividend_amount"]


def _fault(key, detail_key=None, reason=None, detail=None):
    """One quarantine entry of a document, for an array of them."""
    def text(c):
        return (F.lit(None) if c is None else c).cast("string")
    return F.struct(text(key).alias("key"), text(detail_key).alias("detail_key"), text(reason).alias("reason"), text(detail).alias("detail"))


def _when(condition, fault):
    return F.when(condition, F.array(fault)).otherwise(F.array())


def _faults(staged: DataFrame, feed: str, *parts) -> DataFrame:
    """Quarantine rows from one array of faults per document, so the document is staged once."""
    return staged.select(F.lit(feed).alias("feed"), F.inline(F.concat(*parts)))


def missing_documents(requested: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Requested keys of which no document landed, once each (F5: a failing request is seen)."""
    return requested.select(key).distinct().join(landed.select(key), key, "left_anti")


def _with_missing(quarantine: DataFrame, report: DataFrame, requested: DataFrame | None, landed: DataFrame,
                  feed: str, key: str, count: str) -> tuple[DataFrame, DataFrame]:
    if requested is None:
        return quarantine, report
    gone = missing_documents(requested, landed, key)
    rows = gone.select(key, F.lit(None).cast("bigint").alias("doc_seq"), F.lit(0).cast("bigint").alias(count))
    return quarantine.unionByName(_quarantine(gone, feed, key, reason=F.lit("no_document"))), report.unionByName(rows)


def _quarantine(df: DataFrame, feed: str, key: str, detail_key=None, reason="fault", detail=None) -> DataFrame:
    def col(c):
        if c is None:
            return F.lit(None).cast("string")
        return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    return df.select(F.lit(feed).alias("feed"), col(key).alias("key"), col(detail_key).alias("detail_key"),
                     col(reason).alias("reason"), col(detail).alias("detail"))


def _unreadable(docs: DataFrame):
    """The fault of a landed line that is no JSON (``Landed``), to be continued with other cases."""
    bad = F.col("unreadable").isNotNull() if "unreadable" in docs.columns else F.lit(False)
    return F.when(bad, F.lit("unreadable_line"))


def _origin(docs: DataFrame, key):
    """Whose fault it is (a line without a key: its file's) and the text of an unreadable line."""
    if "unreadable" not in docs.columns:
        return key, F.lit(None).cast("string")
    return F.when(F.col("unreadable").isNotNull(), F.col("file")).otherwise(key), F.substring("unreadable", 1, UNREADABLE_CHARS)


def _readable(staged: DataFrame) -> DataFrame:
    return staged.filter(F.col("unreadable").isNull()) if "unreadable" in staged.columns else staged


def _unreadable_files(landed: Landed | None, staged: DataFrame, feed: str) -> DataFrame | None:
    """Quarantine rows of the files that gave no document, or fewer than they declare."""
    if landed is None:
        return None
    good = F.col("unreadable").isNull() if "unreadable" in staged.columns else F.lit(True)
    read = staged.groupBy("file").agg(F.count(F.when(good, 1)).alias("found"))
    told = F.when(F.col("rows").isNotNull(), F.format_string("%d of %d rows", "found", "rows"))
    return _quarantine(landed.unreadable_files(read), feed, "file", reason=F.lit("unreadable_file"), detail=told)


# ---------------------------------------------------------------- climate --

@dataclass
class ClimateCycle:
    staged: DataFrame
    observations: DataFrame
    quarantine: DataFrame
    messages: DataFrame
    report: DataFrame
    landed_report: DataFrame  # the report without requested keys that did not land

    @property
    def no_data(self) -> DataFrame:
        """D1 (climate twin): documents that gave no rows; a filter on the report, no join."""
        return self.report.filter(F.col("rows") == 0).select("producer_id", "doc_seq")


def climate_cycle(docs: DataFrame, dim: DataFrame, requested: DataFrame | None = None) -> ClimateCycle:
    """F1 as a plan: lookup (A3/A5) -> status (A12) -> parse and gates (B) -> rows.

    ``docs``: ``producer_id, [doc_seq,] http_status, raw``. Without
    ``doc_seq`` the producer's ordinal is the arrival order. ``requested``
    (``producer_id``): keys that were asked for; those without a document are
    quarantined as ``no_document`` and reported with no rows.
    """
    if "http_status" not in docs.columns:  # landed bodies are successful responses
        docs = docs.withColumn("http_status", F.lit(200))
    looked = lookup_producers(docs, dim)
    if "doc_seq" not in docs.columns:
        looked = looked.withColumn("doc_seq", F.col("ordinal").cast("bigint"))
    fault = (_unreadable(docs).when(F.col("ordinal").isNull(), F.lit("unknown_producer"))
             .otherwise(status_fault(F.col("http_status"), F.col("raw"))))
    # The raw text is not needed past the parse; dropping it keeps the
    # persisted staging frame to the parsed arrays only.
    staged = stage_climate(looked.withColumn("fault", fault)).drop("raw")
    obs = climate_observations(staged, carry=("doc_seq",))
    key = F.col("producer_id")
    whose, text = _origin(docs, key)
    quarantine = _faults(
        staged, "climate", _when(F.col("fault").isNotNull(), _fault(whose, reason=F.col("fault"), detail=text)),
        F.coalesce(F.transform(F.filter("days", lambda d: d["bad"]),
                               lambda d: _fault(key, d["date"], F.lit("bad_number"), d["unreadable"])), F.array()))
    messages = staged.select("producer_id", F.explode("messages").alias("message"))
    report = _readable(staged).select("producer_id", "doc_seq",
                           F.when(F.col("days").isNull(), F.lit(0)).otherwise(F.size(kept_days(F.col("days"))))
                           .cast("bigint").alias("rows"))
    quarantine, whole = _with_missing(quarantine, report, requested, docs, "climate", "producer_id", "rows")
    return ClimateCycle(staged, obs, quarantine, messages, whole, report)


@dataclass
class CycleRun:
    """What a cycle wrote: the table sink result and the number of quarantined /
    published rows (None when that output was not written). Counts come from
    ``observe()`` on the writes themselves, not from extra jobs; ``documents`` and ``rows``
    (what the report says) from the staged documents."""
    sink: SinkResult | None
    quarantined: int | None
    published: int | None = None
    documents: int = 0
    rows: int = 0


def _reported(report: DataFrame, count: str) -> dict[str, int]:
    """Documents and rows of a report."""
    r = report.agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum(count), F.lit(0)).alias("r")).first()
    return {"documents": int(r["d"]), "rows": int(r["r"])}


def _write_observed(df: DataFrame, name: str, write) -> int:
    """Run ``write(df')`` where ``df'`` counts its rows on the way through."""
    obs = Observation(name)
    write(df.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])


def _side_output(path: str, batch_id: str | int | None):
    """Writer of a side output: with a batch id its own folder, which a replay of the batch replaces; else an append."""
    if batch_id is None:
        return lambda d: d.write.mode("append").parquet(path)
    return lambda d: d.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def run_climate_cycle(docs: DataFrame | Landed, dim: DataFrame, table: str, quarantine_path: str | None = None,
                      captured_at: str | None = None, partition_by: tuple[str, ...] | None = None,
                      report_path: str | None = None, messages_path: str | None = None,
                      requested: DataFrame | None = None, batch_id: str | int | None = None) -> CycleRun:
    """one cycle into the climate table (first writer wins on producer_id, date).

    Optional outputs: the quarantine table (F4), the per-document report (F5)
    and the provider's messages (B4). With ``batch_id`` a replayed batch
    replaces what it wrote there before. ``Landed`` documents bring their files:
    unreadable ones are quarantined and the rest goes on.
    """
    landed, docs = (docs, docs.docs) if isinstance(docs, Landed) else (None, docs)
    cyc = climate_cycle(docs, dim, requested)
    cyc.staged.persist()
    try:
        sink = insert_or_ignore(
            cyc.observations, table, keys=CLIMATE_KEYS, arrival=["doc_seq", "pos"],
            columns=CLIMATE_STORE_COLUMNS, not_null=CLIMATE_NOT_NULL, captured_at=captured_at,
            partition_by=partition_by, schema=CLIMATE_TABLE_SCHEMA)
        q = cyc.quarantine.unionByName(_quarantine(sink.rejected, "climate", "producer_id", "date",
                                                   F.lit("not_null"), "null_columns"))
        gone = _unreadable_files(landed, cyc.staged, "climate")
        q = q if gone is None else q.unionByName(gone)
        n_q = _write_observed(q, "climate_quarantine", _side_output(quarantine_path, batch_id)) if quarantine_path else None
        for path, rows in ((report_path, cyc.report), (messages_path, cyc.messages)):
            if path:
                _side_output(path, batch_id)(rows)
        return CycleRun(sink, n_q, **_reported(cyc.landed_report, "rows"))
    finally:
        cyc.staged.unpersist()


def report_missing(spark: SparkSession, requested: DataFrame, reports: list[str], feed: str, key: str, count: str,
                   quarantine_path: str | None, report_path: str, batch_id: str) -> int:
    """Close a cycle of several batches: the requested keys in none of their ``reports`` are quarantined and reported; their number."""
    seen = spark.read.parquet(*reports).select(key) if reports else requested.select(key).limit(0)
    gone = missing_documents(requested, seen, key).persist()
    try:
        rows = gone.select(key, F.lit(None).cast("bigint").alias("doc_seq"), F.lit(0).cast("bigint").alias(count))
        n = _write_observed(rows, "missing", _side_output(report_path, batch_id))
        if quarantine_path:
            _side_output(quarantine_path, batch_id)(_quarantine(gone, feed, key, reason=F.lit("no_document")))
        return n
    finally:
        gone.unpersist()


# ----------------------------------------------------------------- market --

@dataclass
class MarketCycle:
    staged: DataFrame
    observations: DataFrame
    events: DataFrame
    messages: DataFrame
    quarantine: DataFrame
    report: DataFrame
    landed_report: DataFrame

    @property
    def no_data(self) -> DataFrame:
        """Documents that published nothing; a filter on the report, no join."""
        return self.report.filter(F.col("published") == 0).select("symbol", "doc_seq")


def market_cycle(docs: DataFrame, max_weeks: int | None = MARKET_MAX_WEEKS, ts: str | None = None,
                 topic: str = TOPIC, requested: DataFrame | None = None) -> MarketCycle:
    """F2 as a plan: status (A12) -> parse and gates (C) -> events (D2/D3) -> topic rows.

    Arrival order is ``doc_seq``; without it, the symbol's position in
    ``requested`` (``symbol``, ``pos``); without that, the rows' content decides
    between documents of one symbol. Requested symbols without a document are
    quarantined as ``no_document`` and reported with nothing published.
    """
    if "doc_seq" not in docs.columns:
        if requested is not None and "pos" in requested.columns:
            at = requested.groupBy("symbol").agg(F.min("pos").cast("bigint").alias("doc_seq"))
            docs = docs.join(at, "symbol", "left")
        else:
            docs = docs.withColumn("doc_seq", F.lit(0).cast("bigint"))
    carry = ("doc_seq",)
    fault = _unreadable(docs).otherwise(status_fault(F.col("http_status"), F.col("raw")))
    staged = stage_market(docs.withColumn("fault", fault), max_weeks).drop("raw")
    obs = market_observations(staged, carry=carry)
    published = market_observations(staged, carry=carry, publishable_only=True)
    events = event_json(market_events(published, ts))
    messages = topic_messages(events, topic)
    key = F.col("symbol")
    whose, text = _origin(docs, key)
    quarantine = _faults(
        staged, "market", _when(F.col("fault").isNotNull(), _fault(whose, reason=F.col("fault"), detail=F.coalesce(text, F.col("detail")))),
        _when(F.col("publish_fault").isNotNull(), _fault(key, reason=F.col("publish_fault"))))
    # size() of NULL is -1 in non-ANSI sessions, hence the explicit NULL case.
    report = _readable(staged).select("symbol", *carry, F.when(F.col("publishable").isNull(), F.lit(0))
                           .otherwise(F.size("publishable")).cast("bigint").alias("published"))
    quarantine, whole = _with_missing(quarantine, report, requested, docs, "market", "symbol", "published")
    return MarketCycle(staged, obs, events, messages, quarantine, whole, report)


def market_store_rows(observations: DataFrame) -> DataFrame:
    """E4 row shape: the instant stored as ISO text."""
    return observations.withColumn("price_timestamp", iso_midnight_text(F.col("price_date")))


def run_market_cycle(docs: DataFrame | Landed, topic_path: str | None, table: str | None = None,
                     quarantine_path: str | None = None, max_weeks: int | None = MARKET_MAX_WEEKS,
                     ts: str | None = None, captured_at: str | None = None, topic: str = TOPIC,
                     topic_format: str = "parquet", topic_options: dict | None = None,
                     partition_by: tuple[str, ...] | None = None, report_path: str | None = None,
                     requested: DataFrame | None = None, batch_id: str | int | None = None) -> CycleRun:
    """publish every event of the cycle; optionally also store rows (E4),
    the quarantine (F4) and the per-document report (F5). With ``batch_id`` a
    replayed batch replaces what it wrote to files before; a broker's messages
    carry the id as a header instead, so that a consumer can drop repeats."""
    landed, docs = (docs, docs.docs) if isinstance(docs, Landed) else (None, docs)
    cyc = market_cycle(docs, max_weeks, ts, topic, requested)
    cyc.staged.persist()
    try:
        published = None
        if topic_path is not None or topic_format == "kafka":
            count = Observation("published")
            publish_topic(cyc.messages, topic_path, topic_format, topic_options, batch_id, count)
            published = int(count.get["n"])
        sink = None
        if table is not None:
            sink = insert_or_ignore(
                market_store_rows(cyc.observations), table, keys=MARKET_KEYS,
                arrival=["doc_seq", "pos"], columns=MARKET_STORE_COLUMNS, not_null=MARKET_NOT_NULL,
                captured_at=captured_at, partition_by=partition_by, schema=MARKET_TABLE_SCHEMA)
        gone = _unreadable_files(landed, cyc.staged, "market")
        q = cyc.quarantine if gone is None else cyc.quarantine.unionByName(gone)
        n_q = _write_observed(q, "market_quarantine", _side_output(quarantine_path, batch_id)) if quarantine_path else None
        if report_path:
            _side_output(report_path, batch_id)(cyc.report)
        return CycleRun(sink, n_q, published, **_reported(cyc.landed_report, "published"))
    finally:
        cyc.staged.unpersist()

