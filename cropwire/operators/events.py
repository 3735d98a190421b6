"""Events and the topic sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cropwire.functions.dates import utc_now_iso
from cropwire.schemas import EVENT_SOURCE, TOPIC

JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX", "timeZone": "UTC"}

#: Characters that the encoder escapes besides those that JSON asks for.
HTML_UNSAFE = "<>&='\u2028\u2029"


def market_events(observations: DataFrame, ts: str | None = None, source: str = EVENT_SOURCE) -> DataFrame:
    """One envelope per observation: ``ts``, ``ss`` and ``data`` (camelCase).

    ``ts`` is taken once per batch (the driver's 'now' unless given); other
    columns of ``observations`` are carried next to ``event``.
    """
    ts = ts or utc_now_iso()
    data = F.struct(
        F.col("symbol").alias("symbol"), F.col("price_timestamp").alias("priceTimestamp"),
        F.col("open").alias("open"), F.col("high").alias("high"), F.col("low").alias("low"),
        F.col("close").alias("close"), F.col("adjusted_close").alias("adjustedClose"),
        F.col("volume").alias("volume"), F.col("dividend_amount").alias("dividendAmount"))
    event = F.struct(F.lit(ts).alias("ts"), F.lit(source).alias("ss"), data.alias("data"))
    return observations.select(event.alias("event"), *observations.columns)


def event_json(events: DataFrame) -> DataFrame:
    """D3: the envelope as JSON text; instants as ISO UTC text without fraction.

    Characters that mean something in HTML are written as escapes (``ZC=F`` as
    ``ZC\\u003dF``); they only occur inside strings, so any JSON reader gives them back.
    """
    value = F.to_json(F.col("event"), JSON_OPTIONS)
    for c in HTML_UNSAFE:
        value = F.replace(value, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return events.withColumn("value", value)


#: The order of a symbol's messages: its documents as they came, then the place in the document.
ARRIVAL = ["doc_seq", "pos"]


def topic_messages(events: DataFrame, topic: str = TOPIC) -> DataFrame:
    """D4 rows ``(topic, key, doc_seq, pos, value)``: one text message per event, no de-duplication.

    ``key`` is the event's symbol; ``doc_seq`` and ``pos`` (0 where ``events`` has none) say in which order its messages go out.
    """
    if "value" not in events.columns:
        events = event_json(events)
    order = [(F.col(c) if c in events.columns else F.lit(0)).cast(t).alias(c) for c, t in zip(ARRIVAL, ("bigint", "int"))]
    return events.select(F.lit(topic).alias("topic"), F.col("event.data.symbol").alias("key"), *order, F.col("value"))


def broker_rows(messages: DataFrame, batch_id: str | int | None = None) -> DataFrame:
    """Rows for the Kafka writer: ``topic, key, value`` and, with ``batch_id``, ``headers``.

    A broker keeps the order of one key and deals keys to its partitions. So
    all messages of a symbol are written by one task in arrival order, and the
    symbols spread evenly over tasks and broker partitions. A broker keeps what
    a replay sends again; the batch id in the headers lets a consumer drop it.
    """
    rows = messages.repartition("topic", "key").sortWithinPartitions("topic", "key", *ARRIVAL)
    columns = ["topic", "key", "value"]
    if batch_id is not None:
        header = F.struct(F.lit("batch_id").alias("key"), F.encode(F.lit(str(batch_id)), "UTF-8").alias("value"))
        rows = rows.withColumn("headers", F.array(header))
        columns.append("headers")
    return rows.select(*columns)


def publish_topic(messages: DataFrame, target: str | None, fmt: str = "parquet", options: dict | None = None,
                  batch_id: str | int | None = None, observation: Observation | None = None) -> None:
    """Append messages to a topic sink, in order; ``observation`` gets their number as ``n``.

    Default: files partitioned by ``topic`` (one row per message). Files in the
    order of their names, and rows in them, are in the order of a run: documents as
    they came, then places. The sort deals ranges of that order to tasks, so a
    symbol with most of the messages is split too. With ``batch_id`` the files of a batch lie in a
    folder of their own, which a replay of the batch replaces. ``fmt='kafka'``
    writes ``broker_rows`` when the Kafka connector is on the
    classpath (``options`` carries ``kafka.bootstrap.servers``).
    """
    folders = {"topic": None} if batch_id is None else {"topic": None, "batch_id": F.lit(str(batch_id))}
    if fmt == "kafka":
        rows = broker_rows(messages, batch_id)
    else:
        rows = messages.withColumns({k: v for k, v in folders.items() if v is not None})
        rows = rows.orderBy(ARRIVAL[0], "key", *ARRIVAL[1:])
    if observation is not None:  # behind the sort, whose sampling reads its input once more
        rows = rows.observe(observation, F.count(F.lit(1)).alias("n"))
    if fmt == "kafka":
        # The Kafka writer takes the destination from the ``topic`` column.
        rows.write.format("kafka").options(**(options or {})).save()
    elif batch_id is None:
        rows.write.mode("append").partitionBy("topic").format(fmt).save(target)
    else:
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("topic", "batch_id").format(fmt).save(target))


def read_topic(spark, target: str, topic: str = TOPIC, fmt: str = "parquet") -> DataFrame:
    """Read a topic back from the file sink (partition pruned on ``topic``)."""
    return spark.read.format(fmt).load(target).filter(F.col("topic") == topic)
