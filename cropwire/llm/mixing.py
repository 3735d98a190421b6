"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in a shuffled order that depends on its id and text alone,
gets a virtual finish time: the source's words up to and including it, divided
by the source's weight; its second reading comes one source size later. All
readings of all sources, ranged by finish time, are taken until the budget is
used up. A source that has been read ``epochs`` times has no more readings, so
the others share what it leaves by weight.

No step holds a source in one task: the shuffled order is a hash, its top bits
are the range buckets, and running sums are taken inside a bucket of about
``ROWS_PER_BUCKET`` documents and carried over by a table of bucket sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cropwire.llm.common import WORD, bits_for, cut, offsets, place_of, top_bits

#: Documents of one bucket of the shuffled order.
ROWS_PER_BUCKET = 512
#: Equal rows that are numbered by one step.
COPIES_AT_ONCE = 1024
#: Weights, dealt to the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)


def word_count(text: str) -> Column:
    """Words of a text column; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def content_hash(text: str) -> Column:
    """Hash of a text column, a null text told from an empty one."""
    return F.xxhash64(text, F.col(text).isNull())


def _numbered(sized: DataFrame) -> DataFrame:
    """One row per input row with ``copy``, the number of a row among those equal to it, from 0.

    Equal rows are counted, not gathered, and numbered again in steps that
    Spark deals out, so that many of them are no one task's work.
    """
    keys = sized.columns
    steps = (sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_AT_ONCE}")))).hint("rebalance"))
    first = F.col("step") * COPIES_AT_ONCE
    return steps.select(*keys, F.explode(F.sequence(first, F.least(F.col("n"), first + COPIES_AT_ONCE) - 1)).alias("copy"))


def source_targets(stats: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """One row per source: n, source_size, weight, target, cut_time.

    ``stats`` has (source, n, source_size), one row per source. ``cut_time`` is
    the virtual time at which the capped targets add up to the budget.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    s = (stats.withColumn("weight", F.element_at(dealt, (F.row_number().over(by_name) - 1) % len(weights) + 1))
         .withColumn("cap", F.col("source_size") * float(epochs))
         .withColumn("ends", F.col("cap") / F.col("weight")))
    by_end = Window.orderBy("ends", F.col("source").isNull(), "source")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("ends")
    s = (s.withColumn("budget", F.sum("source_size").over(everything) * share)
         .withColumn("full", F.coalesce(F.sum("cap").over(by_end.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("free", F.sum("weight").over(by_end.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("time", (F.col("budget") - F.col("full")) / F.col("free")))
    # The first source in order of its end that the fluid level does not fill; if all are filled, the last end.
    level = F.coalesce(F.min(F.when(F.col("time") <= F.col("ends"), F.struct("ends", "time"))).over(everything)["time"],
                       F.max("ends").over(everything))
    return (s.withColumn("cut_time", level)
            .withColumn("target", F.least(F.col("weight") * F.col("cut_time"), F.col("cap")))
            .select("source", "n", "source_size", "weight", "target", "cut_time", "budget"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, epochs: int = 2) -> DataFrame:
    """How often each document is read by the mix.

    ``docs`` has doc_id, text and source; other columns are ignored. One row
    per input row: doc_id, source, size (words), source_size, weight, target,
    finish (virtual finish time of its first reading), copies (0 to
    ``epochs``), taken (size x copies), content (a hash of the text).

    A null source is a source of its own, last in order. A null or empty text
    has size 0, takes nothing of the budget and is read with the document before
    it. Rows that repeat an id, null ids included, have places of their own, and so have
    equal rows, by their number. An empty table gives no rows. The order
    depends on ids, texts and these numbers only, so a rerun gives the same mix.
    """
    sized = _numbered(docs.select("doc_id", "source", word_count("text").alias("size"), content_hash("text").alias("content")))
    sized = cut(sized.withColumn("place", place_of("doc_id", "content", "copy")), "mix-sizes")
    stats = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    targets = cut(source_targets(stats, weights, share, epochs), "mix-targets")
    rows = targets.agg(F.sum("n").alias("n"), F.max("cut_time").alias("t"), F.max("budget").alias("b")).first()
    n, cut_time, budget = rows["n"] or 0, rows["t"] or 0.0, rows["b"] or 0.0

    bits = bits_for(n, ROWS_PER_BUCKET)
    sized = sized.withColumn("bucket", top_bits(F.col("place"), bits))
    before = offsets(sized.groupBy("source", "bucket").agg(F.sum("size").alias("size")), ["source"], "bucket", "size", bits)
    peers = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "content", "copy")
    timed = (sized.withColumn("inside", F.sum("size").over(peers)).alias("d")
             .join(before.alias("o"), F.col("d.source").eqNullSafe(F.col("o.source")) & (F.col("d.bucket") == F.col("o.bucket")))
             .select("d.doc_id", "d.source", "d.size", "d.content", (F.col("inside") + F.col("before")).alias("words")))
    timed = (timed.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
             .select("d.*", "source_size", "weight", "target", (F.col("words") / F.col("weight")).alias("finish")))
    timed = cut(timed, "mix-times")
    last = _truncate(timed, n * epochs, cut_time, budget, epochs) if cut_time > 0 else -1.0
    copies = sum((_finish(e) <= last).cast("int") for e in range(epochs))
    return timed.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies")).drop("words")


def _finish(epoch: int):
    """Virtual finish time of a document's reading number ``epoch``."""
    return (F.col("words") + F.col("source_size") * epoch) / F.col("weight")


def _truncate(timed: DataFrame, n: int, cut_time: float, budget: float, epochs: int) -> float:
    """The latest finish time so that all readings up to it fit the budget.

    Range partition by finish time: bucket sums find the bucket in which the
    budget ends, and only that bucket is sorted.
    """
    bits = bits_for(n, ROWS_PER_BUCKET)
    reading = F.explode(F.array(*[_finish(e) for e in range(epochs)]))
    # Beyond twice the expected end lie readings that no budget reaches.
    step = 2.0 * cut_time / (1 << bits)
    readings = (timed.select("size", reading.alias("finish"))
                .withColumn("bucket", F.least((F.col("finish") / step).cast("long"), F.lit(1 << bits))))
    sums = readings.groupBy("bucket").agg(F.sum("size").alias("size"))
    ends = (offsets(sums.withColumn("all", F.lit(0)), ["all"], "bucket", "size", bits)
            .filter(F.col("before") <= budget).agg(F.max(F.struct("bucket", "before")).alias("x")).first()["x"])
    inside = (readings.filter(F.col("bucket") == ends["bucket"]).groupBy("finish").agg(F.sum("size").alias("size"))
              .withColumn("upto", F.sum("size").over(Window.orderBy("finish"))))
    got = inside.filter(F.col("upto") + F.lit(ends["before"]) <= budget).agg(F.max("finish")).first()[0]
    return got if got is not None else ends["bucket"] * step - 1e-12 * cut_time


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    from cropwire.llm.common import read_table
    return (mix_sources(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "finish"))
