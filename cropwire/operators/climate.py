"""Climate documents to daily observations.

All work on one document happens inside its row with higher-order array
functions: the four date-keyed series are aligned, typed and filtered as one
array of day structs, and only the surviving days are exploded. No shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropwire.functions.frames import cached_expressions, materialize
from cropwire.functions.json import last_wins_map, let, parse_whole
from cropwire.functions.numbers import fill_to_nan, read_double
from cropwire.schemas import CLIMATE_JSON_SCHEMA, CLIMATE_SERIES

VALUE_COLUMNS = ["precipitation", "root_zone_soil_wetness", "temperature_max", "temperature_min"]
_SHORT = ["p", "g", "x", "n"]


def parse_climate(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """B1: parse every document once into column ``doc`` (never raises); NULL unless the text is one object."""
    return docs.withColumn("doc", parse_whole(F.col(raw), CLIMATE_JSON_SCHEMA))


def climate_fault(doc: Column) -> Column:
    """Reason a document yields no rows, in the order the checks run.

    ``unparsable`` (not a JSON object), ``missing_properties``,
    ``missing_parameter`` (each must be an object), ``missing_series`` (one of
    the four series absent or not an object). NULL for a usable document.
    """
    props = doc["properties"]
    param = props["parameter"]
    series_missing = F.lit(False)
    for s in CLIMATE_SERIES:
        series_missing = series_missing | param[s].isNull()
    return (
        F.when(doc.isNull(), F.lit("unparsable"))
        .when(props.isNull(), F.lit("missing_properties"))
        .when(param.isNull(), F.lit("missing_parameter"))
        .when(series_missing, F.lit("missing_series"))
    )


def climate_fill_value(doc: Column) -> Column:
    """``header.fill_value`` as double; absent or unreadable gives NULL."""
    return read_double(doc["header"]["fill_value"])


def _merge_by_key(s: Column) -> Column:
    """Align four maps by key with one sort instead of per-date lookups.

    All entries, tagged with their series index, are sorted by (key, index);
    a date of the first series finds the other three values among the next
    three elements (each series holds a key at most once). O(n log n).
    """
    def tag(j: int):
        return lambda e: F.struct(e["key"].alias("key"), F.lit(j).alias("idx"), e["value"].alias("value"))

    tagged = F.concat(*[F.transform(F.map_entries(s[c]), tag(j)) for j, c in enumerate(_SHORT)])

    def pick(srt: Column, i: Column, key: Column, idx: int) -> Column:
        out = None
        for t in (1, 2, 3):
            nxt = F.try_element_at(srt, i + F.lit(1 + t))
            hit = nxt.isNotNull() & (nxt["key"] == key) & (nxt["idx"] == idx)
            out = F.when(hit, nxt["value"]) if out is None else out.when(hit, nxt["value"])
        return out

    return let(F.array_sort(tagged), lambda srt: F.transform(
        F.filter(F.transform(srt, lambda e, i: F.struct(
            e["key"].alias("date"), e["idx"].alias("idx"), e["value"].alias("p"),
            *[pick(srt, i, e["key"], j).alias(c) for j, c in enumerate(_SHORT) if j > 0])),
            lambda r: r["idx"] == 0),
        lambda r: F.struct(r["date"].alias("date"), *[r[c].alias(c) for c in _SHORT])))


def _aligned_rows(s: Column) -> Column:
    """One struct per date of the first series, values of all four as text.

    When the four series list the same dates in the same order (what a
    provider normally returns) values are zipped by position in O(n); other
    documents are aligned by a sort-merge on the date key.
    """
    p, g, x, n = (s[c] for c in _SHORT)
    keys = F.map_keys(p)
    aligned = (keys == F.map_keys(g)) & (keys == F.map_keys(x)) & (keys == F.map_keys(n))
    by_pos = F.transform(keys, lambda k, i: F.struct(
        k.alias("date"),
        *[F.element_at(F.map_values(s[c]), i + 1).alias(c) for c in _SHORT]))
    return F.when(aligned, by_pos).otherwise(_merge_by_key(s))


def _typed_days(s: Column) -> Column:
    """Completeness, per-day numeric read and fill to NaN.

    ``complete``: the date is present and not JSON null in all four series.
    ``bad``: complete, but one value is unreadable (that day only is dropped).
    """
    read = F.transform(_aligned_rows(s), lambda r: F.struct(
        r["date"].alias("date"),
        (r["p"].isNotNull() & r["g"].isNotNull() & r["x"].isNotNull() & r["n"].isNotNull()).alias("complete"),
        *[read_double(r[c]).alias(c) for c in _SHORT]))
    fill = s["fill"]
    return F.transform(read, lambda r: F.struct(
        r["date"].alias("date"),
        r["complete"].alias("complete"),
        (r["complete"] & (r["p"].isNull() | r["g"].isNull() | r["x"].isNull() | r["n"].isNull())).alias("bad"),
        *[fill_to_nan(r[c], fill).alias(v) for c, v in zip(_SHORT, VALUE_COLUMNS)],
        # which series could not be read on a bad day (text present, number not)
        F.when(r["complete"], F.concat_ws(",", *[F.when(r[c].isNull(), F.lit(name))
                                               for c, name in zip(_SHORT, CLIMATE_SERIES)])).alias("unreadable")))


def climate_days(doc: Column, fill: Column) -> Column:
    """All dates of the first series as day structs, date text descending."""
    param = doc["properties"]["parameter"]
    bound = F.struct(*[last_wins_map(param[s]).alias(c) for s, c in zip(CLIMATE_SERIES, _SHORT)],
                     fill.alias("fill"))
    return let(bound, lambda s: F.sort_array(_typed_days(s), asc=False))


def _stage_expressions(raw: str, has_prior: bool) -> dict[str, Column]:
    prior = F.col("fault") if has_prior else F.lit(None).cast("string")
    doc = F.col("doc")
    return {
        "prior": prior,
        "doc": F.when(prior.isNull(), parse_whole(F.col(raw), CLIMATE_JSON_SCHEMA)),
        "fault": F.coalesce(F.col("fault"), climate_fault(doc)),
        "fill_value": climate_fill_value(doc),
        "messages": doc["messages"],
        "days": F.when(F.col("fault").isNull(), climate_days(doc, F.col("fill_value"))),
    }


def _gated(docs: DataFrame, raw: str) -> tuple[DataFrame, dict[str, Column]]:
    has_prior = "fault" in docs.columns
    e = cached_expressions(("stage_climate", raw, has_prior), lambda: _stage_expressions(raw, has_prior))
    parsed = materialize(docs, fault=e["prior"], doc=e["doc"])
    return materialize(parsed, fault=e["fault"], fill_value=e["fill_value"], messages=e["messages"]), e


def gate_climate(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse and gate every document, without its days: adds ``fault``, ``fill_value`` and ``messages``."""
    return _gated(docs, raw)[0].drop("doc")


def stage_climate(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse and gate every document; one row per document.

    Adds ``fault`` (NULL when usable), ``fill_value``, ``messages`` and
    ``days`` (NULL for a faulty document). Any existing ``fault`` column (set
    by earlier gates, e.g. unknown producer or HTTP status) takes precedence
    and skips the parse. The document is parsed once.
    """
    gated, e = _gated(docs, raw)
    return materialize(gated, days=e["days"]).drop("doc")


def climate_messages(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Provider messages, one row each; not an array gives no rows."""
    return staged.select(key, F.explode("messages").alias("message"))


def climate_aligned_days(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Every date of the first series with its verdicts and the values found there."""
    return staged.select(key, F.inline("days")).select(key, "date", "complete", "bad", *VALUE_COLUMNS)


def climate_complete_days(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Dates present and non-null in all four series."""
    return climate_aligned_days(staged, key).filter("complete").select(key, "date")


def climate_incomplete_days(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Dates of the first series dropped for a missing or null value."""
    return climate_aligned_days(staged, key).filter("NOT complete").select(key, "date")


def climate_bad_days(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Complete dates dropped because a value could not be read as a number."""
    return climate_aligned_days(staged, key).filter("bad").select(key, "date")


def kept_days(days: Column) -> Column:
    """Days that become observations, still date-descending."""
    return F.filter(days, lambda d: d["complete"] & ~d["bad"])


def climate_ordered_days(staged: DataFrame, key: str = "producer_id") -> DataFrame:
    """Kept days with ``pos``, their position in date-descending order."""
    return staged.select(key, F.posexplode(kept_days(F.col("days"))).alias("pos", "d")).select(
        key, F.col("d.date").alias("date"), "pos", *[F.col(f"d.{v}").alias(v) for v in VALUE_COLUMNS])


def climate_observations(staged: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Observation rows (dimension columns must already be on ``staged``).

    ``carry`` names extra columns kept for arrival order (e.g. ``doc_seq``);
    ``pos`` is always kept.
    """
    exploded = staged.select(
        "producer_id", "producer_name", "commodity_type", *carry,
        F.posexplode(kept_days(F.col("days"))).alias("pos", "d"))
    return exploded.select(
        "producer_id", "producer_name", "commodity_type", F.col("d.date").alias("date"),
        *[F.col(f"d.{v}").alias(v) for v in VALUE_COLUMNS], *carry, "pos")
