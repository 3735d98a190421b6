"""Market documents to weekly price observations.

A document is all-or-nothing: one unreadable entry among the first N aborts
the symbol, entries past N are never looked at. Everything is decided on the
array inside the row before anything is exploded; no shuffle, no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropwire.functions.dates import strict_iso_date, utc_midnight
from cropwire.functions.frames import cached_expressions, materialize
from cropwire.functions.json import LENIENT, has_top_key, last_wins_entries, let, parse_whole
from cropwire.functions.numbers import is_finite, read_double, read_long
from cropwire.schemas import (
    MARKET_ENTRY_SCHEMA, MARKET_ERROR_KEY, MARKET_FIELDS, MARKET_JSON_SCHEMA, MARKET_MAX_WEEKS,
    MARKET_NOTE_KEY, MARKET_SERIES_KEY, MARKET_SERIES_TEXT_SCHEMA,
)

_DOUBLES = {"open": MARKET_FIELDS[0], "high": MARKET_FIELDS[1], "low": MARKET_FIELDS[2],
            "close": MARKET_FIELDS[3], "adjusted_close": MARKET_FIELDS[4],
            "dividend_amount": MARKET_FIELDS[6]}
_VOLUME = MARKET_FIELDS[5]
ROW_FIELDS = ["pos", "week", "price_date", "price_timestamp", "open", "high", "low", "close",
              "adjusted_close", "volume", "dividend_amount"]


def parse_market(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse every document once into column ``doc``."""
    return docs.withColumn("doc", parse_whole(F.col(raw), MARKET_JSON_SCHEMA))


def _first_n(max_weeks: int | Column | None):
    if max_weeks is None:  # the whole series (C4 without C5)
        return lambda entries: entries
    n = F.greatest(F.lit(max_weeks) if isinstance(max_weeks, int) else max_weeks, F.lit(0))
    return lambda entries: F.slice(entries, 1, n)


def unquoted_volumes(raw: Column, entries: Column, max_weeks: int | Column | None) -> Column:
    """Per entry, whether its volume is an unquoted number; NULL unless some volume is a number but no whole one.

    Text and number read alike in the typed parse. Only a document that holds
    such a volume is read again, entry by entry.
    """
    odd = F.exists(entries, lambda e: e["value"][_VOLUME].isNotNull() & read_long(e["value"][_VOLUME]).isNull()
                   & e["value"][_VOLUME].try_cast("double").isNotNull())
    numbers = let(F.from_json(raw, MARKET_SERIES_TEXT_SCHEMA, LENIENT)[MARKET_SERIES_KEY], lambda m: F.transform(
        _first_n(max_weeks)(last_wins_entries(m)),
        lambda e: F.from_json(e["value"], f"`{_VOLUME}` DOUBLE", LENIENT)[_VOLUME].isNotNull()))
    return F.when(odd, numbers)


def _volume(text: Column, unquoted: Column) -> Column:
    """A quoted volume is read strictly, an unquoted number is cut to a whole one (``12.7`` and ``1e3`` are read)."""
    return F.coalesce(read_long(text), F.when(unquoted, text.try_cast("decimal(38,9)").try_cast("bigint")))


def market_entries(raw: Column, doc: Column, max_weeks: int | Column | None = MARKET_MAX_WEEKS) -> Column:
    """The first N series entries in document order, duplicate dates folded.

    Fast path: the typed parse. If one entry is not an object the typed map is
    NULL as a whole; only then the series is re-read as raw text and just the
    first N entries are parsed, so that entries past N stay unexamined.
    NULL when there is no series object.
    """
    first_n = _first_n(max_weeks)
    typed = doc[MARKET_SERIES_KEY]
    fast = first_n(last_wins_entries(typed))
    slow = let(F.from_json(raw, MARKET_SERIES_TEXT_SCHEMA, LENIENT)[MARKET_SERIES_KEY], lambda m: F.transform(
        first_n(last_wins_entries(m)),
        lambda e: F.struct(e["key"].alias("key"), F.from_json(e["value"], MARKET_ENTRY_SCHEMA, LENIENT).alias("value"))))
    return F.when(typed.isNotNull(), fast).otherwise(slow)


def market_rows(entries: Column, unquoted: Column | None = None) -> Column:
    """Typed rows; a NULL field marks an unreadable entry. ``unquoted``: from ``unquoted_volumes``."""
    unquoted = F.lit(None).cast("array<boolean>") if unquoted is None else unquoted
    return F.transform(entries, lambda e, i: F.struct(
        i.alias("pos"),
        e["key"].alias("week"),
        strict_iso_date(e["key"]).alias("price_date"),
        *[read_double(e["value"][f]).alias(name) for name, f in list(_DOUBLES.items())[:5]],
        _volume(e["value"][_VOLUME], F.coalesce(F.try_element_at(unquoted, i + 1), F.lit(False))).alias("volume"),
        read_double(e["value"][_DOUBLES["dividend_amount"]]).alias("dividend_amount"),
    ))


def _row_is_bad(r: Column) -> Column:
    bad = r["price_date"].isNull() | r["volume"].isNull()
    for name in _DOUBLES:
        bad = bad | r[name].isNull()
    return bad


def _row_not_finite(r: Column) -> Column:
    ok = F.lit(True)
    for name in _DOUBLES:
        ok = ok & is_finite(r[name])
    return ~ok


def _stage_expressions(raw: str, max_weeks: int | Column | None, has_prior: bool) -> dict[str, Column]:
    prior = F.col("fault") if has_prior else F.lit(None).cast("string")
    r = F.col(raw)
    doc = F.col("doc")
    gate = (F.when(F.col("fault").isNotNull(), F.col("fault"))
            .when(doc.isNull(), F.lit("unparsable"))
            .when(has_top_key(r, doc[MARKET_ERROR_KEY], MARKET_ERROR_KEY), F.lit("provider_error"))
            .when(has_top_key(r, doc[MARKET_NOTE_KEY], MARKET_NOTE_KEY), F.lit("provider_note")))
    g = F.col("fault")
    rows = F.col("rows")
    good = F.when(F.col("fault").isNull(), rows)
    first_bad = F.array_position(F.transform(good, _row_not_finite), True)
    return {
        "prior": prior,
        "doc": F.when(prior.isNull(), parse_whole(r, MARKET_JSON_SCHEMA)),
        "gate": gate,
        "entries": F.when(g.isNull(), market_entries(r, doc, max_weeks)),
        "unquoted": unquoted_volumes(r, F.col("entries"), max_weeks),
        "rows": market_rows(F.col("entries"), F.col("unquoted")),
        "fault": (F.when(g.isNotNull(), g)
                  .when(rows.isNull(), F.lit("missing_series"))
                  .when(F.exists(rows, _row_is_bad), F.lit("bad_entry"))),
        "detail": (F.when(g == "provider_error", doc[MARKET_ERROR_KEY])
                   .when(g == "provider_note", doc[MARKET_NOTE_KEY])),
        "good": good,
        "publishable": F.when(first_bad > 0, F.slice(good, 1, first_bad - 1)).otherwise(good),
        "publish_fault": F.when(first_bad > 0, F.lit("non_finite")),
    }


def stage_market(docs: DataFrame, max_weeks: int | Column | None = MARKET_MAX_WEEKS, raw: str = "raw") -> DataFrame:
    """Parse, gate and type every document; one row per document.

    Adds ``fault`` / ``detail`` (C1-C3, C8; NULL when usable), ``rows`` (the
    typed first-N rows of a usable document) and ``publishable`` (the rows
    before the first non-finite price, which a strict JSON encoder refuses),
    with ``publish_fault``. An existing ``fault`` column takes precedence and
    skips the parse. The document is parsed once.
    """
    has_prior = "fault" in docs.columns

    def build():
        return _stage_expressions(raw, max_weeks, has_prior)

    if isinstance(max_weeks, Column):
        e = build()
    else:
        e = cached_expressions(("stage_market", raw, max_weeks, has_prior), build)
    parsed = materialize(docs, fault=e["prior"], doc=e["doc"])
    gated = materialize(parsed, fault=e["gate"])
    entries = materialize(materialize(gated, entries=e["entries"]), unquoted=e["unquoted"])
    typed = materialize(entries, rows=e["rows"]).drop("entries", "unquoted")
    checked = materialize(typed, fault=e["fault"], detail=e["detail"])
    out = materialize(checked, rows=e["good"], publishable=e["publishable"], publish_fault=e["publish_fault"])
    return out.drop("doc")


def _explode_rows(staged: DataFrame, array_col: str, key: str, carry: tuple[str, ...]) -> DataFrame:
    out = staged.select(F.col(key).alias("symbol"), *carry, F.inline(array_col))
    return out.withColumn("price_timestamp", utc_midnight(F.col("price_date")))


def market_observations(staged: DataFrame, key: str = "symbol", carry: tuple[str, ...] = (),
                        publishable_only: bool = False) -> DataFrame:
    """Observation rows ``symbol, price_timestamp, open .. dividend_amount``.

    Internal columns ``pos`` (document order), ``week`` and ``price_date`` and
    any ``carry`` columns are kept for arrival order and text rendering.
    """
    col = "publishable" if publishable_only else "rows"
    out = _explode_rows(staged, col, key, carry)
    return out.select("symbol", "price_timestamp", "open", "high", "low", "close", "adjusted_close",
                      "volume", "dividend_amount", *carry, "pos", "week", "price_date")


def market_ordered_weeks(staged: DataFrame, key: str = "symbol") -> DataFrame:
    """C4: ``(symbol, pos, week)`` in document order."""
    return staged.select(key, F.inline("rows")).select(key, "pos", "week")
