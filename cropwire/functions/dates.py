"""Date and instant helpers that do not depend on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def compact_date(d: Column) -> Column:
    """DATE to ``yyyyMMdd`` text."""
    return F.date_format(d, "yyyyMMdd")


def date_window(as_of: Column, days: int = 30) -> Column:
    """Trailing window of ``days`` days ending at ``as_of`` (inclusive), as text."""
    return F.struct(
        compact_date(F.date_sub(as_of, days - 1)).alias("start_date"),
        compact_date(as_of).alias("end_date"),
    )


def strict_iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` only; ``2024-1-5``, ``2024`` and ``2024-02-30`` give NULL."""
    return F.when(text.rlike(_ISO_DATE), F.try_to_date(text, "yyyy-MM-dd"))


def utc_midnight(d: Column) -> Column:
    """Start of day ``d`` in UTC as an instant, whatever the session zone."""
    return F.timestamp_seconds(F.unix_date(d).cast("bigint") * F.lit(86400))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def iso_midnight_text(d: Column) -> Column:
    """``2024-03-01T00:00:00Z`` for DATE ``2024-03-01``."""
    return F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T00:00:00Z"))


def iso_instant(ts: Column) -> Column:
    """Instant as ISO-8601 UTC text with ``Z``; fraction only when non-zero.

    Computed from epoch arithmetic so that the session time zone plays no part.
    """
    micros = F.unix_micros(ts)
    day = F.floor(micros / F.lit(86_400_000_000))
    in_day = micros - day * F.lit(86_400_000_000)
    secs = F.floor(in_day / F.lit(1_000_000))
    frac = in_day - secs * F.lit(1_000_000)

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    fraction = (
        F.when(frac == 0, F.lit(""))
        .when(frac % 1000 == 0, F.concat(F.lit("."), F.lpad((frac / 1000).cast("bigint").cast("string"), 3, "0")))
        .otherwise(F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0")))
    )
    return F.concat(
        F.date_format(F.date_from_unix_date(day.cast("int")), "yyyy-MM-dd"), F.lit("T"),
        two(F.floor(secs / 3600)), F.lit(":"), two(F.floor((secs % 3600) / 60)), F.lit(":"),
        two(secs % 60), fraction, F.lit("Z"),
    )


def utc_now_iso(now: _dt.datetime | None = None) -> str:
    """Driver-side 'now' as ISO-8601 UTC text, taken once per batch.

    The fraction is printed only when non-zero, as milliseconds when that is
    exact, else microseconds (the form of an ISO instant's text).
    """
    now = (now or _dt.datetime.now(_dt.timezone.utc)).astimezone(_dt.timezone.utc)
    base = now.strftime("%Y-%m-%dT%H:%M:%S")
    us = now.microsecond
    if us == 0:
        return base + "Z"
    if us % 1000 == 0:
        return f"{base}.{us // 1000:03d}Z"
    return f"{base}.{us:06d}Z"
