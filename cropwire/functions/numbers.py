"""Numeric reads that never raise, and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_double(text: Column) -> Column:
    """JSON leaf text to double; unreadable text gives NULL instead of an error.

    Of the words for non-finite numbers only ``NaN`` and ``Infinity`` are read,
    in exactly this spelling; Spark's cast knows more (``inf``, ``nan``, ...).
    """
    word = F.lower(text).contains("n") & ~text.rlike(r"^\s*[+-]?(NaN|Infinity)\s*$")
    return F.when(~word, text.try_cast("double"))


def read_long(text: Column) -> Column:
    """Strict integer read: ``'12.0'`` and ``' 12 '`` are NULL, like a strict long parse of a JSON string."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def fill_to_nan(value: Column, fill: Column) -> Column:
    """NaN where ``value`` equals the fill value bit for bit; the row is kept.

    SQL ``=`` says ``-0.0 = 0.0``; the text comparison separates the two, so
    ``-0.0`` is not replaced when the fill is ``0.0``.
    """
    same = fill.isNotNull() & (value == fill) & (value.cast("string") == fill.cast("string"))
    return F.when(same, F.lit(float("nan"))).otherwise(value)


def nan_to_null(value: Column) -> Column:
    """NaN stored as NULL (what a nullable REAL column keeps)."""
    return F.nanvl(value, F.lit(None).cast("double"))


def is_finite(value: Column) -> Column:
    """Neither NaN nor +/- infinity (NULL for NULL)."""
    return ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
