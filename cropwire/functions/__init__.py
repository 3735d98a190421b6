"""Column-level building blocks (pure ``Column -> Column`` functions, JVM-side)."""

from cropwire.functions.dates import (
    compact_date, date_window, epoch_seconds, iso_instant, iso_midnight_text,
    strict_iso_date, utc_midnight, utc_now_iso,
)
from cropwire.functions.json import has_top_key, last_wins_entries, last_wins_map, let, parse_whole
from cropwire.functions.numbers import fill_to_nan, is_finite, nan_to_null, read_double, read_long
from cropwire.functions.text import java_split

__all__ = [
    "compact_date", "date_window", "epoch_seconds", "iso_instant", "iso_midnight_text",
    "strict_iso_date", "utc_midnight", "utc_now_iso", "has_top_key", "parse_whole",
    "last_wins_entries", "last_wins_map", "let", "fill_to_nan", "is_finite", "nan_to_null",
    "read_double", "read_long", "java_split",
]
