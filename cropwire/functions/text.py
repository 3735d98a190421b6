"""String helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(s: Column, sep: str = ",") -> Column:
    """Split like ``String.split(sep)``: inner empty items stay, trailing ones go.

    Spark's ``split`` keeps trailing empties, hence the strip first. An empty
    input gives one empty item; an input made only of separators gives none.
    """
    esc = re.escape(sep)
    stripped = F.regexp_replace(s, f"(?:{esc})+$", "")
    return (
        F.when(s == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, esc))
    )
