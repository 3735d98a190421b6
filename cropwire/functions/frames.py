"""DataFrame-level helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def materialize(df: DataFrame, **cols: Column) -> DataFrame:
    """Add ``cols`` evaluated exactly once per row, as plain columns.

    The expressions go through a one-row generator (``inline`` of a
    one-element array). Catalyst cannot fold them into later projections or
    push later filters below it, which would otherwise copy an expensive
    expression (a JSON parse, an array pipeline) into every place that reads
    it, and split one ``from_json`` into one parse per accessed field.
    """
    packed = F.struct(*[c.alias(n) for n, c in cols.items()])
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(packed)))


_KEPT = 64  # sets of expressions kept; the oldest goes first
_EXPRESSIONS: dict = {}


def cached_expressions(key: tuple, build):
    """Build a set of column expressions once per SparkContext and reuse them.

    Column expressions are immutable, unresolved trees; the large array
    pipelines cost about a second of driver time to construct, the same for
    every query and every micro-batch. ``key`` must capture every parameter
    the expressions depend on.
    """
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    # applicationId is unique per context: a stopped and recreated session
    # never receives expressions bound to the old one.
    k = (sc.applicationId if sc is not None else None, *key)
    if k not in _EXPRESSIONS:
        if len(_EXPRESSIONS) >= _KEPT:
            del _EXPRESSIONS[next(iter(_EXPRESSIONS))]
        _EXPRESSIONS[k] = build()
    return _EXPRESSIONS[k]
