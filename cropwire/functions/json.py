"""JSON helpers on top of ``from_json`` results."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable.

    Catalyst may inline a projected expression into a higher-order lambda,
    where it would be re-evaluated for every array element. Binding it through
    a one-element ``transform`` keeps it a single evaluation.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def group_heads(sorted_arr: Column, key: str = "key") -> Column:
    """Elements of a key-sorted array whose key differs from the previous one."""
    return let(sorted_arr, lambda arr: F.filter(arr, lambda e, i: F.when(i == 0, F.lit(True)).otherwise(
        F.element_at(arr, i)[key] != e[key])))


def last_wins_entries(m: Column) -> Column:
    """Map entries with duplicate keys folded: first position, last value.

    ``from_json`` keeps every duplicate key of an object and map lookup returns
    the first one; a JSON object model keeps the last value at the position of
    the first occurrence. Only maps that do carry duplicates pay for the fold,
    which sorts ``(key, position)`` pairs both ways (O(n log n)): the head of
    each key group is its first position in one order, its last in the other.
    """
    keys = F.map_keys(m)
    firsts = group_heads(F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("key"), i.alias("pos")))))
    lasts = group_heads(F.array_sort(F.transform(keys, lambda k, i: F.struct(k.alias("key"), (-i).alias("pos")))))
    folded = let(F.struct(F.map_values(m).alias("v"), lasts.alias("l")), lambda b: F.transform(
        F.array_sort(F.transform(firsts, lambda f, j: F.struct(
            f["pos"].alias("pos"), f["key"].alias("key"),
            F.element_at(b["v"], -F.element_at(b["l"], j + 1)["pos"] + 1).alias("value")))),
        lambda r: F.struct(r["key"].alias("key"), r["value"].alias("value"))))
    return F.when(F.size(F.array_distinct(keys)) == F.size(m), F.map_entries(m)).otherwise(folded)


def last_wins_map(m: Column) -> Column:
    """``m`` itself when its keys are distinct, else the folded map."""
    keys = F.array_distinct(F.map_keys(m))
    return F.when(F.size(keys) == F.size(m), m).otherwise(F.map_from_entries(last_wins_entries(m)))


_END = "__end"

#: The lenient JSON that the feeds' documents may use: bare names, comments, raw line breaks in strings, any escaped character, leading zeros.
LENIENT = {"allowUnquotedFieldNames": "true", "allowComments": "true", "allowUnquotedControlChars": "true",
           "allowBackslashEscapingAnyCharacter": "true", "allowNumericLeadingZeros": "true"}


def parse_whole(raw: Column, schema: str) -> Column:
    """``from_json`` of the whole text: NULL unless ``raw`` is one JSON object and nothing else.

    The plain parser stops behind the first value and accepts any text after
    it. Here the text stands in an array before a closing mark, which is only
    reached if the text is exactly one value; one parse does both. The mark is
    the text's own digest, so that no text can bring it along. A line break before it ends a line comment.
    """
    mark = F.sha2(raw, 256)
    wrapped = F.concat(F.lit("["), raw, F.lit(f'\n,{{"{_END}":"'), mark, F.lit('"}]'))
    fields = T.StructType.fromDDL(schema).fields
    parsed = F.from_json(wrapped, T.ArrayType(T.StructType([*fields, T.StructField(_END, T.StringType())])), LENIENT)
    return let(F.struct(parsed.alias("a"), mark.alias("m")), lambda b: F.when(
        (F.size(b["a"]) == 2) & (F.try_element_at(b["a"], F.lit(2))[_END] == b["m"]), F.try_element_at(b["a"], F.lit(1))))


def has_top_key(raw: Column, parsed_value: Column, key: str) -> Column:
    """Presence of a top-level key, including a key whose value is JSON null.

    ``parsed_value`` is the field as parsed by ``from_json``; non-null means
    present. Otherwise the key can only be there if its text (or a unicode
    escape) occurs in the document, and only then are the keys listed.
    """
    maybe = (F.instr(raw, key) > 0) | (F.instr(raw, "\\u") > 0)
    # Keys of lenient texts cannot be listed; a member that the parse gave no value can only be a null one.
    named_null = raw.rlike(rf"""(["']?)\b{re.escape(key)}\1\s*:\s*null\b""")
    listed = F.coalesce(F.array_contains(F.json_object_keys(raw), F.lit(key)), named_null, F.lit(False))
    return (
        F.when(parsed_value.isNotNull(), F.lit(True))
        .when(raw.isNull() | ~maybe, F.lit(False))
        .otherwise(listed)
    )
