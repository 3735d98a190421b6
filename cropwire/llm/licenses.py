"""License scan: ordered signature rules behind a keyword prefilter, overlaps settled by priority and containment.

DataFrame functions only, no shuffle: every text is scanned in its own row. Words
carry their numbers (``12:under 13:the``), so that what a rule's regular
expression finds says where it stands.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cropwire.functions.frames import materialize
from cropwire.functions.json import let
from cropwire.llm.common import read_table
from cropwire.llm.license_rules import BASE, CERTAINTY, Rule, all_rules

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Detections folded at a time; their kept ones are appended as one list, so that the fold stays linear.
_BLOCK = 128
#: Sorted in this order, a detection stands behind all that contain it; ``left`` is minus the number of its last word.
_FOUND = "array<struct<first: bigint, left: bigint, kind: int, rank: int, label: string>>"


def regex(pattern: str) -> str:
    """The regular expression of a rule's pattern over numbered words."""
    out = ""
    for i, word in enumerate(pattern.split()):
        if word.startswith("*"):
            out += rf"(?: [^ ]+){{0,{word[1:]}}}?"
        elif word.startswith("~"):
            out += rf"(?: \d+:(?:{word[1:]})(?![^ ]))?"
        else:
            out += rf"{' ' if i else '(?<![^ ])'}\d+:(?:{word})(?![^ ])"
    return out


def _table(rules: Sequence[Rule]) -> Column:
    """The rules as one constant: an array of (keyword, its rules)."""
    of: dict[str, list[Rule]] = {}
    for r in rules:
        of.setdefault(r.keyword, []).append(r)
    made = [{"keyword": k, "rules": [{"rank": r.rank, "kind": r.kind, "label": r.label, "regex": regex(r.pattern), "needs": r.needs} for r in rs]} for k, rs in of.items()]
    # Spark folds this to a constant; one expression for each rule would cost seconds of planning.
    return F.from_json(F.lit(json.dumps(made)), "array<struct<keyword: string, rules: array<struct<rank: int, kind: int, label: string, regex: string, needs: array<string>>>>>")


def _open(words: Column, rules: Sequence[Rule]) -> Column:
    """The keyword prefilter: the rules all of whose needed words are among ``words``."""
    known = F.array(*[F.lit(w) for w in sorted({"licence"} | {w for r in rules for w in r.needs})])
    british = F.transform(F.array_intersect(words, known), lambda w: F.when(w == "licence", F.lit("license")).otherwise(w))
    return let(british, lambda present: F.flatten(F.transform(
        F.filter(_table(rules), lambda g: F.array_contains(present, g["keyword"])),
        lambda g: F.filter(g["rules"], lambda r: F.forall(r["needs"], lambda w: F.array_contains(present, w))))))


def _found(numbered: Column, rules: Column) -> Column:
    """All places of the rules."""
    def places(rule: Column) -> Column:
        number = lambda word: F.substring_index(word, ":", 1).cast("bigint")
        return F.transform(F.regexp_extract_all(numbered, rule["regex"], F.lit(0)), lambda m: F.struct(
            number(m).alias("first"), (-number(F.substring_index(m, " ", -1))).alias("left"),
            rule["kind"].alias("kind"), rule["rank"].alias("rank"), rule["label"].alias("label")))

    return F.array_sort(F.flatten(F.transform(rules, places)))


def _kept(found: str, kinds: int) -> Column:
    """The sorted detections without those inside one of their own or a higher priority.

    For each priority the fold keeps the last word reached by detections of it or a
    higher one; a detection that does not reach beyond it lies inside one of them.
    """
    ends = f"array({', '.join(['-1L'] * kinds)})"
    none = f"CAST(array() AS {_FOUND})"
    start = f"named_struct('ends', {ends}, 'done', CAST(array() AS array<{_FOUND}>), 'kept', {none})"
    step = ("(s, d) -> named_struct('ends', transform(s.ends, (e, k) -> if(k >= d.kind, greatest(e, -d.left), e)), 'done', s.done, "
            "'kept', if(element_at(s.ends, d.kind + 1) >= -d.left, s.kept, array_append(s.kept, d)))")
    block = (f"aggregate(b, named_struct('ends', t.ends, 'done', t.done, 'kept', {none}), {step}, "
             f"s -> named_struct('ends', s.ends, 'done', array_append(s.done, s.kept), 'kept', {none}))")
    blocks = f"transform(sequence(0, (size({found}) - 1) div {_BLOCK}), i -> slice({found}, CAST(i * {_BLOCK} + 1 AS INT), {_BLOCK}))"
    return F.expr(f"if(size({found}) = 0, {none}, aggregate({blocks}, {start}, (t, b) -> {block}, t -> flatten(t.done)))")


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, n_words and detections: (first, last, kind, rank, label) of every place that a rule finds and no other place overrides.

    Words are runs of characters other than ASCII ones that are no lower-case
    letter or digit, after A-Z is lower-cased; first and last are word numbers
    from 0, and places are in the order of their first word, longer ones first. A place inside another of the same or a higher priority is dropped;
    of equal places of one priority the earlier rule's stays. Every row is scanned by
    itself, whole, so repeated and null ids need no care; null texts are empty.
    Memory: about ten times the longest text, as its words are one array.
    """
    rules = all_rules() if rules is None else rules
    plain = docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("text_"))
    words = F.array_remove(F.split(F.translate("text_", _UPPER, _LOWER), _GAP), "")
    split = materialize(plain, words_=words).drop("text_")
    # Almost all texts end here: they do not hold all words that a rule needs.
    gated = materialize(split, n_words=F.size("words_").cast("bigint"), words_=F.col("words_"), rules_=_open(F.col("words_"), rules))
    marked = materialize(gated, numbered_=F.when(F.size("rules_") > 0, F.array_join(F.transform(
        "words_", lambda w, i: F.concat(i.cast("string"), F.lit(":"), w)), " "))).drop("words_")
    found = materialize(marked, found_=F.when(F.size("rules_") > 0, _found(F.col("numbered_"), F.col("rules_")))
                        .otherwise(F.expr(f"CAST(array() AS {_FOUND})"))).drop("numbered_", "rules_")
    kept = materialize(found, kept_=_kept("found_", max(r.kind for r in rules) + 1)).drop("found_")
    return kept.select(*keep, "n_words", F.transform("kept_", lambda d: F.struct(
        d["first"].alias("first"), (-d["left"]).alias("last"), d["kind"].alias("kind"), d["rank"].alias("rank"), d["label"].alias("label"))).alias("detections"))


def _labels(detections: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def license_report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The base columns are of the fixed phrases' places, which nothing overrides.
    The score is that of the surest detection, 0 without any.
    """
    found = materialize(scan_licenses(docs), base=F.filter("detections", lambda d: d["kind"] == BASE))
    firsts = F.transform("base", lambda d: d["first"])
    certainty = F.array(*[F.lit(c) for c in CERTAINTY])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        _labels(F.col("base")).alias("base_labels"), _labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: F.element_at(certainty, d["kind"] + 1))), F.lit(0.0)).alias("score"))


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_report(read_table(spark, sf_dir, "documents"))
