import random
import re
from functools import lru_cache

import pytest

from cropwire.llm import licenses
from cropwire.llm.license_rules import BASE, CERTAINTY, CLUE, NAME, NOTICE, PHRASES, TAG, Rule, all_rules

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def match(words, at, parts):
    """Number of the last word of the first match of ``parts`` from word ``at`` on, greedy for ``~`` and not for ``*``; None without one."""
    if not parts:
        return at - 1
    part, rest = parts[0], parts[1:]
    if part.startswith("*"):
        for n in range(int(part[1:]) + 1):
            if at + n <= len(words) and (end := match(words, at + n, rest)) is not None:
                return end
        return None
    if at < len(words) and re.fullmatch(part.lstrip("~"), words[at]) and (end := match(words, at + 1, rest)) is not None:
        return end
    return match(words, at, rest) if part.startswith("~") else None


def brute(text, rules):
    words, found = words_of(text), []
    for r in rules:
        at = 0
        while at < len(words):
            end = match(words, at, r.pattern.split())
            if end is not None:
                found.append((at, end, r.kind, r.rank, r.label))
            at = at + 1 if end is None else end + 1
    def inside(d, e):
        return e[0] <= d[0] and d[1] <= e[1] and e[2] <= d[2] and (e[:2] != d[:2] or (e[2], e[3]) < (d[2], d[3]))
    return len(words), sorted(d for d in found if not any(inside(d, e) for e in found))


@lru_cache
def rules():
    return tuple(all_rules())


def row(doc_id, text):
    n, kept = brute(text, rules())
    base = [d for d in kept if d[2] == BASE]
    label = lambda ds: ",".join(sorted({d[4] for d in ds}))
    return (doc_id, n, len(base), min((d[0] for d in base), default=None), max((d[0] for d in base), default=None), label(base), label(kept),
            max((CERTAINTY[d[2]] for d in kept), default=0.0))


def scanned(df):
    return [tuple(r[c] for c in COLUMNS) for r in licenses.license_report(df).collect()]


def texts(n=60):
    """Lines of licenses of every frame, cut, run together and mixed with other words."""
    r = random.Random(8)
    spell = lambda p: " ".join(re.sub(r"\(ative\)\?|\[cs\]", lambda m: r.choice(["", "ative"]) if m[0][0] == "(" else r.choice("cs"), r.choice(w.lstrip("~").split("|")))
                               if w[0] != "*" else "x y" for w in p.split() if w[0] != "~" or r.random() < 0.6)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(1, 25)):
            line = spell(r.choice(rules()).pattern).split()
            parts += line[:r.choice([len(line), len(line), len(line) - 1])] + r.choices(["under", "the", "license", "é", "2", "version", "foo"], k=r.randrange(3))
        out.append("".join(w.title() + r.choice([" ", "\n * ", ", ", "-"]) for w in parts))
    return out


def test_rules_are_ordered_and_gated():
    assert len(rules()) > 300 and [r.rank for r in rules()] == list(range(len(rules())))
    assert [(r.label, r.pattern) for r in rules() if r.kind == BASE] == PHRASES
    for r in rules():
        assert r.needs and r.keyword in r.needs and re.compile(licenses.regex(r.pattern)) and r.pattern[0] not in "~*", r
    assert {r.kind for r in rules()} == {BASE, TAG, NOTICE, NAME, CLUE}


def test_every_rule_finds_its_own_line(docs):
    lines = [re.sub(r"~|\(ative\)\?", "", r.pattern).replace("licen[cs]e", "license").replace("unlicen[cs]e", "unlicense").replace("licen[cs]ed", "licensed") for r in rules()]
    lines = [" ".join("x" if w[0] == "*" else w.split("|")[0] for w in line.split()) for line in lines]
    got = dict((r.doc_id, r.detections) for r in licenses.scan_licenses(docs(list(enumerate(lines)))).collect())
    for i, (rule, line) in enumerate(zip(rules(), lines)):
        assert any(d.label == rule.label or d["kind"] <= rule.kind for d in got[i]), (rule, line)


def test_equals_brute_force(docs):
    rows = list(enumerate(texts()))
    got = {r[0]: r for r in scanned(docs(rows))}
    assert got == {i: row(i, t) for i, t in rows}
    spans = {r.doc_id: sorted(tuple(d) for d in r.detections) for r in licenses.scan_licenses(docs(rows)).collect()}
    assert spans == {i: brute(t, rules())[1] for i, t in rows}


def test_overlaps(docs):
    own = [Rule(0, 2, "long", "a b c"), Rule(1, 2, "inner", "b c"), Rule(2, 2, "across", "c d"), Rule(3, 1, "high", "b"), Rule(4, 2, "same", "c d"), Rule(5, 3, "low", "a b c d")]
    got = [tuple(d) for d in licenses.scan_licenses(docs([(1, "a b c d")]), own).first().detections]
    assert got == [(0, 3, 3, 5, "low"), (0, 2, 2, 0, "long"), (1, 1, 1, 3, "high"), (2, 3, 2, 2, "across")]


@pytest.mark.parametrize("text, labels, base", [
    ("Licensed under the GNU General Public License, version 3.", "gpl-3", ""),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc", "cc-by-nc"),
    ("cc by nc cc by nc sa", "cc-by-nc,cc-by-nc-sa", "cc-by-nc"),
    ("released under the MIT license", "mit", "mit"),
    ("# SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1", ""),
    ("Apache License,\n// Version 2.0", "apache-2", "apache-2"),
    ("under the MIT licenses; the underwriter", "", ""),
    ("the apache licence version 2 and under the mi̇t license", "apache-2", ""),
    ("under the Kmit license É", "", ""),
    ("", "", ""), (None, "", ""), ("... !!!", "", "")])
def test_lines(docs, text, labels, base):
    got = scanned(docs([(1, text)]))[0]
    assert got == row(1, text) and got[5:7] == (base, labels)


def test_edges(docs, clashing, spark):
    mit = "under the MIT license "
    rows = [(None, mit), (None, mit), (7, mit * 3), (7, None), (8, "x " * 200_000 + mit * 2000), (9, "\u0000under\u007fthe mit`license{")]
    got = sorted(scanned(clashing(docs(rows))), key=lambda r: (r[0] or 0, r[1]))
    want = [(None, 4, 1, 0, 0), (None, 4, 1, 0, 0), (7, 0, 0, None, None), (7, 12, 3, 0, 8), (8, 208_000, 2000, 200_000, 207_996), (9, 4, 1, 0, 0)]
    assert [g[:5] for g in got] == want and got[2][5:] == ("", "", 0.0) and got[4][5:] == ("mit", "mit", 1.0)
    assert scanned(docs([])) == []
    own = [Rule(0, BASE, "a", "one two"), Rule(1, 1, "b", "one two three")]
    assert [tuple(d) for d in licenses.scan_licenses(docs([(1, "one two three")]), own).first().detections] == [(0, 2, 1, 1, "b"), (0, 1, 0, 0, "a")]


def test_no_python_in_the_plan(docs):
    plan = licenses.license_report(docs([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
