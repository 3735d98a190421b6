import zlib
from collections import Counter

import corpus_pipeline as cp
import pytest

from cropwire.llm import language, mixing, toxicity

from .conftest import SF
from .test_packing import brute as brute_pieces
from .test_packing import placed
from .test_partenum import word_set


def components(rows):
    """Least id of each document's component, by comparing sets that share a shingle."""
    sets = {d: word_set(t) for d, t in rows}
    holders, parent = {}, {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    pairs = {(a, b) for own in holders.values() for b in own for a in own if a < b}
    for a, b in pairs:
        x, y = sets[a], sets[b]
        if 100 * len(x & y) >= 80 * len(x | y):
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {d: find(d) for d in sets}


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "packing"]


def test_run_equals_the_stages_by_hand(spark, tables):
    docs = tables("documents")
    names = docs.columns
    clean = cp.toxicity(spark, docs, SF)
    assert clean.columns == names
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, tables("labels")).filter("predicted = 1").collect()}
    kept = {r.doc_id: r for r in docs.collect() if r.doc_id not in toxic}
    assert toxic and {r.doc_id for r in clean.collect()} == set(kept)

    known = cp.language(spark, clean, SF)
    assert known.columns == names
    unsure = {r.doc_id for r in language.identify_language(clean).collect() if r.lang_pred == "und" or r.score < cp.LEAST_LANGUAGE_SCORE}
    kept = {d: r for d, r in kept.items() if d not in unsure}
    assert {r.doc_id for r in known.collect()} == set(kept)

    single = cp.near_duplicates(spark, known, SF)
    assert single.columns == names
    of = components([(d, r.text) for d, r in kept.items()])
    alone = {d: r for d, r in kept.items() if of[d] == d}
    assert len(alone) < len(kept) and Counter(single.collect()) == Counter(alone.values())

    mixed = cp.mixing(spark, single, SF)
    assert mixed.columns == names
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(single).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in copies.items() if n})

    got = cp.run(spark, SF).collect()
    want = brute_pieces([(d, alone[d].text) for d, n in copies.items() for _ in range(n)])
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    least = -(-sum(r.length for r in got) // 2048)
    assert placed(got) <= 1.02 * least + 1


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_edges_of_each_stage(spark, docs, clashing, name, stage):
    text = "the thing and the other one of them was here in the end"
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", None), (3, None, None, None), (None, text, "en", "a"), (4, "", "en", "b"),
            (5, "word " * 100000, "en", "b")]
    table = clashing(docs(rows)).drop("held_out")
    out = stage(spark, table, SF)
    assert name == "packing" or out.columns == table.columns
    got = Counter(r.doc_id for r in out.select("doc_id").collect())
    if name == "toxicity":
        assert got == Counter({1: 2, 2: 1, 3: 1, None: 1, 4: 1, 5: 1})
    elif name == "language":
        assert 3 not in got and 4 not in got and got[1] == 2 and got[2] == 1 and got[None] == 1
    elif name == "near_duplicates":
        assert got == Counter({1: 1, 3: 1, 4: 1, 5: 1})
    assert stage(spark, docs([]), SF).collect() == []


def test_clean_documents_stay(spark, tables):
    """Of the documents labelled clean, the filters keep almost all; of the toxic ones the first keeps almost none."""
    docs, labels = tables("documents"), tables("labels")
    label = {r.doc_id: r.toxic for r in labels.collect()}
    kept = {r.doc_id for r in cp.language(spark, cp.toxicity(spark, docs, SF), SF).collect()}
    clean, bad = [d for d in label if label[d] == 0], [d for d in label if label[d] == 1]
    assert sum(d in kept for d in clean) >= 0.97 * len(clean)
    assert sum(d in kept for d in bad if zlib.crc32(str(d).encode()) % 3 != 1) <= 0.5 * len(bad)


CLEAN = ["the thing and the other one of them was here in the end", "a letter from the old house on the hill came with the morning post",
         "they walked along the river and spoke about the harvest of that year"]


def test_rows_that_share_an_id_or_have_none_are_decided_on_alone(spark, docs, tables):
    """A toxic, wordless or copied text does not take the clean texts under its id with it."""
    toxic = max(tables("documents").join(tables("labels").filter("toxic = 1"), "doc_id").collect(), key=lambda r: len(r.text)).text
    for bad, stage in ((toxic, cp.toxicity), ("123 456", cp.language)):
        for doc in (None, 7):
            rows = [(doc, bad), *((doc, t) for t in CLEAN)]
            base = tables("documents").select("doc_id", "text", "lang", "source", "n_chars").filter("doc_id <> 7")
            out = stage(spark, base.unionByName(docs(rows)), SF)
            got = [r.text for r in out.filter(out.doc_id.eqNullSafe(doc)).collect()]
            assert Counter(got) == Counter(CLEAN)


def test_near_copies_without_an_id_are_linked_and_texts_under_one_id_are_not(spark, docs):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words), " ".join([*words[:-1], "other"])]
    got = cp.near_duplicates(spark, docs([(None, t) for t in near + CLEAN]), SF).collect()
    assert len(got) == 4 and Counter(r.text for r in got if r.text not in near) == Counter(CLEAN)
    # A numbered copy goes on, the row without an id goes; other rows without one stay.
    got = cp.near_duplicates(spark, docs([(None, near[0]), (3, near[1]), *((None, t) for t in CLEAN)]), SF).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(3, near[1]), *((None, t) for t in CLEAN)])
    # Different texts under one id both stay, equal rows once; wordless texts are copies of their own id only.
    rows = [(1, CLEAN[0]), (1, CLEAN[1]), (1, CLEAN[0]), (2, ""), (2, ""), (3, ""), (None, None), (None, None)]
    got = cp.near_duplicates(spark, docs(rows), SF).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter([(1, CLEAN[0]), (1, CLEAN[1]), (2, ""), (3, ""), (None, None), (None, None)])


def test_mixing_reads_texts_of_one_id_as_often_as_their_own_row_says(spark, docs):
    rows = [(d, " ".join(["w"] * n), "en", s) for s in "ab" for d in (None, 1, 2, 3, 4, 5) for n in (1, 7, 40)]
    table = docs(rows)
    want = Counter()
    for r in mixing.mix_sources(table).collect():
        want[r.doc_id, r.source, r.size] += r.copies
    got = Counter((r.doc_id, r.source, len(r.text.split())) for r in cp.mixing(spark, table, SF).collect())
    assert got == +want
