import random
from collections import Counter

import numpy as np
import pytest

from cropwire.llm import partenum

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_set(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """Every pair of sets, with its exact similarity."""
    sets = [(d, word_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {d: (len(s), find(d)) for d, s in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_components(df).collect()}


def family(rng, n=260, seed_words=400):
    """Texts of 1 to 300 words: edited copies near the threshold, shared passages, copies and strangers."""
    vocab = [f"w{i}" for i in range(seed_words)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows, base = [], [[rng.choice(vocab) for _ in range(rng.choice((1, 3, 4, 5, 6, 9, 20, 60, 120, 300)))] for _ in range(30)]
    for i in range(n):
        words = list(rng.choice(base))
        kind = rng.random()
        if kind < 0.6:
            for _ in range(rng.randrange(0, max(2, len(words) // 30))):
                words[rng.randrange(len(words))] = rng.choice(vocab)
        elif kind < 0.8:
            words[len(words) // 2:len(words) // 2] = passage
        rows.append((i, rng.choice((" ", "\n", " \t ")).join(w.upper() if rng.random() < 0.2 else w for w in words)))
    return rows


@pytest.mark.parametrize("seed, tile", [(1, 512), (2, 512), (3, 8)])
def test_components_equal_brute_force(docs, monkeypatch, seed, tile):
    monkeypatch.setattr(partenum, "TILE", tile)
    rows = family(random.Random(seed))
    assert found(docs(rows)) == brute(rows)


def test_edited_copies_that_are_linked_through_their_source_only(docs):
    rng = random.Random(9)
    source = [f"s{i}" for i in range(200)]
    rows = []
    for i in range(60):
        words = list(source)
        for at in rng.sample(range(200), 3):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    rows.append((99, " ".join(source)))
    assert found(docs(rows)) == brute(rows)


def test_every_linked_pair_shares_a_signature():
    rng = random.Random(4)
    for _ in range(400):
        n = rng.choice((1, 2, 4, 5, 8, 15, 16, 31, 40, 100, 333, 1000))
        a = {rng.getrandbits(64) for _ in range(n)}
        drop, add = rng.randrange(0, n // 8 + 1), rng.randrange(0, n // 8 + 1)
        b = set(list(a)[drop:]) | {rng.getrandbits(64) for _ in range(add)}
        if not b or 100 * len(a & b) < 80 * len(a | b):
            continue
        grams = np.concatenate([np.sort(np.array(list(s), np.uint64)) for s in (a, b)])
        sig, of = partenum.signatures(grams, np.array([0, len(a), len(a) + len(b)]))
        assert set(sig[of == 0].tolist()) & set(sig[of == 1].tolist())
        sk = partenum.sketches(grams, np.array([0, len(a), len(a) + len(b)]))
        assert partenum.within_bound(np.array([len(a)]), sk[:1], np.array([len(b)]), sk[1:]).all()


def test_signatures_per_set_follow_its_size():
    grams = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    sig, _ = partenum.signatures(grams, np.array([0, 5000]))
    assert len(sig) < 0.6 * 5000


def test_edges(docs, clashing):
    text = "one two three four five six"
    rows = [(5, text), (2, text.upper()), (None, text), (3, None), (4, ""), (6, " \n"), (7, "a b"), (8, "A  b"), (9, "a"), (2, text), (10, "z " * 30000)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.copies) for r in partenum.jaccard_components(clashing(docs(rows))).collect())
    assert got == Counter({(5, 2, 2, 4): 1, (2, 2, 2, 4): 2, (None, 2, 2, 4): 1, (3, 0, 3, 1): 1, (4, 0, 4, 1): 1, (6, 0, 6, 1): 1,
                           (7, 1, 7, 2): 1, (8, 1, 7, 2): 1, (9, 1, 9, 1): 1, (10, 1, 10, 1): 1})
    assert partenum.jaccard_components(docs([])).collect() == []
    assert [tuple(r) for r in partenum.jaccard_components(docs([(None, text)])).collect()] == [(None, 2, None, 1)]


def test_components_of_chains_stars_and_random_links(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)] + [(500 + i, 500) for i in range(1, 30)]
    parent = list(range(600))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = {r[0]: r[1] for r in partenum.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert partenum.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_different_texts_under_one_id(docs):
    a, b = "one two three four five six seven", " ".join(f"w{i}" for i in range(40))
    rows = [(7, a), (7, b), (3, b.replace("w0 ", "x ")), (9, a + " eight"), (8, "nothing like it at all here")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in partenum.jaccard_components(docs(rows)).collect()}
    assert got == {(7, 3): 3, (7, 36): 3, (3, 36): 3, (9, 4): 9, (8, 2): 8}


def test_rows_without_an_id_link_others(docs):
    base = [f"w{i}" for i in range(60)]
    a, b = base[:-5] + ["x1", "x2"], ["y1", "y2"] + base[5:]
    near = " ".join(base[:-1])
    rows = [(None, " ".join(base)), (1, " ".join(a)), (2, " ".join(b)), (None, "no one is like this text here"), (9, "x y"), (9, near), (None, None), (4, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in partenum.jaccard_components(docs(rows)).collect()), key=str)
    numbered = sorted(((None if r.doc_id in (100, 101, 102) else r.doc_id, r.n_shingles, None if r.component_id in (101, 102) else r.component_id) for r in
                       partenum.jaccard_components(docs([(100 + i if r[0] is None else r[0], r[1]) for r, i in zip(rows, (0, 0, 0, 1, 0, 0, 2, 0))])).collect()), key=str)
    assert got == numbered
    assert {c for d, n, c in got if n > 40} == {1}
