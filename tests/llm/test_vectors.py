import math
import random

import pytest

from cropwire.llm import ann, tiles, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def f32(x):
    import numpy as np
    return float(np.float32(x))


def some(n=400, dim=12, seed=3):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    return [(i, [f32(c + r.gauss(0, 0.4)) for c in centres[i % 8]]) for i in range(n)]


def brute_top(rows, every=50, k=5):
    q = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    out = set()
    for i in q:
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("tile", [8192, 64])
def test_exact_top_k_equals_brute_force(vectors, monkeypatch, tile):
    monkeypatch.setattr(tiles, "TILE_ROWS", tile)
    monkeypatch.setattr(tiles, "FAN_IN", 2)
    rows = some()
    assert {tuple(r) for r in topk.exact_top_k(vectors(rows)).collect()} == brute_top(rows)


def test_ties_repeats_and_bad_vectors(vectors, clashing):
    v = [1.0, 0.0]
    rows = [(0, v), (3, v), (2, v), (1, [0.0, 1.0]), (None, v), (7, None), (8, [1.0, None]), (9, [float("nan"), 1.0]), (10, []), (11, [1.0, 1.0, 1.0]),
            (2, v), (50, [1e30, 0.0])]
    got = [tuple(r) for r in topk.exact_top_k(clashing(vectors(rows))).filter("query_id = 0").orderBy("rank").collect()]
    assert [g[2] for g in got] == [50, 2, 2, 3, 1] and got[1][3] == 65536
    assert got[0][3] == 2**63 - 1  # clipped to a long
    assert topk.exact_top_k(vectors([])).collect() == []
    assert topk.exact_top_k(vectors([(0, v)])).collect() == []


def brute_near(rows, every=100, k=10):
    out = {}
    for i, v in rows:
        if i % every == 0:
            out[i] = sorted((math.dist(v, w), j) for j, w in rows if j != i)[:k]
    return out


def test_nearest_finds_almost_all(vectors, monkeypatch):
    monkeypatch.setattr(tiles, "TILE_ROWS", 500)
    rows = some(2000, 24)
    want = brute_near(rows)
    got = ann.nearest(vectors(rows)).collect()
    hits = sum(r.vec_id in {j for _, j in want[r.query_id]} for r in got)
    assert hits >= 0.98 * sum(map(len, want.values()))
    vec = dict(rows)
    for r in got:
        assert r.score == pytest.approx(math.dist(vec[r.query_id], vec[r.vec_id]), rel=1e-12)
    for q in want:
        mine = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_nearest_recall_on_the_test_table(tables):
    table = tables("embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = {(q, j) for q, best in brute_near(rows).items() for _, j in best}
    got = {(r.query_id, r.vec_id) for r in ann.nearest(table).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_nearest_edges(vectors, clashing):
    v = [1.0, 2.0]
    rows = [(0, v), (5, v), (4, v), (1, [0.0, 0.0]), (2, None), (3, [float("inf"), 1.0]), (None, v), (6, [3.0]), (7, [1.0, 3.0]), (4, v)]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(clashing(vectors(rows))).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, 0.0), (0, 2, 4, 0.0), (0, 3, 5, 0.0), (0, 4, 7, 1.0)]
    assert ann.nearest(vectors([])).collect() == []


def test_codes_estimate_inner_products():
    import numpy as np
    x = np.array([v for _, v in some(300, 64)])
    centre = x.mean(axis=0)
    bits, length, cosine = ann.encode(x, centre)
    assert bits.shape == (300, 8) and (cosine > 0.5).all()
    signs = np.unpackbits(bits, axis=1) * 2.0 - 1
    q = (x[0] - centre) / length[0]
    guess = (q @ ann.rotation(64)) @ signs.T / 8 / cosine
    true = (x - centre) @ q / length
    bound = ann.EPSILON * np.sqrt(1 - cosine**2) / cosine / np.sqrt(63)
    assert (np.abs(guess - true) <= bound).mean() > 0.9
