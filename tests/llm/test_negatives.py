import math
import random

import numpy as np
import pytest

from cropwire.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def some(n=600, dim=40, seed=5):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [c + r.gauss(0, 0.6) for c in centres[r.randrange(6)]], r.randrange(4)) for i in range(n)]


def brute(rows, every=50):
    clip = lambda x: max(-2**63, min(2**63 - 1, x))
    whole = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows]
    out = []
    for a, v, c in whole:
        if a % every:
            continue
        scored = sorted((-clip(sum(x * y for x, y in zip(v, w))), i, k) for i, w, k in whole if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == c][:5]:
            window = [x for x in scored if x[2] != c and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(a, p, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(window)]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r[c] for c in COLUMNS) for r in negatives.hard_negatives(df, **more).collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 33, 33), (70, 101, 67), (40, 64, 300), (129, 35, 5)])
@pytest.mark.parametrize("size", [1 << 9, 1 << 28, 1 << 31])
def test_strassen_is_exact(shape, size):
    m, k, n = shape
    r = np.random.default_rng(1)
    a, b = r.integers(-size, size, (m, k)), r.integers(-size, size, (k, n))
    with np.errstate(over="ignore"):
        want = np.array((a.astype(object) @ b.astype(object)) % 2**64, dtype=object)
        assert (negatives.strassen(a, b).astype(object) % 2**64 == want).all()


@pytest.mark.parametrize("side", [8192, 100])
def test_equals_brute_force(vectors, monkeypatch, side):
    monkeypatch.setattr(negatives, "TILE_ROWS", side)
    monkeypatch.setattr(negatives, "FAN_IN", 2)
    rows = some()
    got = mined(vectors(rows))
    assert got == brute(rows) and len(got) > 50


def test_edges(vectors, clashing):
    v, w = [1.0, 0.0], [0.7, 0.0]
    rows = [(0, v, 1), (0, [9.0, 9.0], 2), (3, v, 1), (3, v, 1), (4, v, 1), (5, w, 2), (5, w, 2), (6, w, 3), (9, w, 1), (7, w, None), (None, w, 2), (8, None, 2),
            (10, [0.7, None], 2), (11, [float("nan"), 0.0], 2), (12, [float("inf"), 0.0], 2), (13, [], 2), (14, [0.7], 2), (100, [1e300, 1.0], 1), (150, [0.0, 1.0], 1)]
    got = mined(clashing(vectors(rows)))
    valid = [r for r in rows if None not in r and r[1] and None not in r[1] and all(map(math.isfinite, r[1])) and r != (0, [9.0, 9.0], 2)]
    # The anchor 0 is its least vector; its other row is no candidate of its own but one of other anchors.
    assert [g for g in got if g[0] == 0] == [g for g in brute(valid) if g[0] == 0]
    assert [g[3] for g in got if g[0] == 0 and g[1] == 3] == [5, 5, 5, 5, 6, 6]
    assert mined(vectors([])) == [] and mined(vectors([(0, v, 1)])) == [] and mined(vectors([(1, v, 1), (2, v, 2)])) == []


def test_large_components_and_negative_positives(vectors):
    big = 2.0 ** 40
    rows = [(0, [big, 3.0], 1), (1, [big, 1.0], 1), (2, [0.9 * big, 2.0], 2), (3, [-1.0, 0.0], 1), (4, [0.0, 0.0], 2), (50, [1.0, 0.0], 3), (51, [-1.0, 0.0], 3), (52, [-0.9, 0.0], 4)]
    assert mined(vectors(rows)) == brute(rows)


def test_many_copies_count_as_rows(vectors):
    v, w = [1.0, 0.5], [0.8, 0.4]
    rows = [(0, v, 1)] + [(2, v, 1)] * 40 + [(3, w, 2)] * 50
    assert mined(vectors(rows)) == brute(rows)
