import pytest

from cropwire.llm import mixing


def rows(df):
    return df.collect()


def fluid(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by pouring: double the time until the budget is reached."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, lo, hi = share * sum(sizes.values()), 0.0, 1e12
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if sum(min(w[s] * mid, 2 * sizes[s]) for s in names) > budget else (mid, hi)
    return {s: min(w[s] * lo, 2 * sizes[s]) for s in names}


def test_taken_words_follow_the_targets(docs):
    many = [(i, "w " * (1 + i * 7 % 40), "en", ("a", "b", "c", None)[min(3, i % 6)]) for i in range(3000)]
    got = rows(mixing.mix_sources(docs(many)))
    assert len(got) == 3000
    sizes = {r.source: r.source_size for r in got}
    want = fluid(sizes)
    for s, target in want.items():
        mine = [r for r in got if r.source == s]
        assert mine[0].target == pytest.approx(target, rel=1e-6)
        assert sum(r.size for r in mine) == sizes[s]
        assert sum(r.taken for r in mine) == pytest.approx(target, abs=60)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in mine)
    assert abs(sum(r.taken for r in got) - 1.5 * sum(sizes.values())) <= 80


def test_reruns_and_other_partitionings_agree(docs):
    many = docs([(i, "w " * (i % 9), "en", f"s{i % 3}") for i in range(500)])
    a, b = ({(r.doc_id, r.taken) for r in rows(mixing.mix_sources(d))} for d in (many, many.repartition(7)))
    assert a == b


def test_small_buckets_give_the_same(docs, monkeypatch):
    many = docs([(i, "w " * (i % 9), "en", f"s{i % 3}") for i in range(500)])
    a = {(r.doc_id, r.taken) for r in rows(mixing.mix_sources(many))}
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 4)
    assert a == {(r.doc_id, r.taken) for r in rows(mixing.mix_sources(many))}


def test_edges(docs, clashing):
    got = {(r.doc_id, r.source): r for r in rows(mixing.mix_sources(clashing(docs([
        (1, None, "en", None), (None, "a b", "en", "x"), (2, "", "en", "x"), (3, "c " * 50000, "en", "y"), (3, "c " * 50000, "en", "y")]))))}
    assert got[1, None].size == 0 and got[1, None].taken == 0 and got[None, "x"].size == 2
    assert got[3, "y"].size == 50000
    assert rows(mixing.mix_sources(docs([]))) == []
    assert [r.taken for r in rows(mixing.mix_sources(docs([(1, None), (2, " \n")])))] == [0, 0]


@pytest.mark.parametrize("steps", [1024, 7])
def test_rows_without_an_id_come_near_their_targets(docs, monkeypatch, steps):
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", steps)
    many = [(None, "w " * 10, "en", s) for s in ("a", "b") for _ in range(1500)] + [(None, f"x{i} " * 10, "en", "c") for i in range(1500)] + [(7, "y " * 10, "en", "c")] * 300
    got = rows(mixing.mix_sources(docs(many)))
    assert len(got) == len(many)
    sizes = {r.source: r.source_size for r in got}
    for s, target in fluid(sizes).items():
        assert sum(r.taken for r in got if r.source == s) == pytest.approx(target, abs=30), s
    again = rows(mixing.mix_sources(docs(many[::-1]).repartition(5)))
    assert sorted(str((r.doc_id, r.source, r.content, r.taken)) for r in got) == sorted(str((r.doc_id, r.source, r.content, r.taken)) for r in again)


def test_copies_equal_a_plain_queue(docs):
    """Every reading in order of virtual finish time, taken while the budget lasts, from the same shuffled order."""
    many = [(i, f"t{i} " + "w " * (i * 13 % 23), "en", "abc"[i % 7 % 3]) for i in range(400)]
    got = rows(mixing.mix_sources(docs(many)))
    weight = dict(zip("abc", (5, 2, 1)))
    queue = []
    for s in "abc":
        mine = sorted((r for r in got if r.source == s), key=lambda r: r.finish)
        upto = 0
        for r in mine:
            upto += r.size
            assert r.finish == pytest.approx(upto / weight[s])
            queue += [((upto + e * r.source_size) / weight[s], r.doc_id, r.size) for e in (0, 1)]
    budget, taken, copies = 1.5 * sum(r.size for r in got), 0, {}
    for _, doc, size in sorted(queue):
        if taken + size > budget:
            break
        taken += size
        copies[doc] = copies.get(doc, 0) + 1
    assert {r.doc_id: r.copies for r in got if r.copies} == copies
