import hashlib
import random
import zlib

import numpy as np
import pytest

from cropwire.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.fixture
def turns(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    """Nodes by plain dictionaries; turns of equal number must be equal in the rows."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple(convs.get(first, [])[:h] + own[h:])
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, cs in members.items():
        sub = [n for n in members if n[:len(node)] == node]
        kids = [n for n in sub if len(n) == len(node) + 1]
        leaves = [n for n in sub if not any(m[:len(n)] == n and len(m) > len(n) for m in sub)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in sub if n)
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(node))))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


def built(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in trie.prefix_trie(trie.rebuilt_paths(df)).collect()), key=lambda r: (r[1], r[0]))


def some(n=120, seed=1):
    """Conversations with few different turns, so that prefixes are shared at every depth, and one that a third of all are."""
    r = random.Random(seed)
    rows = []
    for c in range(n):
        length = r.choice([1, 2, 3, 5, 9, 12])
        texts = [r.choice(["", "a", "é", "long text", None]) for _ in range(length)] if c % 3 else ["same", "words", "again"]
        rows += [(c, t, r.choice(["user", None]) if c % 3 else "user", x) for t, x in enumerate(texts)]
    return rows


@pytest.mark.parametrize("few", [1 << 12, 8])
def test_equals_brute_force(turns, monkeypatch, few):
    monkeypatch.setattr(trie, "FEW_TURNS", few)  # eight: a shard for every shuffle partition
    rows = some()
    random.Random(2).shuffle(rows)
    assert built(turns(rows)) == brute(rows)


def test_ids_in_chunks(turns, monkeypatch):
    monkeypatch.setattr(trie, "ID_BITS", 1)
    rows = [(c, 0, "u", "x") for c in range(0, 60, 5)] + [(101, 0, "u", "y")]
    assert built(turns(rows)) == brute(rows)


def test_edges(turns, clashing):
    rows = [(None, 0, "u", "x"), (10, None, "u", "first"), (10, 1, None, None), (10, 1, None, None), (11, 0, None, "b"), (-7, 0, "u", "x"), (-5, 0, "u", "y"), (-5, 7, "u", "z"),
            (23, 0, "u", "no first conversation"), (40, 0, "u", "x" * 400_000), (2**62, 0, "u", "x")]
    assert built(clashing(turns(rows))) == brute(rows)
    assert built(turns([])) == [] and built(turns([(None, 0, "u", "x")])) == []
    assert brute([(c, 0, "u", "x") for c in range(20)]) == built(turns([(c, 0, "u", "x") for c in range(20)]))


def test_equal_turn_numbers_have_one_order(turns):
    rows = [(5, 1, "u", x) for x in "abcdefgh"]
    once = built(turns(rows))
    assert once == built(turns(rows[::-1])) and len(once) == 9


def test_a_very_long_conversation(turns):
    rows = [(0, t, "u", f"t{t % 7}") for t in range(20_000)] + [(5, t, "u", f"t{t % 7}") for t in range(3_000)]
    got = built(turns(rows))
    assert len(got) == 20_001 and got[-1][1] == 20_000 and got[0][3:6] == (2, 1, 1)


def test_double_array_holds_its_paths_only():
    r = random.Random(4)
    paths = sorted({tuple(r.randrange(6) for _ in range(r.randrange(1, 7))) for _ in range(300)})
    turns, offsets = np.array([t for p in paths for t in p]), np.cumsum([0, *map(len, paths)])
    array, dense = trie.pack(turns, offsets)
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    slots = {(): 0}
    for p in sorted(prefixes, key=len):
        for t in range(6):
            at = int(array.step(np.array([slots[p]]), dense[[t]])[0])
            assert (at >= 0) == (p + (t,) in prefixes)
            if at >= 0:
                slots[p + (t,)] = at
    assert len(set(slots.values())) == len(prefixes) == array.used.sum()
