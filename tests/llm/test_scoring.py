import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cropwire.llm import running, scoring

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), None]


def is_held_out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


def brute_base(rows):
    c = Counter()
    for d, t in rows:
        if not is_held_out(d):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    return n, [(d, is_held_out(d), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)),
                sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for d, t in rows]


@pytest.mark.parametrize("frequent", [1 << 19, 40, 0])
def test_counts_and_base_score_equal_brute_force(tables, frequent):
    table = tables("documents")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    n, want = brute_base(rows)
    got = {r.doc_id: r for r in scoring.score_texts(table, frequent=frequent).collect()}
    for d, held, k, known, base in want:
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, k, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert -60 * r.n_bytes < r.score < 0


def test_scores_do_not_depend_on_which_words_are_broadcast(tables):
    table = tables("documents")
    a, b = ({r.doc_id: r.score for r in scoring.score_texts(table, frequent=f).collect()} for f in (1 << 19, 30))
    assert a == pytest.approx(b, rel=1e-6)


def words(texts):
    parts = [t.encode() for t in texts]
    size = np.array([len(p) for p in parts], np.int32)
    raw = np.frombuffer(b"".join(parts), np.uint8)
    begin = np.cumsum(size) - size
    return scoring.Words(scoring.span_hashes(raw, begin, begin + size), np.ones(len(parts), np.int64), size, raw)


def test_bits_of_all_words_add_up_to_one():
    """The bit predictions are a distribution over byte strings: no probability is made or lost."""
    rng = np.random.default_rng(1)
    table = rng.integers(0, 9, (2, int(scoring.BASES[-1]))).astype(np.float32)
    model = scoring.Model(table, rng.normal(0.2, 0.1, (scoring.GATES, 5)))
    # All one-byte strings and the empty one, then what longer strings must share.
    one = scoring.Words(np.arange(257).astype(np.uint64), np.ones(257, np.int64), np.array([0] + [1] * 256, np.int32), np.arange(256).astype(np.uint8))
    p = 10.0 ** model.log10(one)
    begin = np.zeros(256)
    bits = scoring.Bits(scoring.Words(np.arange(256).astype(np.uint64), np.ones(256, np.int64), np.ones(256, np.int32), np.arange(256).astype(np.uint8)))
    for j in range(8):
        at, bit = bits.slots(j)
        x = sum(model.stretch[a] * model.weight[scoring._gate(table, at, 0)][:, i] for i, a in enumerate(at))
        begin += np.where(bit, -np.logaddexp(0, -x), -np.logaddexp(0, x))[::2]
    assert np.exp(begin).sum() == pytest.approx(1, abs=1e-4)  # first bytes
    assert p[0] == pytest.approx(np.exp(begin[32]), rel=1e-3) and (p[1:] <= np.exp(begin) + 1e-9).all()


def test_the_model_learns_spelling(docs):
    rng = random.Random(3)
    syllable = ["ba", "ko", "ti", "lu", "ne"]
    text = lambda: " ".join("".join(rng.choice(syllable) for _ in range(4)) for _ in range(60))
    rows = [(i, text()) for i in range(80)]
    strange = 1000 + next(i for i in range(100) if is_held_out(1000 + i))
    fresh = strange + 1 + next(i for i in range(100) if is_held_out(strange + 1 + i))
    got = {r.doc_id: r for r in scoring.score_texts(docs([*rows, (strange, "xqzw vfgj " * 30), (fresh, text())])).collect()}
    assert got[fresh].bits_per_byte < 0.5 * got[strange].bits_per_byte or got[fresh].bits_per_byte < 2.5


def test_repeats_and_known_passages_cost_less(docs):
    rng = random.Random(8)
    vocab = [f"{chr(97 + i % 26)}{i}" for i in range(2000)]
    passage = " ".join(rng.choice(vocab) for _ in range(80))
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(50)) + " " + passage * (i % 2)) for i in range(120)]
    a = 2000 + next(i for i in range(100) if is_held_out(2000 + i))
    b = a + 1 + next(i for i in range(100) if is_held_out(a + 1 + i))
    got = {r.doc_id: r for r in scoring.score_texts(docs([*rows, (a, passage), (b, " ".join(rng.choice(vocab) for _ in range(80)))])).collect()}
    assert got[a].score > 0.7 * got[b].score and got[a].score > got[a].base_score


def test_edges(docs, clashing):
    rows = [(1, None), (1, None), (2, ""), (None, "some words"), (3, "Ünï cödé \x00 漢字"), (4, "x" * 200000 + " y"), (16, "new")]
    got = scoring.score_texts(clashing(docs(rows))).collect()
    assert len(got) == len(rows)
    n, want = brute_base(rows)
    key = lambda x: (x[0] is None, x[0], x[2])
    for r, w in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=key), sorted(want, key=key)):
        assert r[:4] == w[:4] and r[4] == pytest.approx(w[4]) and r[5] <= 0 and math.isfinite(r[5])
    assert scoring.score_texts(docs([])).collect() == []
    only = scoring.score_texts(docs([(d, "a b") for d in range(60) if is_held_out(d)])).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and math.isfinite(r.score) for r in only) and only


def test_runs_count_however_the_texts_are_split(spark, docs, monkeypatch):
    """A passage found once in each of many texts is known, and neither partitions, chunks nor buckets change a score."""
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    train = [d for d in range(200) if not is_held_out(d)]
    rows = [(d, passage if d < 60 else " ".join(f"p{rng.randrange(40)}" for _ in range(40))) for d in train]
    a, b = [d for d in range(1000, 1100) if is_held_out(d)][:2]
    shuffled = passage.split()
    rng.shuffle(shuffled)
    table = docs([*rows, (a, passage), (b, " ".join(shuffled))])
    one = {r.doc_id: r.score for r in scoring.score_texts(table.coalesce(1)).collect()}
    assert one[a] > 0.5 * one[b]
    # Small partitions and chunks, and many buckets.
    monkeypatch.setattr(scoring, "CHUNK_ROWS", 1)
    monkeypatch.setattr(scoring, "BUCKET_KEYS", 256)
    many = {r.doc_id: r.score for r in scoring.score_texts(table.repartition(16)).collect()}
    assert abs(many[a] - one[a]) < 0.02 * abs(one[a]) and many[a] > 0.5 * many[b]


def test_counts_of_runs_equal_brute_force(spark, docs, monkeypatch):
    rng = random.Random(6)
    rows = [(d, " ".join(rng.choice("abcd") for _ in range(rng.randrange(12)))) for d in range(60)]
    monkeypatch.setattr(scoring, "CHUNK_BYTES", 64)
    monkeypatch.setattr(scoring, "BUCKET_KEYS", 16)
    own = docs(rows).repartition(3).withColumn("held_out", scoring.held_out("doc_id", 7, 2))
    chunks = scoring.cut(scoring._chunks_of(own), "test-chunks")
    counts = scoring._run_counts(chunks).collect()
    want = Counter()
    for d, t in rows:
        if not is_held_out(d):
            x = ["", "", *t.split(), None]
            for i in range(2, len(x)):
                want[tuple(x[i - 2:i])] += 1
                want[tuple(x[i - 2:i + 1])] += 1
    seen = 0
    for c in chunks.collect():
        batches, some, context, run, _ = scoring._runs_of_chunk(c["rows"])
        total = np.frombuffer(b"".join(r["counts"] for r in sorted(counts, key=lambda r: r["bucket"]) if r["chunk"] == c["chunk"]), np.float32)
        got = []
        for batch in batches:
            texts = [t.split() for t in batch.column(1).to_pylist()]
            got += [tuple(["", "", *t][i:i + 3]) for t in texts for i in range(len(t))] + [tuple(["", "", *t, None][-3:]) for t in texts]
        for k, x, y in zip(got, context, run, strict=True):
            assert (total[x], total[y]) == (want[k[:2]], want[k])
        seen += len(got)
    assert seen == sum(len(t.split()) + 1 for _, t in rows)


def test_looked_up_gates_and_stretches_equal_their_definition():
    rng = np.random.default_rng(2)
    table = rng.integers(0, 90, (2, int(scoring.BASES[-1]))).astype(np.float32)
    at = [rng.integers(a, z, 500) for a, z in zip(scoring.BASES, scoring.BASES[1:])]
    bit = rng.integers(0, 2, 500)
    left, model = scoring.Left(table), scoring.Model(table, np.zeros((scoring.GATES, 5)))
    for less, level in ((1, left.level), (0, model.level)):
        assert (scoring._gate(table, at, less) == level[at[4]] + level[at[3]]).all()
    for a in at:
        n0, n1 = np.maximum(table[0][a] - (1 - bit), 0), np.maximum(table[1][a] - bit, 0)
        assert left.stretch[a * 2 + bit] == pytest.approx(np.log((n1 + scoring.PRIOR) / (n0 + scoring.PRIOR)), abs=1e-5)


def test_slots_grow_with_the_corpus_and_packed_numbers_return(spark):
    sizes = [scoring._key_bits(spark.createDataFrame([(n,)], "bytes long")) for n in (0, 10**6, 10**9, 10**14)]
    assert sizes == [32, 32, 38, 55]
    for x in (np.array([], np.int64), np.array([3, -1, 2**62], np.int64), np.arange(70000, dtype=np.uint32), np.arange(255, dtype=np.uint8)):
        assert (scoring.unpacked(scoring.packed(x), x.dtype) == x).all()


def code_and_texts(rng, texts=60):
    names = rng.integers(1, 1 << 63, 40).astype(np.uint64)
    names.sort()
    size = rng.integers(1, 40, texts)
    begin = np.concatenate([[0], np.cumsum(size)])
    h = rng.choice(np.concatenate([names, rng.integers(1, 1 << 63, 20).astype(np.uint64)]), begin[-1], p=np.r_[np.full(40, 0.02), np.full(20, 0.01)])
    code = running.Code(names, rng.integers(2, 90, 40), 30)
    one = np.concatenate([[np.uint64(7)], h[:-1]])
    return code, running.Stream.of(code, h, one, running.mix(one * np.uint64(3)), begin)


def plain_mix(code, s, table, bits, left_out, weight):
    """One text after the other, one bit after the other."""
    symbols = len(code.size)
    nodes = np.zeros((code.nodes, 2))
    paths = [[(int(n), int(b)) for n, b in zip(code.node[c:c + z], code.bit[c:c + z])] for c, z in zip(code.cut, code.size)]
    for path, c in zip(paths, table[:symbols]):
        for node, bit in path:
            nodes[node, bit] += c
    both = [x.reshape(-1, 2) for x in (table[symbols:symbols + (2 << bits)], table[symbols + (2 << bits):])]

    def slot(context, node):
        return ((int(context) ^ ((node + 1) * 0x9E3779B1 & 0xFFFFFFFF)) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - bits)

    def odds(counts, bit):
        n = [float(x) for x in counts]
        if left_out:
            n[bit] = max(0, n[bit] - 1)
        return max(-127, min(127, round(math.log((n[1] + running.PRIOR) / (n[0] + running.PRIOR)) * 8))) / 8

    out = []
    for a, z in zip(s.begin, s.begin[1:]):
        w, own, own_bits = [list(x) for x in weight], Counter(), min(running.OWN_BITS, max(3, math.ceil(math.log2(z - a)) + 1))
        for t in range(a, z):
            level = [sum(x[slot(c[t], code.nodes - 1)].sum() - left_out >= e for e in edges)
                     for x, c, edges in zip(both, (s.one, s.two), (running.LEVELS_ONE, running.LEVELS_TWO))]
            gate, total, move, seen = level[0] * 5 + level[1], 0.0, [0.0] * 5, {}
            for node, bit in paths[s.symbol[t]]:
                place = ((node + 1) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - own_bits)
                x = [odds(nodes[node], bit), odds(both[0][slot(s.one[t], node)], bit), odds(both[1][slot(s.two[t], node)], bit),
                     math.log((own[place, 1] + running.PRIOR) / (own[place, 0] + running.PRIOR)), 1.0]
                p = 1 / (1 + math.exp(-sum(i * j for i, j in zip(x, w[gate]))))
                total += math.log10(p if bit else 1 - p)
                move = [m + (bit - p) * i for m, i in zip(move, x)]
                seen[place] = bit
            w[gate] = [i + running.RATE * m for i, m in zip(w[gate], move)]
            for place, bit in seen.items():
                own[place, bit] += 1
            out.append(total)
    return out


@pytest.mark.parametrize("left_out", [False, True])
def test_mixing_along_texts_equals_a_plain_loop(left_out, monkeypatch):
    monkeypatch.setattr(running, "AT_ONCE", 50)
    monkeypatch.setattr(running, "OWN_SLOTS", 700)
    code, s = code_and_texts(np.random.default_rng(5))
    bits = 10
    table = np.zeros(running.table_size(code, bits), np.int64)
    running.count(code, s, np.arange(len(s.symbol)), bits, table)
    weight = np.random.default_rng(1).normal(0.3, 0.1, (running.GATES, running.INPUTS))
    got, learned, used = running.Mixer(code, table.astype(np.float32), bits, left_out).run(s, weight)
    assert got == pytest.approx(plain_mix(code, s, table, bits, left_out, weight), rel=2e-3, abs=2e-4)
    assert used.sum() == len(s.symbol) and np.abs(learned / np.maximum(used, 1)[:, None] - weight)[used > 9].max() > 1e-3


def test_learning_alone_leaves_scores_out_and_paths_are_filled_up_to_few_lengths():
    """Learning needs no scores, and the bits of a length are worked on together: neither may change weights or paths."""
    names = np.sort(np.random.default_rng(4).integers(1, 1 << 63, 60).astype(np.uint64))
    code = running.Code(names, np.arange(1, 61) ** 3, 500)
    assert len(np.unique(code.size)) > running.LENGTHS >= len(code.lengths) and (code.wide >= code.size).all()
    for c, z, wide in zip(code.cut, code.size, code.wide):
        assert (code.kind[c:c + z] == code.bit[c:c + z]).all() and (code.kind[c + z:c + wide] == 2).all()
    _, s = code_and_texts(np.random.default_rng(6))
    s = running.Stream(np.random.default_rng(7).integers(0, 61, len(s.symbol)), s.one, s.two, s.begin)
    table = np.zeros(running.table_size(code, 10), np.int64)
    running.count(code, s, np.arange(len(s.symbol)), 10, table)
    assert table[len(code.size):].sum() == 2 * code.size[s.symbol].sum()
    mixer = running.Mixer(code, table, 10, True)
    (scored, *both), (none, *alone) = mixer.run(s, running.first_weights()), mixer.run(s, running.first_weights(), scored=False)
    assert (scored < 0).all() and not none.any() and all((a == b).all() for a, b in zip(both, alone))


def test_spans_and_their_hashes_equal_a_plain_split():
    rng = random.Random(12)
    texts = [bytes(rng.choice(b"ab \n") for _ in range(rng.randrange(9))) for _ in range(400)]
    raw, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    starts, ends, owner = scoring.spans(raw, offsets)
    got = [(int(o), raw[a:z].tobytes()) for a, z, o in zip(starts, ends, owner, strict=True)]
    assert got == [(i, w) for i, t in enumerate(texts) for w in t.split()]
    h = scoring.span_hashes(raw, starts, ends)
    assert len(set(h.tolist())) == len({w for _, w in got}) == len(set(zip(h.tolist(), (w for _, w in got))))


def test_symbols_after_a_context_add_up_to_one():
    code, s = code_and_texts(np.random.default_rng(9))
    table = np.zeros(running.table_size(code, 10), np.int64)
    running.count(code, s, np.arange(len(s.symbol)), 10, table)
    a, z = next((a, z) for a, z in zip(s.begin, s.begin[1:]) if z - a > 20)
    total = 0.0
    for symbol in range(len(code.size)):
        one = running.Stream(np.r_[s.symbol[a:z - 1], symbol], s.one[a:z], s.two[a:z], np.array([0, z - a]))
        total += 10.0 ** float(running.Mixer(code, table, 10, False).run(one, running.first_weights())[0][-1])
    assert total == pytest.approx(1, abs=1e-4)


def test_weights_go_on_along_long_texts_in_groups():
    """Every token of a text with more than ``STEADY`` tokens is scored once, and what it repeats gets likelier."""
    code, s = code_and_texts(np.random.default_rng(3), texts=400)
    n = len(s.symbol)
    symbol, one = np.resize(s.symbol[:5], n), np.zeros(n, np.uint32)
    long = running.Stream(symbol, one, one, np.array([0, n]))
    table = np.zeros(running.table_size(code, 10), np.int64)
    got = running.Mixer(code, table, 10, False).run(long, running.first_weights())[0]
    seen = code.size[symbol] > 0
    assert n > 4 * running.STEADY and (got[seen] < 0).all() and got[-200:].mean() > 0.8 * got[:5].mean()


def test_a_word_is_likelier_after_the_word_that_it_follows_in_the_corpus(docs):
    """The two-word contexts of the scored texts are new, so only mixing along running text can tell."""
    rng = random.Random(2)
    pairs = [(f"a{i}", f"b{i}") for i in range(12)]
    text = lambda: " ".join(x for _ in range(30) for x in (f"n{rng.randrange(10**9)}", *rng.choice(pairs)))
    train = [d for d in range(200) if not is_held_out(d)]
    good, bad = [d for d in range(1000, 1100) if is_held_out(d)][:2]
    fresh = [f"z{i}" for i in range(12)]
    rows = [*((d, text()) for d in train), (good, " ".join(x for z, (a, b) in zip(fresh, pairs) for x in (z, a, b))),
            (bad, " ".join(x for i, (z, (a, _)) in enumerate(zip(fresh, pairs)) for x in (z, a, pairs[(i + 5) % 12][1])))]
    got = {r.doc_id: r.score for r in scoring.score_texts(docs(rows)).collect()}
    assert got[good] > got[bad] + 3
