import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cropwire.llm import packing


def check(histogram, runs, capacity):
    used, fill = Counter(), defaultdict(list)
    for length, rank, n, first, offset in runs.intervals:
        assert rank == used[length]
        used[length] += n
        for i in range(n):
            fill[first + i].append((offset, length))
    assert used == Counter(histogram) and sorted(fill) == list(range(runs.sequences))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_every_piece_has_its_place(histogram):
    runs = packing.plan(histogram, 64, groups=6)
    check(histogram, runs, 64)
    # Never worse than plain best fit, longest first, which needs at most 11/9 of the best and one.
    assert runs.sequences <= 11 / 9 * max(1, -(-sum(k * v for k, v in histogram.items()) // 64)) * 1.6 + 2


def test_few_sequences_and_a_plan_that_does_not_grow(monkeypatch):
    rng = random.Random(5)
    h = Counter(min(2048, max(1, int(rng.lognormvariate(6.2, 1.1)))) for _ in range(20000))
    small, large = packing.plan(h), packing.plan({k: v * 50 for k, v in h.items()})
    check(h, small, 2048)
    least = -(-sum(k * v for k, v in h.items()) // 2048)
    assert small.sequences <= 1.01 * least
    assert len(large.intervals) < 3 * len(small.intervals)


def test_configurations_use_the_capacity():
    chosen = packing.configurations([7, 5, 4], [30, 30, 30], 16)
    assert all(np.dot(shape, [7, 5, 4]) <= 16 for shape, _ in chosen)
    assert sum(times for _, times in chosen) <= 32


def brute(rows, capacity=2048):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out = Counter()
    for d, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, z) in enumerate(zip(edges, edges[1:])):
            out[d, n, a, z - a, zlib.crc32(ids[a:z].tobytes())] += 1
    return out


def placed(got, capacity=2048):
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_and_places_of_the_test_table(tables):
    table = tables("documents")
    got = packing.pack_documents(table).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute([(r.doc_id, r.text) for r in table.collect()])
    least = -(-sum(r.length for r in got) // 2048)
    assert placed(got) <= 1.02 * least + 1


def test_edges(docs, clashing, monkeypatch):
    odd = "<|endoftext|> don't  \n\n\t 123 ½ 漢字 é \U0001f600 ​ x" + "a" * 9000
    rows = [(1, None), (2, ""), (None, "word " * 6000), (3, odd), (3, odd), (4, " " * 5000), (5, "x")]
    got = packing.pack_documents(clashing(docs(rows))).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == brute(rows)
    placed(got)
    assert packing.pack_documents(docs([])).collect() == []
    # Small buckets give other ranks, and still a place for all.
    monkeypatch.setattr(packing, "ROWS_PER_BUCKET", 1)
    placed(packing.pack_documents(docs(rows * 3)).collect())


def test_whole_sequences(docs):
    rows = [(i, "some words " * (i % 7)) for i in range(40)]
    packed = packing.pack_documents(docs(rows), keep_ids=True)
    encode = packing.encoder(packing.vocabulary_path()).encode_ordinary
    seen = {}
    for s in packing.sequences(packed).collect():
        for d, a, z in zip(s.doc_ids, s.offsets, [*s.offsets[1:], len(s.ids)]):
            seen[d] = list(s.ids[a:z])
    assert seen == {d: [*encode(t), 0] for d, t in rows}


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_tokenizers_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = test_ids_are_those_of_the_tokenizers_library.__dict__.setdefault("t", Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
    t.encode_special_tokens = True
    assert packing.encoder(packing.vocabulary_path()).encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ADDED = "<|endoftext|>"


def test_added_tokens_and_long_runs_have_the_ids_of_the_library(library):
    ids = packing.id_function(packing.vocabulary_path(), True)
    assert ids(f"Hello {ADDED} world") == [15496, 220, 50256, 995]
    n = 1_000_000
    long = [f"x{s * n}{end}" for s in (" ", "\n") for end in ("", "y", ADDED, "\u3000z")]
    odd = [ADDED, ADDED * 3, f"a{ADDED}'s {ADDED} ", "<|endoftext|", "<|endoftext<|endoftext|>|>", "\x1c" * packing.LONG_RUN + " a",
           "a " + "\u2003\x85 \r\n" * packing.LONG_RUN + " b  c", " " * packing.LONG_RUN + "\ta" + "\n" * packing.LONG_RUN]
    for text in long + odd:
        assert ids(text) == library.encode(text, add_special_tokens=False).ids, (text[:20], text[-20:])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.sampled_from([ADDED, "<|", "endoftext", "|>", " ", "\n", "\u3000", "a", "'s", "1", "!"]), max_size=30))
def test_ids_are_those_of_the_default_library(library, parts):
    text = "".join(parts)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(packing, "LONG_RUN", 3)  # bounds are looked up at each call
        assert packing.id_function(packing.vocabulary_path(), True)(text) == library.encode(text, add_special_tokens=False).ids


def test_the_query_finds_added_tokens(spark, docs, library, tmp_path):
    import corpus_pipeline
    text = f"Hello {ADDED} world"
    table = docs([(1, text)])
    table.write.parquet(f"{tmp_path}/documents.parquet")
    raw = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
    for got in (packing.op5_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.packing(spark, table, str(tmp_path))):
        (row,) = got.collect()
        assert (row.length, row.ids_crc32) == (len(raw), zlib.crc32(raw.tobytes()))
