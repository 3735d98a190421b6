import random
import tracemalloc
import zlib

import numpy as np
import pytest

from cropwire.llm import language, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


def crc(doc, modulus):
    return zlib.crc32(str(doc).encode()) % modulus


# ------------------------------------------------------------- toxicity --

def prose(rng, n, vocab):
    return " ".join(rng.choice(vocab) for _ in range(n))


@pytest.fixture
def toxic_corpus(spark, docs):
    rng = random.Random(6)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    bad = ["zarquon", "blugish", "idiot"]
    rows, labels = [], []
    for i in range(900):
        text, toxic = prose(rng, rng.randrange(20, 120), vocab), i % 6 == 0
        if toxic:
            words = text.split()
            for w in rng.sample(bad, 2):
                words.insert(rng.randrange(len(words)), w + rng.choice(("", "", "a", "en")) if w == "blugish" else w)
            text = " ".join(words)
        elif i % 5 == 1:
            text += " zarquon lamp"  # harmless in this phrase
        rows.append((i, text))
        labels.append((i, 1, int(toxic)))
    return docs(rows), spark.createDataFrame(labels, LABELS), {r[0]: r[2] for r in labels}


def test_toxicity_on_held_out_documents(toxic_corpus):
    table, labels, truth = toxic_corpus
    got = toxicity.score_toxicity(table, labels).collect()
    assert len(got) == 900
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if crc(i, 3) == 1}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_held_out_labels_and_other_columns_teach_nothing(toxic_corpus, spark):
    table, labels, truth = toxic_corpus
    from pyspark.sql import functions as F
    swapped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = table.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a, b = ({r.doc_id: r.score for r in toxicity.score_toxicity(t, s).collect()} for t, s in ((table, labels), (other, swapped)))
    assert a == b


def test_folding():
    for text in ("IDIOT", "1d10t", "іdіоt", "ıdıot", "id​iot", "ｉｄｉｏｔ", "i̇diot", "!idiot?"):
        assert toxicity.fold(text).strip() == "idiot", text
    assert toxicity.fold("c1own l0ser").split() == toxicity.fold("clown loser").split()
    assert toxicity.fold("réeux").strip() == "réeux"


def test_lexicon_matches_words_and_honours_exceptions():
    lex = toxicity.Lexicon({" idiot": 2.0, " scum ": 3.0, " trash ": 1.0}, ["trash can", "pond scum"], (-3.0, 2.0, 1.0))
    assert lex.features("an idiotic scum")[0] == 5.0
    assert lex.features("scummy patriot")[0] == 0.0
    assert lex.features("the trash can and the pond\nscum")[0] == 0.0
    assert lex.features("trash can trash")[0] == 1.0
    assert lex.features(None) == (0, 0, 0) == lex.features("")
    long, short = ("idiot " + "word " * 500), "idiot word word"
    assert lex.score(short)[0] > lex.score(long)[0] > lex.score("word")[0]


def test_toxicity_edges(spark, docs, clashing):
    rows = [(1, None), (2, ""), (None, "you idiot moron"), (3, "idiot " * 100000), (4, "fine"), (4, "fine")]
    none = spark.createDataFrame([], LABELS)
    got = {(r.doc_id, r.predicted) for r in toxicity.score_toxicity(clashing(docs(rows)), none).collect()}
    assert got == {(1, 0), (2, 0), (None, 1), (3, 1), (4, 0)}
    odd = spark.createDataFrame([(None, 1, 1), (4, None, None), (4, 0, 1), (4, 0, 0)], LABELS)
    assert toxicity.score_toxicity(docs(rows), odd).count() == 6
    assert toxicity.score_toxicity(docs([]), odd).collect() == []


def test_many_rows_of_one_id_stay_a_bounded_sample(spark, docs):
    from cropwire.llm.samples import labelled_texts
    rows = [(1, f"text {i}") for i in range(3000)] + [(i, "other") for i in range(2, 60)]
    labels = spark.createDataFrame([(1, 1, 1)] * 2000 + [(i, i % 2, 0) for i in range(2, 60)], LABELS)
    got = labelled_texts(docs(rows), labels, "quality", 5, 0, 10).collect()
    assert len(got) == len({r.doc_id for r in got}) <= 40


def test_a_rich_lexicon_is_learned_whole(spark, docs):
    rng = random.Random(9)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrt"]
    bad = [f"{a}{b}{c}x{d}" for a in "pqstvwz" for b in "aeiou" for c in "bcdfghjk" for d in "aeou"]  # 1,120 words
    rows, labels = [], []
    for i in range(3000):
        toxic = i % 2
        words = [rng.choice(vocab) for _ in range(20)] + (rng.sample(bad, 20) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    lexicon = toxicity.learn(toxicity._one_of_copies(toxicity.labelled_texts(docs(rows), spark.createDataFrame(labels, LABELS), "toxic", 3, 1, 6000)))
    found = sum(lexicon.score(" ".join(rng.choices(vocab, k=12) + [w, w]))[1] > 0 for w in bad)
    assert found >= 0.97 * len(bad), found


# -------------------------------------------------------------- language --

SOUNDS = {"en": "th er ing wh the and of", "de": "sch ung der und keit zu auf", "fr": "eau oi le et qu ez des", "es": "ción llo que los rr y ñ", "xx": "kj zvu qo bwe"}


def speech(rng, lang, n=60):
    parts = SOUNDS[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language_on_held_out_documents(docs):
    rng = random.Random(1)
    rows = [(i, speech(rng, lang), lang, "s") for i in range(600) for lang in [rng.choice(list(SOUNDS))]]
    got = language.identify_language(docs(rows)).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if crc(i, 4) == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_languages_teach_nothing(docs):
    rng = random.Random(2)
    rows = [(i, speech(rng, lang, 20), lang, "s") for i in range(200) for lang in [rng.choice(("en", "de", "fr"))]]
    blind = [(i, t, None if crc(i, 4) == 2 else lang, f"other{i}") for i, t, lang, _ in rows]
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in language.identify_language(docs(x)).collect()} for x in (rows, blind))
    assert a == b


def test_family_first_then_pairs():
    rng = np.random.default_rng(0)
    labels = ["en", "de", "fr", "es", "xx"] * 40
    x = np.eye(5)[[["en", "de", "fr", "es", "xx"].index(v) for v in labels]] + rng.normal(0, 0.1, (200, 5))
    d = language.Discriminator(x.astype(np.float32), labels)
    assert d.families == ["germanic", "other:xx", "romance"] and set(d.pairs) == {("de", "en"), ("es", "fr")}
    label, score = d.predict(x.astype(np.float32))
    assert (label == np.array(labels)).mean() > 0.99 and (score <= 1).all()


def test_learning_holds_one_dense_copy_of_its_sample(docs):
    """The driver keeps the sample sparse: at its peak it holds one dense block of it, and the machines are those of dense rows."""
    rng = random.Random(11)
    sounds = {lang: ["".join(rng.choice("abcdefghijklmnop") for _ in range(3)) for _ in range(60)] for lang in ("en", "de", "fr", "es")}
    table = docs([(i, " ".join(rng.choice(s) for _ in range(30)), lang, "s") for i in range(1200) for lang, s in [[*sounds.items()][i % 4]]])
    learned = sum(crc(i, 4) != 2 for i in range(1200))
    language.learn(table)
    tracemalloc.start()
    try:
        got = language.learn(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * 4 * learned * language.DIMENSIONS
    assert set(got.pairs) == {("de", "en"), ("es", "fr")} and got.family.shape == (2, language.DIMENSIONS + 1)


def test_sparse_samples_equal_dense_ones():
    rng = np.random.default_rng(5)
    x = (rng.integers(0, 2, (60, 32)) * rng.random((60, 32))).astype(np.float16)
    rows = language.Sample.of(x)
    assert (rows.dense(bias=False) == x).all() and (rows.dense()[:, -1] == 1).all() and (rows.take([3, 1]).dense(bias=False) == x[[3, 1]]).all()
    assert [x[i].tobytes() for i in language._order(rows)] == sorted(v.tobytes() for v in x)
    labels = [["en", "de", "fr"][i % 3] for i in range(60)]
    a, b = language.Discriminator(rows, labels), language.Discriminator(x.astype(np.float32), labels)
    assert (a.family == b.family).all() and all((a.pairs[k] == b.pairs[k]).all() for k in b.pairs)


def test_every_language_is_learned(docs, monkeypatch):
    monkeypatch.setattr(language, "LEAST_PER_CLASS", 4)
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    sounds = {f"l{k:03d}": ["".join(rng.choice(letters) for _ in range(4)) for _ in range(4)] for k in range(205)}
    rows = [(4 * k + i, " ".join(rng.choice(s) for _ in range(40)), lang, "s") for k, (lang, s) in enumerate(sounds.items()) for i in range(4)]
    got = language.identify_language(docs(rows), sample=820).collect()
    truth = {r[0]: r[2] for r in rows}
    learned = {r[2] for r in rows if crc(r[0], 4) != 2}
    assert {r.languages for r in got} == {len(learned)} and len(learned) > 200
    assert {r.lang_pred for r in got} >= learned
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * sum(t in learned for t in truth.values())


def test_text_and_language_are_of_one_row(docs):
    rng = random.Random(5)
    ids = [i for i in range(400) if crc(i, 4) != 2]
    rows = [(i, speech(rng, "en", 30), "en", "s") for i in ids[:60]] + [(i, speech(rng, "fr", 30), "fr", "s") for i in ids[60:120]]
    # Every id again with a text of the other language, once without a language and many times over.
    mixed = rows + [(i, speech(rng, "fr" if lang == "en" else "en", 30), None, "s") for i, _, lang, _ in rows] + [(ids[0], speech(rng, "en", 5), "en", "s") for _ in range(500)]
    got = language.identify_language(docs(mixed)).select("doc_id", "lang_pred", "score").collect()
    assert sum(r.lang_pred == "en" for r in got) == 60 + 60 + 500


def test_language_edges(docs, clashing):
    rng = random.Random(3)
    rows = [(i, speech(rng, lang, 20), lang, "s") for i, lang in enumerate(["en", "fr"] * 30)]
    odd = [(100, None, "en", "s"), (101, "", "en", "s"), (102, "12 34 !!", "en", "s"), (None, speech(rng, "fr"), None, None),
           (103, speech(rng, "en", 40000), None, "s"), (0, rows[0][1], "en", "s"), (104, "a", "en", "s")]
    got = {}
    for r in language.identify_language(clashing(docs(rows + odd))).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert got[100] == got[101] == got[102] == [("und", 0.0)]
    assert got[None][0][0] == "fr" and got[103][0][0] == "en" and len(got[0]) == 2 and got[0][0] == got[0][1]
    assert got[104][0][0] in ("en", "fr")
    assert language.identify_language(docs([])).collect() == []
    assert {r.lang_pred for r in language.identify_language(docs([(1, "text", None, "s")])).collect()} == {"und"}
    assert {r.lang_pred for r in language.identify_language(docs([(1, "text", "en", "s"), (3, "text", "en", "s")])).collect()} == {"en"}


# --------------------------------------------------------------- quality --

def junk(rng, kind):
    words = [f"{a}{b}" for a in "bdfgk" for b in ("al", "on", "ite", "uru")]
    text = " ".join(rng.choice(words) for _ in range(rng.randrange(30, 200)))
    return [text.upper().replace(" ", "!! "), text.replace(" ", "$$$ "), " ".join(w + (" " + w) * 8 for w in text.split()[:12])][kind]


def test_quality_on_held_out_documents(spark, docs):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("al", "on", "ite", "uru")]
    rows, labels = [], []
    for i in range(800):
        good = i % 5 > 0
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randrange(20, 200))) if good else junk(rng, rng.randrange(3))))
        labels.append((i, int(good), 0))
    got = quality.score_quality(docs(rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(800) if crc(i, 5) == 0}
    assert sum(r.predicted == (r.doc_id % 5 > 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (2000, 4))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    net = quality.Network(x, y, 0.5)
    p = net.predict(x)
    for lo, hi in ((0.1, 0.3), (0.4, 0.6), (0.7, 0.9)):
        at = (p > lo) & (p < hi)
        assert abs(y[at].mean() - p[at].mean()) < 0.1
    assert net.predict(x).mean() > quality.Network(x, y, 0.1).predict(x).mean()


def test_word_vectors_sum_contexts_of_all_documents(docs):
    import numpy as np
    texts = ["aa bb cc", "bb aa", "", None, "dd"]
    got = quality.context_vectors(docs(list(enumerate(texts))))
    at, sign = quality.index_vectors()
    bucket = {w: int(quality.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, 2]))[0][0]) for w in ("aa", "bb", "cc", "dd")}
    total = np.zeros((quality.BUCKETS, quality.DIMENSIONS))
    for pair, n in (("aabb", 2), ("bbaa", 2), ("aacc", 1), ("ccaa", 1), ("bbcc", 1), ("ccbb", 1)):
        np.add.at(total[bucket[pair[:2]]], at[bucket[pair[2:]]], n * sign[bucket[pair[2:]]])
    unit = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    seen = np.abs(total).sum(axis=1) > 0
    unit[seen] -= unit[seen].mean(axis=0)
    for w in ("aa", "bb", "cc"):
        v = unit[bucket[w]]
        assert got[bucket[w]] == pytest.approx(v / max(np.linalg.norm(v), 1e-9), abs=1e-5)
    assert not got[bucket["dd"]].any()


def test_quality_edges(spark, docs, clashing):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "w " * 200000), (4, "x"), (4, "x")]
    none = spark.createDataFrame([], LABELS)
    assert {(r.score, r.predicted) for r in quality.score_quality(clashing(docs(rows)), none).collect()} == {(0.5, 1)}
    one = spark.createDataFrame([(1, 0, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)], LABELS)
    assert {r.score for r in quality.score_quality(docs(rows), one).collect()} == {0.0}
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 5)], LABELS)
    got = quality.score_quality(docs(rows), both).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(docs([]), both).collect() == []
