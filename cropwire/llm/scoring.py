"""Language-model scoring by online logistic context mixing.

Texts are predicted token by token and bit by bit along their running words
(``running.py``): predictors in hashed contexts, counted over the texts learned
from, are added in the logistic domain with gated weights that are learned
online along those texts and go on being learned along each text scored. A bit
is a place on the way to a word in a tree of the most frequent words; all other
words share one escape and divide its probability by how they are spelled and counted.

Spelling is mixed in the same way. Each predictor looks up, by a hash of its
context (the last one to four bytes, or the whole word so far) and of the bits
already known of the byte, how many of the corpus's distinct words went on with
a 0 and with a 1 there; the weights are learned online, word by word, with each
word's own part taken out of the counts. A word's static probability is its
discounted count in the corpus, plus the mass that the discounts free, spread by
those bits.

A hashed context of the two words before a token then adds the counts of all
three-word runs of the corpus. Within a document this is refined adaptively: for
several weights of that context and of the document's own words so far, the
document's likelihoods are kept side by side and add up by Bayes' rule, so the
weights that suit the document prevail.

Distribution: words are 64-bit hashes in blocks, one block per bucket of hashes.
The most frequent words (a bounded number) are broadcast; all others meet the
documents that hold them bucket by bucket. Texts are worked on in stored
chunks: a chunk sends the distinct hashes of its runs and contexts, with its own
counts, to buckets of hashes, and each bucket sends the corpus's counts back.
The bits' counts are summed piece by piece in tables of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm import running
from cropwire.llm.common import bits_for, cut, held_out, read_table
from cropwire.llm.tables import packed, sum_tables, unpacked
from cropwire.llm.words import LOWER, mix, slices, span_hashes, spans

#: Slots (as bits of a slot number) of each predictor's table: contexts of one to four bytes, and the word so far.
TABLE_BITS = (16, 18, 20, 20, 20)
BASES = np.concatenate([[0], np.cumsum([1 << b for b in TABLE_BITS])])
#: Added to a slot's counts.
PRIOR = 0.4
#: Gates: levels of what is known of the word so far and of the last four bytes.
LEVELS_WORD, LEVELS_FOUR = np.array([1, 2, 3, 5, 9]), np.array([1, 4, 16, 64])
GATES = (len(LEVELS_WORD) + 1) * (len(LEVELS_FOUR) + 1)
#: Words of one online step, and its rate.
STEP_WORDS, RATE = 1024, 0.1
#: Bytes of words whose bits are counted at once.
COUNTED_AT_ONCE = 1 << 21
#: Words, by count, that are broadcast with their scores (20 bytes each).
FREQUENT = 1 << 19
#: Taken off every word's count for words not seen.
DISCOUNT = 0.75
#: Bytes and rows of a chunk of texts (one longer text is taken alone), and hashes of runs and contexts that a bucket holds on average.
CHUNK_BYTES, CHUNK_ROWS, BUCKET_KEYS = 1 << 23, 1 << 19, 1 << 21
#: Hashes of runs and contexts have this many bits more than it takes to number the corpus's bytes (about one in a thousand shares its slot), and at least so many.
SPARE_BITS, LEAST_BITS = 8, 32
#: (weight of the document's own words, counts that the two words before must outweigh), kept side by side.
EXPERTS = [(w, k) for w in (0.0, 0.05, 0.3, 0.8) for k in (3.0, 50.0)]
SUMS = [f"s{i}" for i in range(len(EXPERTS))]
START = np.uint64(0x2545F4914F6CDD1D)
#: Distinct words that a task holds before it passes them on.
HELD = 1 << 20
#: The end of a text: a word without bytes.
END = np.uint64(0x5851F42D4C957F2D)


class Words:
    """Words as arrays: hash, count, number of bytes, and all bytes in a row."""

    def __init__(self, h, count, size, raw):
        self.h, self.count, self.size, self.raw = h, count, size, raw

    def __len__(self) -> int:
        return len(self.h)

    @classmethod
    def none(cls):
        return cls(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint8))

    @classmethod
    def join(cls, parts: list["Words"]) -> "Words":
        return cls(*(np.concatenate([getattr(p, a) for p in parts]) for a in ("h", "count", "size", "raw")))

    def take(self, at: np.ndarray) -> "Words":
        begin = np.cumsum(self.size, dtype=np.int64) - self.size
        return Words(self.h[at], self.count[at], self.size[at], ragged(self.raw, begin[at], self.size[at]))

    def distinct(self) -> "Words":
        """One entry per hash, in hash order, counts added up."""
        order = np.argsort(self.h)
        h = self.h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        out = self.take(order[first])
        out.count = np.add.reduceat(self.count[order], first) if len(first) else out.count
        return out

    def columns(self) -> list[bytes]:
        return [packed(np.diff(self.h.astype(np.uint64), prepend=np.uint64(0))), packed(self.count.astype(np.int64)), packed(self.size.astype(np.int32)), packed(self.raw)]

    @classmethod
    def read(cls, h, count, size, raw) -> "Words":
        return cls(np.cumsum(unpacked(h, np.uint64), dtype=np.uint64), unpacked(count, np.int64), unpacked(size, np.int32), unpacked(raw, np.uint8))


def ragged(raw: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of several spans in a row."""
    total = int(size.sum())
    if not total:
        return np.empty(0, raw.dtype)
    ends = np.cumsum(size, dtype=np.int64)
    return raw[np.arange(total) + np.repeat(begin - (ends - size), size)]


def _before(h: np.ndarray, owner: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The token before each word, then that before each of ``m`` texts' ends; and the tokens before those."""
    words = np.bincount(owner, minlength=m)
    first = np.cumsum(words) - words
    place = np.arange(len(h)) - first[owner]
    padded = np.concatenate([np.full(2, START), h])
    one = np.where(place >= 1, padded[1:-1], START)
    two = np.where(place >= 2, padded[:-2], START)
    last = first + words
    one = np.concatenate([one, np.where(words >= 1, padded[last + 1], START)])
    return one, np.concatenate([two, np.where(words >= 2, padded[last], START)])


def runs_of(h: np.ndarray, owner: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the two tokens before each word, then of those before each of ``m`` texts' ends; and of all three tokens."""
    return _runs(h, m, *_before(h, owner, m))


def _runs(h: np.ndarray, m: int, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    context = mix(one * np.uint64(0x9E3779B97F4A7C15) + two * np.uint64(0xC2B2AE3D27D4EB4F))
    return context, mix(context ^ (np.concatenate([h, np.full(m, END)]) * np.uint64(0x165667B19E3779F9)))


_WORDS = "bucket long, h binary, count binary, size binary, raw binary"


def vocabulary(docs: DataFrame, buckets: int) -> DataFrame:
    """All distinct words of the texts with their counts, a block per bucket of hashes; every text adds one end."""
    def row(bucket: int, w: Words):
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), *(pa.array([c], pa.binary()) for c in w.columns())],
                                          ["bucket", "h", "count", "size", "raw"])

    def emit(batches):
        held, count = [], 0

        def flush():
            w = Words.join(held).distinct()
            bucket = (w.h % np.uint64(buckets)).astype(np.int64)
            for b in np.unique(bucket):
                yield row(int(b), w.take(np.flatnonzero(bucket == b)))

        for rows, raw, offsets in slices(batches, 0):
            low = LOWER[raw]
            starts, ends, _ = spans(low, offsets)
            h = span_hashes(low, starts, ends) if len(starts) else np.empty(0, np.uint64)
            order = np.argsort(h)
            new = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]])) if len(h) else np.empty(0, np.int64)
            # Letters of one place of each word.
            at = order[new]
            size = (ends[at] - starts[at]).astype(np.int32)
            held.append(Words(h[at], np.diff(new, append=len(h)), size, ragged(low, starts[at], size)))
            held.append(Words(np.array([END]), np.array([rows.num_rows]), np.zeros(1, np.int32), np.empty(0, np.uint8)))
            count += len(held[-2])
            if count >= HELD:
                yield from flush()
                held, count = [], 0
        if held:
            yield from flush()

    def add(table: pa.Table) -> pa.Table:
        w = Words.join([Words.read(*r) for r in zip(*(table[c].to_pylist() for c in ("h", "count", "size", "raw")))]).distinct()
        return pa.Table.from_batches([row(table["bucket"][0].as_py(), w)])

    return docs.select("text").mapInArrow(emit, _WORDS).groupBy("bucket").applyInArrow(add, _WORDS)


def blocks(batches):
    """(bucket, Words) of the rows of a vocabulary."""
    for b in batches:
        cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        for i in range(b.num_rows):
            yield cols["bucket"][i].as_py(), Words.read(*(cols[c][i].as_py() for c in ("h", "count", "size", "raw")))


class Bits:
    """The predictions' slots for every byte of some words, each ended by a space."""

    def __init__(self, w: Words):
        n = len(w)
        size = w.size.astype(np.int64) + 1
        ends = np.cumsum(size)
        self.byte = np.full(int(size.sum()), 32, np.uint8)
        inside = np.ones(len(self.byte), bool)
        inside[ends - 1] = False
        self.byte[inside] = w.raw
        self.word = np.repeat(np.arange(n), size)
        place = np.arange(len(self.byte)) - np.repeat(ends - size, size)
        padded = np.concatenate([np.full(4, 32, np.uint8), self.byte]).astype(np.uint32)
        last = []
        for k in range(1, 5):
            p = padded[4 - k:len(padded) - k].copy()
            p[place < k] = 32
            last.append(p)
        one = last[0]
        two = one | last[1] << np.uint32(8)
        three = two | last[2] << np.uint32(16)
        four = three | last[3] << np.uint32(24)
        # A rolling hash of the word so far, summed over the block and reset at each word.
        power = np.cumprod(np.full(int(size.max()) + 1 if n else 1, 0x01000193, np.uint64))
        term = (self.byte.astype(np.uint64) + np.uint64(1)) * power[place]
        run = np.cumsum(term) - term
        so_far = run - np.repeat(run[ends - size], size)
        whole = (mix(so_far + place.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)
        self.context = [c * np.uint32(0x9E3779B1) for c in (one, two + np.uint32(0x10001), three + np.uint32(0x2000003), four)] + [whole]

    def slots(self, j: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Slot in the tables of each predictor for bit ``j`` of every byte, and the bit."""
        node = (np.uint32(1) << np.uint32(j)) | (self.byte >> np.uint8(8 - j) if j else np.zeros(1, np.uint8)).astype(np.uint32)
        spread = node * np.uint32(0x85EBCA6B)
        out = []
        for c, b, base in zip(self.context, TABLE_BITS, BASES):
            x = c ^ spread
            x *= np.uint32(0xC2B2AE35)
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x27D4EB2F)
            x >>= np.uint32(32 - b)
            x = x.astype(np.int64)
            x += base
            out.append(x)
        return out, (self.byte >> np.uint8(7 - j)) & 1


def _chunks(w: Words, each: int):
    for at in range(0, len(w), each):
        yield w.take(np.arange(at, min(len(w), at + each)))


def _byte_chunks(w: Words, each: int):
    """Parts of about ``each`` bytes (one longer word is taken alone)."""
    ends = np.cumsum(w.size + 1, dtype=np.int64)
    at = 0
    while at < len(w):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + each, side="right")))
        yield w.take(np.arange(at, to))
        at = to


def tables(vocab: DataFrame) -> np.ndarray:
    """Counts of 0 and 1 per slot, over all distinct words: shape (2, slots), of fixed size."""
    slots = int(BASES[-1])

    def count(batches):
        table = None
        for _, words in blocks(batches):
            table = np.zeros(slots * 2, np.int64) if table is None else table
            for w in _byte_chunks(words, COUNTED_AT_ONCE):
                bits = Bits(w)
                for j in range(8):
                    at, bit = bits.slots(j)
                    for x in at:
                        x <<= 1
                        x += bit
                        np.add.at(table, x, 1)
        return table

    # Slot by slot, so the counts of 0 and 1 are views of one array.
    return sum_tables(vocab, count, slots * 2, np.float32).reshape(slots, 2).T


class Left:
    """Stretch and levels of every slot when the bit predicted there is taken out of its counts: looked up by slot * 2 + bit."""

    def __init__(self, table: np.ndarray):
        none, prior = np.float32(0), np.float32(PRIOR)
        n0, n1 = table
        self.stretch = np.empty((len(n0), 2), np.float32)
        self.stretch[:, 0] = np.log((n1 + prior) / (np.maximum(n0 - 1, none) + prior))
        self.stretch[:, 1] = np.log((np.maximum(n1 - 1, none) + prior) / (n0 + prior))
        self.stretch = self.stretch.ravel()
        self.level = _levels(table, 1)


def _level(table: np.ndarray, at: np.ndarray, k: int, less: int) -> np.ndarray:
    """The part of the gate that slots of predictor ``k``, one of the two with the longest contexts, give."""
    levels, times = (LEVELS_WORD, len(LEVELS_FOUR) + 1) if k == 4 else (LEVELS_FOUR, 1)
    return np.digitize(table[0][at] + table[1][at] - less, levels) * times


def _gate(table: np.ndarray, at: list[np.ndarray], less: int) -> np.ndarray:
    """The gate of each prediction, by how often its two longest contexts were seen."""
    return _level(table, at[4], 4, less) + _level(table, at[3], 3, less)


def _levels(table: np.ndarray, less: int) -> np.ndarray:
    """``_level`` of every slot, to be looked up; 0 for the other predictors."""
    out = np.zeros(table.shape[1], np.uint8)
    for k in (4, 3):
        part = slice(BASES[k], BASES[k + 1])
        out[part] = _level(table, part, k, less)
    return out


def learn_weights(vocab: DataFrame, shared) -> np.ndarray:
    """Mixing weights (gate, predictor): learned online in every block of the vocabulary, then averaged by words."""
    k = len(TABLE_BITS)

    def learn(batches):
        left = None
        for _, words in blocks(batches):
            left = left or Left(shared.value)
            weight = np.full((GATES, k), 0.3)
            words = words.take(np.argsort(mix(words.h), kind="stable"))
            for w in _chunks(words, STEP_WORDS):
                bits = Bits(w)
                for j in range(8):
                    at, bit = bits.slots(j)
                    # Its own part is taken out, as if the word had not been seen.
                    gate = (left.level.take(at[4]) + left.level.take(at[3])).astype(np.int64)
                    x, z = [], np.zeros(len(gate), np.float32)
                    for a, w_of in zip(at, weight.T.astype(np.float32)):
                        a <<= 1
                        a += bit
                        x.append(left.stretch.take(a, mode="clip"))
                        z += x[-1] * w_of.take(gate, mode="clip")
                    error = bit - 1 / (1 + np.exp(-np.minimum(np.maximum(z, -20), 20)))
                    many = np.maximum(1, np.bincount(gate, minlength=GATES))
                    step = np.stack([np.bincount(gate, error * i, minlength=GATES) for i in x], axis=1)
                    # The mean step of a gate, less where few predictions speak for it.
                    weight += RATE * step / many[:, None] * np.minimum(1, many / 32)[:, None]
            n = len(words)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(weight.size)), pa.array(weight.ravel() * n), pa.array(np.full(weight.size, float(n)))],
                                             ["at", "w", "n"])

    got = (vocab.mapInArrow(learn, "at long, w double, n double").groupBy("at")
           .agg((F.sum("w") / F.sum("n")).alias("w")).collect())
    out = np.full(GATES * k, 0.3)
    for r in got:
        if r["w"] is not None:
            out[r["at"]] = r["w"]
    return out.reshape(GATES, k)


class Model:
    """Tables and weights; ``bits_of`` gives the log10 probability of words from their bytes."""

    def __init__(self, table: np.ndarray, weight: np.ndarray):
        self.table, self.weight = table, weight.astype(np.float32)
        self.stretch = np.log((table[1] + np.float32(PRIOR)) / (table[0] + np.float32(PRIOR)))
        self.level = _levels(table, 0)

    def log10(self, words: Words) -> np.ndarray:
        out = [np.empty(0)]
        for w in _chunks(words, 1 << 13):
            bits = Bits(w)
            total = np.zeros(len(bits.byte), np.float32)
            for j in range(8):
                at, bit = bits.slots(j)
                gate = (self.level.take(at[4]) + self.level.take(at[3])).astype(np.int64)
                x = np.zeros(len(gate), np.float32)
                for a, w_of in zip(at, self.weight.T):
                    x += self.stretch.take(a, mode="clip") * w_of.take(gate, mode="clip")
                x *= np.float32(1) - np.float32(2) * bit
                total += np.maximum(x, 0) + np.log(1 + np.exp(-np.abs(x)))
            out.append(-np.bincount(bits.word, total, minlength=len(w)) / np.log(10))
        return np.concatenate(out)


_models: list = []


def _model(table, weight: np.ndarray) -> Model:
    """The model of a broadcast table, made once per process."""
    if not _models or _models[0] is not table.value:
        _models[:] = [table.value, Model(table.value, weight)]
    return _models[1]


def _known(count: np.ndarray, spelled: np.ndarray, n: float, v: float) -> np.ndarray:
    """log10 probability of words with these counts (0: not seen) and these log10 probabilities by their bytes."""
    free = DISCOUNT * v / n if n else 1.0
    return np.log10(np.maximum(count - DISCOUNT, 0) / max(n, 1.0) + free * 10.0 ** np.maximum(spelled, -290))


def score_texts(docs: DataFrame, modulus: int = 7, remainder: int = 2, frequent: int = FREQUENT) -> DataFrame:
    """Log10 probabilities of every whole text, with what they rest on.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-one unigrams), score (this model), n_bytes, bits_per_byte. The model
    learns from texts whose crc32(doc_id) modulo ``modulus`` is not
    ``remainder``. A null text is empty: one end token. Repeated rows are scored, and learned from,
    each; an empty table gives no rows; if no text may be learned from, every
    count is 0. Columns other than doc_id and text are ignored.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", "text").withColumn("held_out", held_out("doc_id", modulus, remainder))
    buckets = max(4, own.rdd.getNumPartitions())
    vocab = cut(vocabulary(own.filter(~F.col("held_out")), buckets), "vocabulary")
    sums = vocab.mapInArrow(_totals, "n long, v long").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    table = spark.sparkContext.broadcast(tables(vocab))
    weight = learn_weights(vocab, table)
    scored = cut(_scored(vocab, table, weight, n, v), "scored-words")
    top = spark.sparkContext.broadcast(_frequent(scored, frequent))
    chunks = cut(_chunks_of(own), "chunks")
    plain, others = code_of(_frequent(scored, running.CODED), n)
    code, bits = spark.sparkContext.broadcast(plain), running.slot_bits(n)
    counts = count_bits(chunks, code, bits)
    left_out = spark.sparkContext.broadcast(running.Mixer(plain, counts, bits, True))
    begin = learn_running_weights(chunks, left_out)
    left_out.unpersist()
    code.unpersist()
    mixer = spark.sparkContext.broadcast(running.Mixer(plain, counts, bits, False))
    key_bits = _key_bits(chunks)
    partial = cut(_documents(chunks, _packed_counts(chunks, key_bits), top, mixer, begin, others, own.schema["doc_id"].dataType.simpleString(), key_bits), "scored-texts", "zstd")
    rest = _rare(partial, scored, table, weight, buckets, n, v, others)
    joined = (partial.drop("h", "seen", "size", "raw", "after", "with", "path").alias("p").join(rest.alias("r"), "ref", "left")
              .select("doc_id", "held_out", "n_tokens", "n_bytes",
                      *[(F.col(f"p.{c}") + F.coalesce(F.col(f"r.{c}"), F.lit(0))).alias(c) for c in ("n_known", "base", *SUMS)]))
    best = F.greatest(*SUMS)
    score = best + F.log10(sum(F.pow(F.lit(10.0), F.col(c) - best) for c in SUMS) / len(EXPERTS))
    return (joined.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                          (F.col("base") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"),
                          score.alias("score"), "n_bytes")
            .withColumn("bits_per_byte", -F.col("score") * float(np.log2(10)) / F.col("n_bytes")))


def _totals(batches):
    for _, w in blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array([int(w.count.sum())], pa.int64()), pa.array([len(w)], pa.int64())], ["n", "v"])


_SCORED = "bucket long, h binary, count binary, score binary"


def _scored(vocab: DataFrame, table, weight: np.ndarray, n: int, v: int) -> DataFrame:
    """The words' hashes, counts and log10 probabilities, a block per bucket; see ``_read_scored``."""
    def emit(batches):
        for bucket, w in blocks(batches):
            score = _known(w.count, _model(table, weight).log10(w), n, v)
            h, count, _, _ = w.columns()
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), *(pa.array([x], pa.binary()) for x in (h, count, packed(score.astype(np.float32))))],
                                             ["bucket", "h", "count", "score"])

    return vocab.mapInArrow(emit, _SCORED)


def _read_scored(h: bytes, count: bytes, score: bytes) -> list[np.ndarray]:
    return [np.cumsum(unpacked(h, np.uint64), dtype=np.uint64), unpacked(count, np.int64), unpacked(score, np.float32)]


def _frequent(scored: DataFrame, most: int) -> list[np.ndarray]:
    """Hashes (sorted), counts and scores of at most ``most`` words, those above a count."""
    names = ("h", "count", "score")

    def level(count: np.ndarray) -> np.ndarray:
        return (8 * np.log2(np.maximum(count, 1))).astype(np.int64)

    def histogram(batches):
        for b in batches:
            for c in b.column(1).to_pylist():
                at, many = np.unique(level(unpacked(c, np.int64)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(many)], ["level", "n"])

    rows = scored.select(*names)
    least, total = None, 0
    for r in rows.mapInArrow(histogram, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        total += r["n"]
        if total > most:
            break
        least = r["level"]

    def pick(batches):
        for b in batches:
            for got in zip(*(c.to_pylist() for c in b.columns)):
                x = _read_scored(*got)
                at = level(x[1]) >= least
                yield pa.RecordBatch.from_arrays([pa.array([v[at].tobytes()], pa.binary()) for v in x], list(names))

    got = rows.mapInArrow(pick, ", ".join(f"{n} binary" for n in names)).collect() if least is not None else []
    out = [np.concatenate([np.empty(0, t), *(np.frombuffer(r[n], t) for r in got)]) for n, t in zip(names, (np.uint64, np.int64, np.float32))]
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _chunks_of(own: DataFrame) -> DataFrame:
    """(chunk, bytes, rows): the rows of ``own`` as Arrow streams of about ``CHUNK_BYTES`` of text."""
    def emit(batches):
        number, held, size, many = TaskContext.get().partitionId() << 16, [], 0, 0

        def flush():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
                out.write_table(table)
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()),
                                               pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "bytes", "rows"])

        for rows, raw, _ in slices(batches, 1):
            if held and (size + len(raw) > CHUNK_BYTES or many + rows.num_rows > CHUNK_ROWS):
                yield flush()
                number, held, size, many = number + 1, [], 0, 0
            held.append(rows)
            size, many = size + len(raw), many + rows.num_rows
        if held:
            yield flush()

    return own.select("doc_id", "text", "held_out").mapInArrow(emit, "chunk long, bytes long, rows binary")


class Part:
    """Some texts of a chunk: rows, lower-cased bytes, and start, end, text and hash of each word."""

    def __init__(self, rows: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray):
        self.rows, self.m, self.low = rows, rows.num_rows, LOWER[raw]
        self.starts, self.ends, self.owner = spans(self.low, offsets)
        self.h = span_hashes(self.low, self.starts, self.ends) if len(self.starts) else np.empty(0, np.uint64)

    def held_out(self) -> np.ndarray:
        return self.rows.column(2).to_numpy(zero_copy_only=False).astype(bool)

    def places(self) -> np.ndarray:
        """Of all words, then of each text's end, the place where the texts run on one after the other."""
        return np.concatenate([np.arange(len(self.h)) + self.owner, np.cumsum(np.bincount(self.owner, minlength=self.m)) + np.arange(self.m)])


def _batches(rows: bytes) -> list[pa.RecordBatch]:
    return pa.ipc.open_stream(rows).read_all().to_batches()


def _parts(rows: bytes) -> list[Part]:
    return [Part(*x) for x in slices(_batches(rows), 1)]


def _distinct(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct numbers (of ``bits``), and where each one is among them."""
    low = max(1, len(x).bit_length())
    if bits + low > 64 or not len(x):
        return np.unique(x, return_inverse=True)
    # Number and place in one, since sorting numbers is much faster than sorting places.
    both = np.sort(x << np.uint64(low) | np.arange(len(x), dtype=np.uint64))
    at = (both & np.uint64((1 << low) - 1)).astype(np.int64)
    both >>= np.uint64(low)
    new = np.concatenate([[True], both[1:] != both[:-1]])
    back = np.empty(len(x), np.int64)
    back[at] = np.cumsum(new) - 1
    return both[new], back


def _runs_of_parts(parts: list[Part], key_bits: int):
    """Of a chunk: the sorted distinct hashes (of ``key_bits``) of its contexts and runs, each token's place there, and whether it is learned from."""
    keys = [runs_of(p.h, p.owner, p.m) for p in parts]
    train = np.concatenate([~p.held_out()[np.concatenate([p.owner, np.arange(p.m)])] for p in parts])
    both = np.concatenate([k for pair in zip(*keys) for k in pair])
    del keys
    both >>= np.uint64(64 - key_bits)
    some, back = _distinct(both, key_bits)
    return some, back[:len(train)], back[len(train):], train


def _runs_of_chunk(rows: bytes, key_bits: int = 64):
    """The chunk's batches, and ``_runs_of_parts``."""
    return _batches(rows), *_runs_of_parts(_parts(rows), key_bits)


def _stream(parts: list[Part], code: running.Code) -> running.Stream:
    """The texts of a chunk as they run."""
    got, begin = [], [np.zeros(1, np.int64)]
    for p in parts:
        h, at = np.concatenate([p.h, np.full(p.m, END)]), p.places()
        one, two = _before(p.h, p.owner, p.m)
        run = [np.empty_like(h) for _ in range(3)]
        for to, x in zip(run, (h, one, _runs(p.h, p.m, one, two)[0])):
            to[at] = x
        got.append(run)
        begin.append(begin[-1][-1] + np.cumsum(np.bincount(p.owner, minlength=p.m) + 1))
    return running.Stream.of(code, *(np.concatenate(x) for x in zip(*got)), np.concatenate(begin))


def code_of(words: list[np.ndarray], n: int) -> tuple[running.Code, float]:
    """The code of the most frequent words, and log10 of what the static probabilities of all others add up to.

    A word seen once is one of those others, like one not seen.
    """
    often = words[1] > 1
    h, count, score = (x[often] for x in words)
    rest = max(1.0 - float((10.0 ** score.astype(np.float64)).sum()), 1e-6)
    return running.Code(h, count, n - int(count.sum())), float(np.log10(rest))


def _streams(batches, code: running.Code):
    """The texts of chunks as they run, and which are learned from."""
    for b in batches:
        for rows in b.column(0).to_pylist():
            parts = _parts(rows)
            yield _stream(parts, code), ~np.concatenate([p.held_out() for p in parts])


def count_bits(chunks: DataFrame, code, bits: int) -> np.ndarray:
    """How the tokens of all texts learned from go on in each context; see ``running.count``."""
    size = running.table_size(code.value, bits)

    def fill(batches):
        table = None
        for s, learned in _streams(batches, code.value):
            table = np.zeros(size, np.int64) if table is None else table
            running.count(code.value, s, np.flatnonzero(np.repeat(learned, np.diff(s.begin))), bits, table)
        return table

    return sum_tables(chunks.select("rows"), fill, size, np.float32)


def learn_running_weights(chunks: DataFrame, mixer) -> np.ndarray:
    """Weights (gate, input) that texts begin with: learned online along every text learned from, each token's own part
    taken out of the counts, then averaged by how often the texts used them."""
    k = running.INPUTS

    def learn(batches):
        total, many = np.zeros((running.GATES, k)), np.zeros(running.GATES, np.int64)
        for s, learned in _streams(batches, mixer.value.code):
            _, w, used = mixer.value.run(s, running.first_weights(), np.flatnonzero(learned), scored=False)
            total, many = total + w, many + used
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel()), pa.array(np.repeat(many, k))], ["at", "w", "n"])

    out = running.first_weights().ravel()
    for r in chunks.select("rows").mapInArrow(learn, "at long, w double, n long").groupBy("at").agg(F.sum("w").alias("w"), F.sum("n").alias("n")).collect():
        if r["n"]:
            out[r["at"]] = r["w"] / r["n"]
    return out.reshape(running.GATES, k)


def _key_bits(chunks: DataFrame) -> int:
    """Bits of the hashes of runs and contexts, by the size of the corpus: a token has a context and a run."""
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    return min(64, max(LEAST_BITS, bits_for(total, 1) + SPARE_BITS))


def _run_counts(chunks: DataFrame, key_bits: int = 64) -> DataFrame:
    """(chunk, bucket, counts): how often the texts learned from hold the chunk's contexts and runs, in the order of their hashes."""
    def plain(batches):
        for b in batches:
            counts = pa.array([unpacked(c, np.int64).astype(np.float32).tobytes() for c in b.column("counts").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("chunk"), b.column("bucket"), counts], ["chunk", "bucket", "counts"])
    return _packed_counts(chunks, key_bits).mapInArrow(plain, "chunk long, bucket long, counts binary")


def _packed_counts(chunks: DataFrame, key_bits: int) -> DataFrame:
    """The same with the counts packed, as they travel."""
    total = chunks.agg(F.sum("bytes")).first()[0] or 0
    bits = bits_for(total // 3, BUCKET_KEYS)

    def ask(batches):
        for b in batches:
            for chunk, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                some, context, run, train = _runs_of_parts(_parts(rows), key_bits)
                count = np.bincount(context[train], minlength=len(some)) + np.bincount(run[train], minlength=len(some))
                bucket = (some >> np.uint64(key_bits - bits)).astype(np.int64) if bits else np.zeros(len(some), np.int64)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(some)]])
                for a, z in zip(cuts, cuts[1:]):
                    yield pa.RecordBatch.from_arrays([pa.array([bucket[a]], pa.int64()), pa.array([chunk], pa.int64()),
                                                      pa.array([packed(np.diff(some[a:z], prepend=np.uint64(0)))], pa.binary()),
                                                      pa.array([packed(count[a:z].astype(np.uint32))], pa.binary())],
                                                     ["bucket", "chunk", "keys", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpacked(k, np.uint64), dtype=np.uint64) for k in table["keys"].to_pylist()]
        count = np.concatenate([unpacked(c, np.uint32) for c in table["counts"].to_pylist()])
        some, back = np.unique(np.concatenate(keys), return_inverse=True)
        found = np.bincount(back, count, minlength=len(some)).astype(np.int64)[back]
        ends = np.cumsum([len(k) for k in keys])
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"],
                         "counts": pa.array([packed(found[z - len(k):z]) for k, z in zip(keys, ends)], pa.binary())})

    return (chunks.select("chunk", "rows").mapInArrow(ask, "bucket long, chunk long, keys binary, counts binary")
            .groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, counts binary"))


def _with_experts(score: np.ndarray, seen: np.ndarray, n: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """log10 probabilities by each of ``EXPERTS``. ``seen`` is the word's share of the text so far, -1 where the text begins."""
    p, q, out = 10.0 ** np.maximum(score.astype(np.float64), -290), np.maximum(seen, 0), []
    begin = seen < 0
    by_context = {k: (c + k * p) / (n + k) for k in {k for _, k in EXPERTS}}
    for w, k in EXPERTS:
        out.append(np.log10(np.where(begin, by_context[k], (1 - w) * by_context[k] + w * q)))
    return out


def _of_path(path: np.ndarray, score: np.ndarray, others: float) -> np.ndarray:
    """log10 probability of tokens: that of a word of the code (given with the other sign), or of the escape and of the word among all that it stands for."""
    return np.where(path > 0, -path, path + np.minimum(score - others, 0))


def _documents(chunks: DataFrame, counts: DataFrame, top, mixer, weight: np.ndarray, others: float, kind: str, key_bits: int) -> DataFrame:
    """Per text what its frequent words give, and its other words with how often the text has used them before."""
    def emit(chunk: pa.Table, found: pa.Table):
        freq_h, freq_c, freq_s = top.value
        # A chunk has few enough texts.
        ref = chunk["chunk"][0].as_py() << 24
        parts = _parts(chunk["rows"][0].as_py())
        some, context, run, _ = _runs_of_parts(parts, key_bits)
        total = np.concatenate([np.empty(0, np.float32), *(unpacked(c, np.int64).astype(np.float32) for c in found.sort_by("bucket")["counts"].to_pylist())])
        if len(total) != len(some):
            raise ValueError(f"chunk {ref >> 24}: {len(total)} counts for {len(some)} hashes")
        s = _stream(parts, mixer.value.code)
        running_log, _, _ = mixer.value.run(s, weight)
        coded = s.symbol > 0
        running_log[coded] = np.maximum(-running_log[coded], np.float32(1e-12))
        del s, coded
        done = 0
        for part in parts:
            rows, m, low, starts, ends, owner, h = part.rows, part.m, part.low, part.starts, part.ends, part.owner, part.h
            words = np.bincount(owner, minlength=m)
            first = np.cumsum(words) - words
            place = np.arange(len(starts)) - first[owner]
            along_text = running_log[done:done + len(h) + m][part.places()]
            # How often the text has used the word before.
            here = mix(h + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(here, kind="stable")
            here = here[order]
            new = np.concatenate([[True], here[1:] != here[:-1]]) if len(h) else np.empty(0, bool)
            begin = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0)) if len(h) else np.empty(0, np.int64)
            before = np.empty(len(h))
            before[order] = np.arange(len(h)) - begin
            seen = np.where(place > 0, before / np.maximum(place, 1), -1.0)
            after, along = (total[x[done:done + len(h) + m]] for x in (context, run))
            # A slot that two runs share must not make a run more frequent than its context.
            along = np.minimum(along, after)
            done += len(h) + m
            # One end per text.
            h, owner = np.concatenate([h, np.full(m, END)]), np.concatenate([owner, np.arange(m)])
            seen = np.concatenate([seen, np.where(words > 0, 0.0, -1.0)])
            size = np.concatenate([ends - starts, np.zeros(m, np.int64)])
            starts = np.concatenate([starts, np.zeros(m, np.int64)])
            if len(freq_h):
                distinct, back = np.unique(h, return_inverse=True)
                at = np.minimum(np.searchsorted(freq_h, distinct), len(freq_h) - 1)
                hit = (freq_h[at] == distinct)[back]
                at = at[back]
                count, score = freq_c[at[hit]], freq_s[at[hit]]
            else:
                hit, count, score = np.zeros(len(h), bool), np.empty(0, np.int64), np.empty(0)
            mine = owner[hit]
            sums = [np.bincount(mine, x, minlength=m) for x in (np.log10(count + 1.0), *_with_experts(_of_path(along_text[hit], score, others), seen[hit], after[hit], along[hit]))]
            rare = np.flatnonzero(~hit)
            rare = rare[np.argsort(owner[rare], kind="stable")]
            cuts = np.concatenate([[0], np.cumsum(np.bincount(owner[rare], minlength=m))])
            lists = [h[rare], seen[rare].astype(np.float32), after[rare], along[rare], along_text[rare], size[rare].astype(np.int32)]
            letters = ragged(low, starts[rare], size[rare])
            letter_cuts = np.concatenate([[0], np.cumsum(size[rare])])[cuts]
            binary = [pa.array([x[a:z].tobytes() for a, z in zip(cuts, cuts[1:])], pa.binary()) for x in lists]
            binary.append(pa.array([letters[a:z].tobytes() for a, z in zip(letter_cuts, letter_cuts[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ref + np.arange(m)), rows.column(0), rows.column(2), pa.array(words + 1), pa.array(np.bincount(mine, minlength=m)),
                 # Bytes as scored: each word and a space, and one for the end.
                 pa.array(np.bincount(owner, size + 1.0, minlength=m).astype(np.int64)), *(pa.array(t, pa.float64()) for t in sums), *binary],
                ["ref", "doc_id", "held_out", "n_tokens", "n_known", "n_bytes", "base", *SUMS, "h", "seen", "after", "with", "path", "size", "raw"])
            ref += m

    def whole(chunk: pa.Table, found: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(emit(chunk, found)))

    return chunks.select("chunk", "rows").groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(
        whole, f"ref long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, n_bytes long, base double, "
              + ", ".join(f"{s} double" for s in SUMS) + ", h binary, seen binary, after binary, with binary, path binary, size binary, raw binary")


def _rare(partial: DataFrame, scored: DataFrame, table, weight: np.ndarray, buckets: int, n: int, v: int, others: float) -> DataFrame:
    """Per text (ref) what its other words give."""
    extra = [("seen", np.float32), ("after", np.float32), ("with", np.float32), ("path", np.float32)]
    columns = ["bucket", "h", "count", "size", "raw", *(c for c, _ in extra)]

    def deal(batches):
        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            lens = [len(x) // 8 for x in col["h"].to_pylist()]

            def whole(name, kind):
                return np.frombuffer(b"".join(col[name].to_pylist()), kind)

            # The count of a token is the text that holds it.
            w = Words(whole("h", np.uint64), np.repeat(col["ref"].to_numpy(), lens), whole("size", np.int32), whole("raw", np.uint8))
            more = [whole(c, t) for c, t in extra]
            bucket = (w.h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[k]:cuts[k + 1]]
                yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int64()), *(
                    pa.array([c], pa.binary()) for c in (*w.take(at).columns(), *(x[at].tobytes() for x in more)))], columns)

    def meet(tokens: pa.Table, words: pa.Table) -> pa.Table:
        names = ["ref", "n_known", "base", *SUMS]
        if not tokens.num_rows:
            return pa.table({c: pa.array([], pa.int64() if c in names[:2] else pa.float64()) for c in names})
        w = Words.join([Words.read(*r) for r in zip(*(tokens[c].to_pylist() for c in ("h", "count", "size", "raw")))])
        *more, path = [np.concatenate([np.frombuffer(x, t) for x in tokens[c].to_pylist()]) for c, t in extra]
        empty = [np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.float32)]
        blocks_of = [_read_scored(*r) for r in zip(*(words[name].to_pylist() for name in ("h", "count", "score")))]
        h, c, s = (np.concatenate(x) for x in zip(empty, *blocks_of))
        some, first, back = np.unique(w.h, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(h, some), max(0, len(h) - 1))
        known = (h[at] == some) if len(h) else np.zeros(len(some), bool)
        count, score = np.zeros(len(some), np.int64), np.zeros(len(some))
        count[known], score[known] = c[at[known]], s[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            score[new] = _known(np.zeros(len(new)), _model(table, weight).log10(w.take(first[new])), n, v)
        refs, of = np.unique(w.count, return_inverse=True)
        parts = [np.log10(count[back] + 1.0), *_with_experts(_of_path(path, score[back], others), *more)]
        out = [refs, np.bincount(of, known[back]).astype(np.int64), *(np.bincount(of, p) for p in parts)]
        return pa.table({name: pa.array(o) for name, o in zip(names, out)})

    tokens = (partial.select("ref", "h", "size", "raw", *(c for c, _ in extra))
              .mapInArrow(deal, ", ".join(f"{c} {'long' if c == 'bucket' else 'binary'}" for c in columns)))
    right = scored.withColumnRenamed("bucket", "of")
    return (tokens.groupBy("bucket").cogroup(right.groupBy("of"))
            .applyInArrow(meet, "ref long, n_known long, base double, " + ", ".join(f"{s} double" for s in SUMS))
            .groupBy("ref").agg(*[F.sum(c).alias(c) for c in ("n_known", "base", *SUMS)]))


def op1_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))
