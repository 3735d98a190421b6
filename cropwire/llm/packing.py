"""Best-fit packing of tokenised documents by linear grouping.

Lengths are whole numbers up to the capacity, so the packing is decided on a
histogram (at most ``capacity`` rows whatever the data's size): large lengths
are split into groups of equal cardinality and rounded up to their group's
largest, a linear program over configurations of the few rounded sizes says how
often to use each, actual lengths replace the rounded ones, and everything else
goes best-fit, longest first, into the gaps. All of it handles runs of equal
sequences, never single ones. The plan is a table of intervals: the pieces of
one length with ranks from a to b go to sequences s, s+1, ... at one offset.
Ranks within a length come from hash-range buckets, so a frequent length is
never in one task.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cropwire.llm.common import bits_for, cut, offsets, place_of, read_table, top_bits

CAPACITY = 2048
#: Lengths over such a share of the capacity are grouped and configured, shorter ones best-fit.
#: Tried in turn until a plan is within ``NEAR`` of the least possible number of sequences; else the best is kept.
LARGE_SHARES = (1 / 2, 2 / 5, 1 / 4)
NEAR = 1.001
#: Groups of equal cardinality, so also the number of rounded sizes.
GROUPS = 64
#: Pieces of one bucket of the rank order.
ROWS_PER_BUCKET = 1 << 16
#: End-of-document id.
END_ID = 0
#: Pre-tokenisation of the byte-level vocabulary (fixed value of its public format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space as SPLIT has it; runs of ``LONG_RUN`` characters or more are encoded apart, as tiktoken's split fails on about a million.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
LONG_RUN = 1 << 16
#: A split that leaves a text in one piece.
WHOLE = r"(?s:.+)"

_encoders: dict = {}
_id_functions: dict = {}


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str, split: str = SPLIT):
    """The vocabulary file's byte-level BPE, loaded once per process and kind of split.

    The merges of this format are numbered in rank order, so the ids serve as
    ranks for a faster implementation that gives the same ids; a test holds the
    two against each other.
    """
    if (path, split) not in _encoders:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {t["id"] for t in model.get("added_tokens", [])}
        # The format writes bytes as printable characters: printable Latin-1 as itself, the others from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte[c] for c in token): i for token, i in model["model"]["vocab"].items() if i not in special}
        _encoders[path, split] = tiktoken.Encoding("byte_bpe", pat_str=split, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path, split]


def id_function(path: str, added_tokens: bool = False):
    """A function from a text to its ids, without the end id; made once per process.

    With ``added_tokens`` the added tokens of the file are found in the text and
    become their own ids, as ``tokenizers`` does by default; else they are plain text.
    """
    if (path, added_tokens) not in _id_functions:
        plain = encoder(path)
        space = re.compile(SPACE)

        def ids_of(text: str) -> list[int]:
            if len(text) < LONG_RUN:
                return plain.encode_ordinary(text)
            out, at = [], 0
            for m in space.finditer(text):
                if m.end() - m.start() < LONG_RUN:
                    continue
                # The split makes one piece of a run, less its last character if text follows; what precedes it ends a piece.
                end = m.end() if m.end() == len(text) else m.end() - 1
                out += plain.encode_ordinary(text[at:m.start()]) + encoder(path, WHOLE).encode_ordinary(text[m.start():end])
                at = end
            return out + plain.encode_ordinary(text[at:])

        _id_functions[path, added_tokens] = _split_at_added(path, ids_of) if added_tokens else ids_of
    return _id_functions[path, added_tokens]


def _split_at_added(path: str, ids_of):
    """``ids_of`` for the texts between the file's added tokens."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    added = {t["content"]: t for t in model.get("added_tokens", [])}
    if not added:
        return ids_of
    # Leftmost, then longest.
    found = re.compile("(" + "|".join(re.escape(c) for c in sorted(added, key=len, reverse=True)) + ")")
    if model.get("normalizer") or any(t[k] for t in added.values() for k in ("single_word", "lstrip", "rstrip", "normalized")):
        from tokenizers import Tokenizer
        library = Tokenizer.from_file(path)
        return lambda text: library.encode(text, add_special_tokens=False).ids if found.search(text) else ids_of(text)

    def split(text: str) -> list[int]:
        parts = found.split(text)
        out = list(ids_of(parts[0]))
        for token, rest in zip(parts[1::2], parts[2::2]):
            out.append(added[token]["id"])
            out += ids_of(rest)
        return out

    return split


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Tokenised pieces: doc_id, piece, start, length, ids_crc32 (and ids, as little-endian bytes).

    A document is its text's ids and the end id; a null text counts as empty.
    With ``added_tokens`` the vocabulary's added tokens in a text have their own ids.
    Only documents longer than ``capacity`` are cut; the first piece is then
    the short one.
    """
    path = path or vocabulary_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def tokenise(batches):
        encode = id_function(path, added_tokens)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                owner, rows, ids_out = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = np.array([*encode(text or ""), END_ID], "<u4")
                    total = len(ids)
                    first = total if total <= capacity else (total % capacity or capacity)
                    edges = [0, *range(first, total + 1, capacity)]
                    for n, (a, z) in enumerate(zip(edges, edges[1:])):
                        raw = ids[a:z].tobytes()
                        owner.append(i)
                        rows.append((n, a, z - a, zlib.crc32(raw)))
                        if keep_ids:
                            ids_out.append(raw)
                cols = list(zip(*rows))
                arrays = [part.column(0).take(pa.array(owner)), pa.array(cols[0], pa.int32()),
                          *[pa.array(c, pa.int64()) for c in cols[1:]]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays, names = [*arrays, pa.array(ids_out, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select("doc_id", "text").mapInArrow(tokenise, schema)


class Runs:
    """Runs of equal sequences by their gap, and the intervals that fill them."""

    def __init__(self, capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.by_gap: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first sequence, how many)
        self.used: dict[int, int] = defaultdict(int)  # length -> pieces placed so far
        self.intervals: list[tuple[int, int, int, int, int]] = []  # length, rank from, count, first sequence, offset

    def place(self, length: int, first: int, n: int, offset: int) -> None:
        self.intervals.append((length, self.used[length], n, first, offset))
        self.used[length] += n

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def best_fit(self, length: int, count: int) -> None:
        """``count`` pieces of one length, each into the smallest gap that takes it, then into new sequences."""
        while count:
            gap = next((g for g in range(length, self.capacity + 1) if self.by_gap.get(g)), None)
            if gap is None:
                self.by_gap[self.capacity].append((self.open(-(-count // (self.capacity // length))), -(-count // (self.capacity // length))))
                continue
            first, n = self.by_gap[gap].pop()
            each = min(gap // length, count)
            take = min(n, count // each)
            if take < n:
                self.by_gap[gap].append((first + take, n - take))
            for i in range(each):
                self.place(length, first, take, self.capacity - gap + i * length)
            self.by_gap[gap - each * length].append((first, take))
            count -= each * take


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """How often to use which configuration of the sizes: column generation, rounded down."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    want = np.array(demand, float)
    for _ in range(40 * k):
        price = np.linalg.solve(basis.T, np.ones(k))
        column = _knapsack(sizes, price, capacity)
        if price @ column <= 1 + 1e-9:
            break
        use, into = np.linalg.solve(basis, want), np.linalg.solve(basis, column)
        ratio = np.where(into > 1e-12, use / np.where(into > 1e-12, into, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = column
    use = np.floor(np.linalg.solve(basis, want) + 1e-9).astype(int)
    return [(basis[:, j].astype(int), int(use[j])) for j in range(k) if use[j] > 0]


def _knapsack(sizes: list[int], price: np.ndarray, capacity: int) -> np.ndarray:
    """The most valuable configuration that fits."""
    size = np.array(sizes)
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(size.min()), capacity + 1):
        value = np.where(size <= room, price + best[np.maximum(room - size, 0)], -1.0)
        j = int(np.argmax(value))
        best[room], choice[room] = best[room - 1], -1
        if value[j] > best[room - 1] + 1e-12:
            best[room], choice[room] = value[j], j
    out, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            out[choice[room]] += 1
            room -= size[choice[room]]
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         large_shares: tuple[float, ...] = LARGE_SHARES) -> Runs:
    """Pack ``histogram`` (length -> pieces) into few sequences of ``capacity``."""
    least = -(-sum(x * n for x, n in histogram.items()) // capacity)
    best = None
    for share in large_shares:
        runs = _plan(histogram, capacity, groups, share)
        if best is None or runs.sequences < best.sequences:
            best = runs
        if best.sequences <= least * NEAR:
            break
    return best


def _plan(histogram: dict[int, int], capacity: int, groups: int, large_share: float) -> Runs:
    runs, left = Runs(capacity), dict(histogram)
    if full := left.pop(capacity, 0):
        runs.place(capacity, runs.open(full), full, 0)
    large = sorted((x for x in left if x > capacity * large_share), reverse=True)
    total = sum(left[x] for x in large)
    if total:
        # Groups of equal cardinality, longest first: each a list of (length, pieces).
        grouped: list[list[list[int]]] = [[]]
        per, room = -(-total // groups), -(-total // groups)
        for x in large:
            n = left[x]
            while n:
                take = min(n, room)
                grouped[-1].append([x, take])
                n, room = n - take, room - take
                if not room:
                    grouped.append([])
                    room = per
        grouped = [g for g in grouped if g]
        chosen = configurations([g[0][0] for g in grouped], [sum(n for _, n in g) for g in grouped], capacity)
        for shape, times in chosen:
            slots = [j for j, many in enumerate(shape) for _ in range(many)]
            while times:
                # Substitute actual lengths: as many sequences as every slot's next length allows.
                need = {j: slots.count(j) for j in set(slots)}
                if any(sum(n for _, n in grouped[j]) < m for j, m in need.items()):
                    break
                picks, run = [], times
                for j, m in need.items():
                    pick, at = [], 0
                    while m:
                        x, n = grouped[j][at]
                        here = min(m, n)
                        run = min(run, n // here)
                        pick.append((x, here))
                        m, at = m - here, at + 1
                    picks.append((j, pick))
                first, offset = runs.open(run), 0
                for j, pick in picks:
                    for x, here in pick:
                        for _ in range(here):
                            runs.place(x, first, run, offset)
                            offset += x
                        entry = next(e for e in grouped[j] if e[0] == x)
                        entry[1] -= here * run
                        left[x] -= here * run
                    grouped[j] = [e for e in grouped[j] if e[1]]
                runs.by_gap[capacity - offset].append((first, run))
                times -= run
    for x in sorted((x for x, n in left.items() if n), reverse=True):
        runs.best_fit(x, left[x])
    return runs


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every piece a sequence_id and an offset; keeps the other columns of ``pieces``.

    ``pieces`` must come from a stored table: it is read more than once.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    intervals = sorted(plan(histogram, capacity).intervals)
    bits = bits_for(sum(histogram.values()), ROWS_PER_BUCKET)
    names = pieces.columns
    rows = (pieces.withColumn("place_", place_of("doc_id", "piece", "ids_crc32"))
            .withColumn("bucket_", top_bits(F.col("place_"), bits)))
    sums = rows.groupBy("length", "bucket_").agg(F.count(F.lit(1)).alias("n_"))
    before = offsets(sums, ["length"], "bucket_", "n_", bits).select(
        F.col("length").alias("length_"), F.col("bucket_").alias("at_"), "before")
    order = Window.partitionBy("length", "bucket_").orderBy("place_", "doc_id", "piece", "ids_crc32")
    ranked = (rows.withColumn("rank_", F.row_number().over(order) - 1)
              .join(before, (F.col("length") == F.col("length_")) & (F.col("bucket_") == F.col("at_")))
              .select(*names, (F.col("rank_") + F.col("before")).alias("rank_")))
    starts = np.array([(x << 42) + r for x, r, *_ in intervals], np.int64)
    table = np.array([(r, s, o) for _, r, _, s, o in intervals], np.int64).reshape(-1, 3)
    # Bounded by the capacity: runs of equal sequences, not sequences.
    shared = pieces.sparkSession.sparkContext.broadcast((starts, table))

    def locate(batches):
        starts, table = shared.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank_"))
            found = table[np.searchsorted(starts, (length << 42) + rank, side="right") - 1]
            keep = [b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(found[:, 1] + rank - found[:, 0]), pa.array(found[:, 2])],
                                             [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(locate, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, keep_ids: bool = False, added_tokens: bool = False) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens; one row per piece.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and
    ids with ``keep_ids``). A null or empty text is one end id. Repeated rows
    are packed as often as they come; an empty table gives no rows; columns
    other than doc_id and text are ignored. ``added_tokens``: see ``pieces_of``;
    the registered queries set it.
    """
    return place_pieces(cut(pieces_of(docs, capacity, path, keep_ids, added_tokens), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences: sequence_id, ids (array), and the documents in it with their offsets.

    ``packed`` comes from ``pack_documents(..., keep_ids=True)``; a sequence
    holds at most ``capacity`` tokens, so a group is bounded.
    """
    def join_up(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("offset")
        ids = np.frombuffer(b"".join(t["ids"].to_pylist()), "<u4").astype(np.int32)
        return pa.table({"sequence_id": [key[0].as_py()], "ids": pa.array([ids], pa.list_(pa.int32())),
                         "offsets": pa.array([t["offset"].to_pylist()], pa.list_(pa.int64())),
                         "doc_ids": pa.array([t["doc_id"].to_pylist()], pa.list_(pa.int64()))})

    return packed.groupBy("sequence_id").applyInArrow(
        join_up, "sequence_id long, ids array<int>, offsets array<long>, doc_ids array<long>")


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), added_tokens=True)
