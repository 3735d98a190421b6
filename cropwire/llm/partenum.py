"""Similarity join of word-shingle sets by PartEnum signatures.

A document is the set of its distinct five-word shingles, hashed to 64 bits. Two
sets with similarity of at least 0.8 differ in at most (a + b) / 9 elements. For
each band of sizes the feature domain is split into partitions, somewhat more
than can differ; a signature is a partition with its content. As two linked
sets agree on all partitions but those that hold a differing element, and every
set lists its partitions in one order that depends on their content alone
(fullest first), the first k + 1 of each list must share one, k being the most
elements in which the set can differ from a partner in that band. A set signs
for its own band, and for the next one if a partner can lie there.

Sets that share a signature are not paired with each other but with one of them,
the one that shares most overall, and checked on their exact sets. (Each task
settles its own groups first, so a frequent signature sends one row per task.) Where a signature's sets still lie in several
components, all pairs across components are weighed in tiles by a bound that
loses no link (sizes, and the distance of bucket histograms), and those within
the bound are checked exactly as well. So no link between components is lost
and groups of near copies do not square.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cropwire.llm.common import cut, read_table
from cropwire.llm.words import LOWER, mix, slices, span_hashes, spans

SHINGLE = 5
#: Similarity, as a fraction.
NUMERATOR, DENOMINATOR = 4, 5
#: Partitions of a band, as a multiple of the most that can differ plus one.
SPARE = 1.3
#: Buckets of the histogram that bounds the difference of two sets.
SKETCH = 256
#: Signatures that a task holds before it passes them on, and that one signature bucket holds on average.
HELD = 1 << 20
#: Members of one tile side when the sets of one signature are weighed pairwise.
TILE = 512
#: Bits of the fixed-size filter of documents whose sets are needed.
FILTER_BITS = 1 << 24

_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and where each text's set begins and ends."""
    starts, ends, owner = spans(LOWER[raw], offsets)
    n = len(offsets) - 1
    words = np.bincount(owner, minlength=n)
    h = span_hashes(LOWER[raw], starts, ends) if len(starts) else np.empty(0, np.uint64)
    if len(h) >= SHINGLE:
        last = len(h) - SHINGLE + 1
        grams = sum((h[j:last + j] * _STEP[j] for j in range(1, SHINGLE)), h[:last] * _STEP[0])
        inside = owner[:last] == owner[SHINGLE - 1:]
        grams, of = mix(grams[inside]), owner[:last][inside]
    else:
        grams, of = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if len(short):
        first = np.searchsorted(owner, short)
        whole = [mix(np.array([(h[f:f + words[d]] * _STEP[:words[d]]).sum() + np.uint64(words[d])]))[0] for d, f in zip(short, first)]
        grams, of = np.concatenate([grams, np.array(whole, np.uint64)]), np.concatenate([of, short])
    order = np.lexsort((grams, of))
    grams, of = grams[order], of[order]
    if len(grams):
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
        grams, of = grams[new], of[new]
    return grams, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int64)


def _sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def set_keys(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """One number per set; equal sets have equal numbers."""
    return mix(_sums(mix(grams ^ _STEP[1]), edges) + np.diff(edges).astype(np.uint64)).view(np.int64)


def sketches(grams: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Histogram of each set over hash buckets, clipped to a byte (clipping only shrinks a difference)."""
    n = len(edges) - 1
    of = np.repeat(np.arange(n), np.diff(edges))
    # By low bits: the partitions go by high bits.
    count = np.bincount(of * SKETCH + (grams & np.uint64(SKETCH - 1)).astype(np.int64), minlength=n * SKETCH)
    return np.minimum(count, 255).astype(np.uint8).reshape(n, SKETCH)


def most_different(small, large):
    """The most elements in which linked sets of these sizes can differ."""
    return (small + large) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)


def signatures(grams: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set number) pairs of all sets."""
    size = np.diff(edges)
    band = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
    reach = size * DENOMINATOR // NUMERATOR  # the largest partner
    content = mix(grams ^ _STEP[2])
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(content, out=total[1:])
    sig, owner = [], []
    for ahead in (0, 1):
        low, high = np.int64(1) << (band + ahead), (np.int64(1) << (band + ahead + 1)) - 1
        at = np.flatnonzero((size > 0) & (reach >= low))
        if not len(at):
            continue
        parts = np.ceil(SPARE * (most_different(high[at], high[at]) + 1)).astype(np.int64)
        keep = most_different(size[at], np.minimum(high[at], reach[at])) + 1
        base = np.concatenate([[0], np.cumsum(parts)])
        of = np.repeat(np.arange(len(at)), size[at])
        take = np.repeat(edges[at], size[at]) + np.arange(len(of)) - np.repeat(np.cumsum(size[at]) - size[at], size[at])
        part = ((grams[take] >> np.uint64(32)) * parts[of].astype(np.uint64)) >> np.uint64(32)
        count = np.bincount(base[of] + part.astype(np.int64), minlength=base[-1])
        # Sets are sorted, so a partition is a run of its set.
        ends = np.cumsum(count)
        begins = ends - count
        sums = np.zeros(len(take) + 1, np.uint64)
        np.cumsum(content[take], out=sums[1:])
        held = sums[ends] - sums[begins]
        mine = np.repeat(np.arange(len(at)), parts)
        number = np.arange(base[-1]) - base[mine]
        order = np.lexsort((number, -count, mine))
        first = order[np.arange(len(order)) - base[mine[order]] < keep[mine[order]]]
        tag = mix(number[first].astype(np.uint64) * _STEP[3] + (band[at][mine[first]] + ahead).astype(np.uint64) * _STEP[4] + np.uint64(1))
        sig.append(mix(held[first] + tag))
        owner.append(at[mine[first]])
    if not sig:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(sig), np.concatenate(owner)


def _groups(sig: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (signature, key) sorted by both, with each row's least key and its signature's number of keys."""
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    if len(sig):
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
    head = np.ones(len(sig), bool)
    head[1:] = sig[1:] != sig[:-1]
    number = np.cumsum(head) - 1
    first = np.flatnonzero(head)
    return sig, key, (key[first][number] if len(sig) else key), (np.bincount(number)[number] if len(sig) else number)


_BLOCK = "bucket long, sigs binary, keys binary, done boolean"
_MEMBER = "sig long, key long"
_PAIR = "a long, b long, doc_a long, doc_b long"


def _block(bucket, sig, key, done):
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([sig.tobytes()], pa.binary()),
                                       pa.array([key.tobytes()], pa.binary()), pa.array([done], pa.bool_())],
                                      ["bucket", "sigs", "keys", "done"])


def shared_signatures(docs: DataFrame, shingles: int) -> DataFrame:
    """(sig, key): the sets that share a signature with another set, at least once each."""
    buckets = max(1, ceil(shingles * 0.33 / HELD))

    def emit(batches):
        held, count, turn = [], 0, 0

        def flush():
            nonlocal held, count, turn
            sig, key, hub, many = _groups(*(np.concatenate(x) for x in zip(*held)))
            held, count = [], 0
            # Groups within the task are settled here; one row of each goes on to meet other tasks' rows.
            local = many > 1
            if local.any():
                yield _block((turn * 7919 + int(sig[0] >> np.uint64(40))) % buckets, sig[local], key[local], True)
                turn += 1
            sig, key = sig[key == hub], key[key == hub]
            bucket = ((sig >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)):
                yield _block(int(b), sig[cuts[b]:cuts[b + 1]], key[cuts[b]:cuts[b + 1]], False)

        for _, raw, offsets in slices(batches, 0):
            grams, edges = shingle_sets(raw, offsets)
            sig, of = signatures(grams, edges)
            held.append((sig, set_keys(grams, edges)[of]))
            count += len(sig)
            if count >= HELD:
                yield from flush()
        if count:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        out = [[], []]
        sig, key = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for s, k, done in zip(*(table[c].to_pylist() for c in ("sigs", "keys", "done"))):
            s, k = np.frombuffer(s, np.uint64), np.frombuffer(k, np.int64)
            if done:
                for o, v in zip(out, (s, k)):
                    o.append(v)
            else:
                sig.append(s)
                key.append(k)
        sig, key, _, many = _groups(np.concatenate(sig), np.concatenate(key))
        for o, v in zip(out, (sig[many > 1], key[many > 1])):
            o.append(v)
        return pa.table({n: pa.array(np.concatenate(o).view(np.int64), pa.int64()) for n, o in zip(("sig", "key"), out)})

    return docs.select("text").mapInArrow(emit, _BLOCK).groupBy("bucket").applyInArrow(meet, _MEMBER)


def star_pairs(shared: DataFrame) -> DataFrame:
    """(a, b): every set that shares a signature, with the signature's hub.

    The hub is the set that shares most overall: among edited copies that is
    the text they were made from, which is closer to each than they are to each other.
    """
    sizes = shared.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    weights = shared.join(sizes, "sig").groupBy("key").agg(F.sum("n").alias("weight"))
    hubs = shared.join(weights, "key").groupBy("sig").agg(F.max(F.struct("weight", "key"))["key"].alias("hub"))
    return shared.join(hubs, "sig").filter("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()


def document_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key, sketch) of every document; key and sketch are null for an empty set."""
    def measure(batches):
        for rows, raw, offsets in slices(batches, 1):
            grams, edges = shingle_sets(raw, offsets)
            n = np.diff(edges)
            none = n == 0
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(set_keys(grams, edges), pa.int64(), mask=none),
                 pa.array([s.tobytes() for s in sketches(grams, edges)], pa.binary(), mask=none)], ["doc_id", "n_shingles", "key", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(measure, f"doc_id {kind}, n_shingles long, key long, sketch binary")


def within_bound(n_a, sketch_a: np.ndarray, n_b, sketch_b: np.ndarray) -> np.ndarray:
    """False only for pairs that cannot be linked: sizes too far apart, or histograms that differ by more elements than allowed."""
    small, large = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    apart = np.abs(sketch_a.astype(np.int16) - sketch_b).sum(axis=-1)
    return (small * DENOMINATOR >= large * NUMERATOR) & (apart <= most_different(small, large))


def _filter_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of set keys that the bound lets pass, with the document that stands for either set."""
    a = classes.select(F.col("key").alias("a"), F.col("doc").alias("doc_a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    b = classes.select(F.col("key").alias("b"), F.col("doc").alias("doc_b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))

    def weigh(batches):
        for t in batches:
            sk = [np.frombuffer(b"".join(t.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH) for i in (6, 7)]
            ok = within_bound(t.column(4).to_numpy(), sk[0], t.column(5).to_numpy(), sk[1])
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok)) for c in t.columns[:4]], ["a", "b", "doc_a", "doc_b"])

    return (pairs.join(a, "a").join(b, "b").select("a", "b", "doc_a", "doc_b", "n_a", "n_b", "sketch_a", "sketch_b")
            .mapInArrow(weigh, _PAIR))


def _wanted(ids: DataFrame) -> np.ndarray:
    """A bit set of fixed size that holds the hashes of ``ids`` (a filter before the join; a full one only stops sparing work)."""
    size = FILTER_BITS // 8
    parts = 16

    def bits(batches):
        flag = np.zeros(FILTER_BITS, bool)
        for b in batches:
            flag[b.column(0).to_numpy() % FILTER_BITS] = True
        packed = np.packbits(flag).reshape(parts, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([p.tobytes() for p in packed], pa.binary())], ["part", "bits"])

    def either(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, np.uint8) for x in table["bits"].to_pylist()]
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "bits": pa.array([np.bitwise_or.reduce(rows).tobytes()], pa.binary())})

    hashed = ids.select(F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS)).alias("h"))
    got = {r["part"]: r["bits"] for r in hashed.coalesce(64).mapInArrow(bits, "part int, bits binary").groupBy("part")
           .applyInArrow(either, "part int, bits binary").collect()}
    return np.unpackbits(np.frombuffer(b"".join(got[p] for p in sorted(got)) or bytes(size), np.uint8)).astype(bool)


def verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose exact sets are similar enough, as documents (a, b). ``pairs`` is read more than once."""
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(_wanted(
        pairs.select(F.col("doc_a").alias("doc")).union(pairs.select("doc_b")))))

    def sets(batches):
        flag = np.unpackbits(wanted.value).astype(bool)

        def needed():
            for b in batches:
                yield b.filter(pa.array(flag[b.column(1).to_numpy()]))

        for _, raw, offsets in slices(needed(), 0):
            grams, edges = shingle_sets(raw, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(set_keys(grams, edges), pa.int64()),
                                              pa.array([_pack(grams[a:z]) for a, z in zip(edges, edges[1:])], pa.binary())], ["key", "grams"])

    texts = (docs.filter(F.col("doc_id").isNotNull())
             .select("text", F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER_BITS)).alias("h")))
    # By the sets' keys, not their documents': rows that repeat an id may hold other texts.
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    held = cut(texts.mapInArrow(sets, "key long, grams binary").join(keys, "key", "left_semi").dropDuplicates(["key"]), "sets")

    def check(batches):
        for t in batches:
            ok = [_linked(x, y) for x, y in zip(t.column(2).to_pylist(), t.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in t.columns[:2]], ["a", "b"])

    left = held.select(F.col("key").alias("a"), F.col("grams").alias("grams_a"))
    right = held.select(F.col("key").alias("b"), F.col("grams").alias("grams_b"))
    return (pairs.join(left, "a").join(right, "b").select("doc_a", "doc_b", "grams_a", "grams_b")
            .mapInArrow(check, "a long, b long"))


def _pack(grams: np.ndarray) -> bytes:
    """The six high bytes of each hash."""
    return np.ascontiguousarray(grams.view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _linked(x: bytes, y: bytes) -> bool:
    a, b = (np.frombuffer(v, "V6") for v in (x, y))
    wide = []
    for v in (a, b):
        full = np.zeros((len(v), 8), np.uint8)
        full[:, :6] = v.view(np.uint8).reshape(-1, 6)
        wide.append(full.view(np.uint64).ravel())
    both = np.concatenate(wide)
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common * DENOMINATOR >= (len(both) - common) * NUMERATOR


def components(links: DataFrame) -> DataFrame:
    """(doc, component): the least id reachable, for every id in ``links`` (a, b).

    Edges point from the larger to the smaller id. In each round every id keeps
    its least neighbour as parent, hands its other smaller neighbours on to that
    parent, and all edges move to their target's parent, until every edge ends
    at an id without a parent. Edges shrink to one per id.
    """
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        parents = cut(edges.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("parent")), "parents")
        roots = parents.join(parents.select(F.col("doc").alias("of")), F.col("parent") == F.col("of"), "left_semi").limit(1).count() == 0
        if roots and edges.count() == parents.count():
            ends = parents.select("doc", F.col("parent").alias("component"))
            return ends.union(ends.select("component", "component")).distinct()
        handed = (edges.join(parents, F.col("a") == F.col("doc"))
                  .select(F.when(F.col("b") == F.col("parent"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("parent").alias("b")).distinct())
        moved = (handed.join(parents, F.col("b") == F.col("doc"), "left")
                 .select("a", F.coalesce("parent", "b").alias("b")).distinct())
        edges = cut(moved, "edges")


def _unsettled(shared: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of sets across components that share a signature and pass the bound."""
    of = (classes.join(labels, classes["doc"] == labels["doc"], "left")
          .select("key", classes["doc"], "n", "sketch", F.coalesce("component", classes["doc"]).alias("component")))
    members = shared.select("sig", "key").join(of.select("key", "component"), "key")
    groups = (members.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                         F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("who"), F.approx_count_distinct("key").alias("about"),
                                         F.count(F.lit(1)).alias("rows"))
              .filter("low <> high").groupBy("who").agg(F.min("sig").alias("sig"), F.max("rows").alias("rows")))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("rows") / TILE)).cast("int")
    rows = (shared.select("sig", "key").distinct().join(groups.select("sig", tiles.alias("tiles")), "sig").join(of, "key")
            .withColumn("tile", F.pmod(F.xxhash64("key", "sig"), F.col("tiles")).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("sig", "key", "doc", "n", "sketch", "component", "tile",
                    F.least("tile", "with").alias("t1"), F.greatest("tile", "with").alias("t2")))

    def weigh(table: pa.Table) -> pa.Table:
        key, doc, n, comp, tile = (table[c].to_numpy() for c in ("key", "doc", "n", "component", "tile"))
        sk = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH)
        t1, t2 = table["t1"][0].as_py(), table["t2"][0].as_py()
        right = np.flatnonzero(tile == t2)
        out = [[], []]
        for i in np.flatnonzero(tile == t1):
            other = right[(comp[right] != comp[i]) & ((key[right] > key[i]) if t1 == t2 else True)]
            other = other[within_bound(n[i], sk[i], n[other], sk[other])]
            out[0].append(np.full(len(other), i))
            out[1].append(other)
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in out)
        a, b = np.where(key[a] < key[b], a, b), np.where(key[a] < key[b], b, a)
        return pa.table({"a": pa.array(key[a], pa.int64()), "b": pa.array(key[b], pa.int64()),
                         "doc_a": pa.array(doc[a], pa.int64()), "doc_b": pa.array(doc[b], pa.int64())})

    return rows.groupBy("sig", "t1", "t2").applyInArrow(weigh, _PAIR).distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Components of documents under similarity of five-word shingles: doc_id, n_shingles, component_id, copies.

    Words are runs of other than ASCII white space, in lower case (A-Z). A text
    of fewer than five words is one shingle; a null text, or one without words,
    has the empty set, is linked with nothing and is its own component.
    Documents with equal sets are one class; ``copies`` is the class's size.
    ``component_id`` is the least doc_id of the component (null if none of its
    rows has one); rows with a null doc_id link others like all rows. Repeated rows are copies;
    different texts under one id each keep their own links and share a
    component. An empty table gives no rows; columns other than doc_id and text
    are ignored.
    """
    if docs.filter(F.col("doc_id").isNull()).limit(1).count():
        return _with_null_ids(docs)
    sets = cut(document_sets(docs), "sets")
    classes = cut(sets.filter("key IS NOT NULL").groupBy("key")
                  .agg(F.min("doc_id").cast("long").alias("doc"), F.max("n_shingles").alias("n"), F.min("sketch").alias("sketch"),
                       F.count(F.lit(1)).alias("copies")), "classes")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    shared = cut(shared_signatures(docs, total), "shared")
    named = classes.filter("doc IS NOT NULL")
    links = cut(verify(cut(_filter_pairs(star_pairs(shared), named).distinct(), "stars"), docs), "links")
    labels = components(links)
    more = cut(_unsettled(shared, named, labels), "unsettled")
    if more.limit(1).count():
        labels = components(links.union(verify(more, docs)))
    found = classes.join(labels, classes["doc"] == labels["doc"], "left").select(
        F.col("key").alias("of"), F.coalesce("component", classes["doc"]).alias("component"), "copies")
    return (sets.join(found, F.col("key") == F.col("of"), "left")
            .select("doc_id", "n_shingles", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                    F.coalesce("copies", F.lit(1)).alias("copies")))


def _with_null_ids(docs: DataFrame) -> DataFrame:
    """``jaccard_components`` where rows have no doc_id: all rows are compared under numbers of their own.

    Rows of one id share one number, the least of theirs, and so a component.
    """
    rows = cut(docs.select("doc_id", "text").withColumn("number", F.monotonically_increasing_id()), "numbered")
    least = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("number").alias("of"))
    known = cut(rows.join(least, "doc_id", "left").select("doc_id", F.coalesce("of", "number").alias("number"), "text"), "known")
    found = cut(jaccard_components(known.select(F.col("number").alias("doc_id"), "text")), "found")
    ids = known.select("number", "doc_id").filter("doc_id IS NOT NULL").distinct()
    mine = found.join(ids.withColumnRenamed("doc_id", "real"), found["doc_id"] == ids["number"], "left")
    names = mine.groupBy(F.col("component_id").alias("component")).agg(F.min("real").alias("least"))
    return (mine.join(names, F.col("component_id") == F.col("component"))
            .select(F.col("real").alias("doc_id"), "n_shingles", F.col("least").cast("long").alias("component_id"), "copies"))


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
