"""Array work on whole batches of texts: bytes, words and their hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (one longer text is taken alone).
SLICE_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def slices(batches, column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for parts of the batches with about ``SLICE_BYTES`` of text in ``column``; null is empty."""
    for batch in batches:
        text = batch.column(column).fill_null("").cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        data = text.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(at, to - at), raw[ends[at]:ends[to]], ends[at:to + 1] - ends[at]
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers so that all bits depend on all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES) + 1
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p)
    return _powers["up"], _powers["down"]


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    space = SPACE.take(raw)
    first = ~space
    last = first.copy()
    first[1:] &= space[:-1]
    last[:-1] &= space[1:]
    # A text's border cuts a word that runs over it.
    edge = offsets[(offsets > 0) & (offsets < n)]
    first[edge[~space[edge]]] = True
    last[edge[~space[edge - 1]] - 1] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of every span, the same wherever it stands."""
    up, down = _power(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    term = total[1:]
    term[:] = raw
    term += np.uint64(1)
    term *= up[:len(raw)]
    np.cumsum(term, out=term)
    return mix((total[ends] - total[starts]) * down[starts])
