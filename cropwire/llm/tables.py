"""Sums of arrays of fixed size that tasks fill, on their way to the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Numbers of one piece.
PIECE = 1 << 15
_KIND = "piece long, salt long, n binary"


def packed(x: np.ndarray) -> bytes:
    """Numbers byte by byte, lowest first, so that the high bytes compress; behind their number."""
    planes = np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def _add(t: pa.Table) -> pa.Table:
    total = sum(unpacked(x, np.int64) for x in t["n"].to_pylist())
    return pa.table({"piece": t["piece"][:1], "salt": t["salt"][:1], "n": pa.array([packed(total)], pa.binary())})


def sum_tables(rows: DataFrame, fill: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], size: int,
               dtype: type = np.int64) -> np.ndarray:
    """The sum of the arrays of ``size`` whole numbers that ``fill`` makes of each task's batches, as ``dtype``.

    Pieces are added up in two steps, so that no group holds a piece of every
    task, and only the sum, of fixed size, comes to the driver.
    """
    def last(t: pa.Table) -> pa.Table:
        total = unpacked(_add(t)["n"][0].as_py(), np.int64).astype(dtype)
        return pa.table({"piece": t["piece"][:1], "n": pa.array([total.tobytes()], pa.binary())})

    def pieces(batches):
        table = fill(batches)
        if table is not None:
            salt = TaskContext.get().partitionId() % 64
            for p in range(0, size, PIECE):
                yield pa.RecordBatch.from_arrays([pa.array([p // PIECE], pa.int64()), pa.array([salt], pa.int64()),
                                                  pa.array([packed(table[p:p + PIECE].astype(np.int64))], pa.binary())], ["piece", "salt", "n"])

    parts = rows.mapInArrow(pieces, _KIND).groupBy("piece", "salt").applyInArrow(_add, _KIND)
    out = np.zeros(size, dtype)
    for r in parts.groupBy("piece").applyInArrow(last, "piece long, n binary").collect():
        at = r["piece"] * PIECE
        out[at:at + PIECE] = np.frombuffer(r["n"], dtype)
    return out
