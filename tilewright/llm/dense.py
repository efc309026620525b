"""Count tables of fixed size: filled by tasks, added up by Spark, read by the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Cells of one row.
CHUNK = 1 << 18
SCHEMA = "chunk int, wide int, packed binary"


class Packed:
    """An array that is broadcast compressed and unpacked once per worker."""

    def __init__(self, values: np.ndarray):
        self.kind, self.shape, self.size = values.dtype.str, values.shape, values.nbytes
        self.packed = pa.Codec("zstd").compress(np.ascontiguousarray(values).tobytes(), asbytes=True)
        self.held: np.ndarray | None = None

    def __getstate__(self) -> dict:
        # a worker that has unpacked the array keeps that one only
        packed = self.packed if self.held is None else pa.Codec("zstd").compress(self.held.tobytes(), asbytes=True)
        return {**self.__dict__, "packed": packed, "held": None}

    @property
    def values(self) -> np.ndarray:
        if self.held is None:
            raw = pa.Codec("zstd").decompress(self.packed, self.size) if self.size else b""
            self.held = np.frombuffer(raw, dtype=self.kind).reshape(self.shape)
            self.packed = b""
        return self.held


def rows(values: np.ndarray, first: int = 0) -> Iterator[pa.RecordBatch]:
    """The table as compressed rows; rows of zeros are left out."""
    codec = pa.Codec("zstd")
    for at in range(0, len(values), CHUNK):
        part = values[at : at + CHUNK]
        if part.any():
            small = part.astype(np.int32) if part.max() < 1 << 31 else part.astype(np.int64)
            packed = codec.compress(small.tobytes(), asbytes=True)
            columns = [pa.array([first + at // CHUNK], pa.int32()), pa.array([small.itemsize], pa.int32()), pa.array([packed], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "wide", "packed"])


def _unpacked(size: int, wide: int, packed) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(packed, size * wide)
    return np.frombuffer(raw, dtype=np.int32 if wide == 4 else np.int64).astype(np.int64)


def _add(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, wide, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                part = _unpacked(min(CHUNK, size - chunk * CHUNK), wide, packed.as_buffer())
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        for chunk, part in sums.items():
            yield from rows(part, chunk)

    return run


def total(parts: DataFrame, size: int, at_once: bool = False) -> np.ndarray:
    """Sum of the tables of all tasks (rows of ``SCHEMA``); ``size`` cells reach the driver, at once by one job or task by task."""
    added = parts.repartition(-(-size // CHUNK), "chunk").mapInArrow(_add(size), SCHEMA)
    values = np.zeros(size, dtype=np.int64)
    for r in added.collect() if at_once else added.toLocalIterator():
        at = r.chunk * CHUNK
        values[at : at + CHUNK] = _unpacked(min(CHUNK, size - at), r.wide, bytes(r.packed))
    return values
