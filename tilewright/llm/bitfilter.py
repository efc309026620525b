"""A set of hashes as a bit table of fixed size, built by tasks and broadcast.

It only saves work: what passes is joined exactly afterwards, so a full table costs time, not
results. Its size is the parameter ``log_bits`` (bytes: 2 ** (log_bits - 3)), whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tilewright.llm.dense import Packed
from tilewright.llm.shared import shuffles_dropped

#: Bits of one row of the build.
CHUNK_LOG = 22
_CHUNK_BYTES = 1 << (CHUNK_LOG - 3)


def _slots(hashes: np.ndarray, log_bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - log_bits)


def contains(built: Broadcast, hashes: np.ndarray, log_bits: int) -> np.ndarray:
    """Whether the table has the bit of each hash."""
    table = built.value.values
    slots = _slots(hashes, log_bits)
    return (table[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _rows(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for chunk, bits in sorted(parts.items()):
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), pa.array([codec.compress(bits.tobytes(), asbytes=True)], pa.binary())], names=["chunk", "bits"]
        )


def _set_bits(log_bits: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            slots = np.unique(_slots(np.asarray(batch.column(0)).view(np.uint64), log_bits))
            bounds = np.searchsorted(slots >> np.uint64(CHUNK_LOG), np.arange((1 << max(0, log_bits - CHUNK_LOG)) + 1).astype(np.uint64))
            for chunk in np.flatnonzero(np.diff(bounds)):
                bits = parts.setdefault(int(chunk), np.zeros(_CHUNK_BYTES, dtype=np.uint8))
                inside = slots[bounds[chunk] : bounds[chunk + 1]] & np.uint64((1 << CHUNK_LOG) - 1)
                np.bitwise_or.at(bits, inside >> np.uint64(3), np.uint8(1) << (inside & np.uint64(7)).astype(np.uint8))
        yield from _rows(parts)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec, parts = pa.Codec("zstd"), {}
    for batch in batches:
        for chunk, bits in zip(batch.column(0).to_pylist(), batch.column(1)):
            one = np.frombuffer(codec.decompress(bits.as_buffer(), _CHUNK_BYTES), dtype=np.uint8)
            parts[chunk] = one | parts[chunk] if chunk in parts else one
    yield from _rows(parts)


def _collected(hashes: DataFrame, merged: DataFrame, chunks: int, at_once: bool = False) -> Broadcast:
    table = np.zeros(max(1, chunks) * _CHUNK_BYTES, dtype=np.uint8)
    codec = pa.Codec("zstd")
    # at once: a job for all chunks in place of a job for each task
    if at_once:
        with shuffles_dropped(hashes.sparkSession):
            found = merged.collect()
    else:
        found = merged.toLocalIterator()
    for row in found:
        bits = np.frombuffer(codec.decompress(bytes(row.bits), _CHUNK_BYTES), dtype=np.uint8)
        table[row.chunk * _CHUNK_BYTES : (row.chunk + 1) * _CHUNK_BYTES] = bits
    return hashes.sparkSession.sparkContext.broadcast(Packed(table))


def build(hashes: DataFrame, log_bits: int, at_once: bool = False, of: Callable | None = None) -> Broadcast:
    """Bit table of the only column (64-bit hashes as long); the driver sees 2 ** (log_bits - 3) bytes.

    ``of`` as in ``build_twice``.
    """
    schema = "chunk int, bits binary"
    chunks = 1 << max(0, log_bits - CHUNK_LOG)
    set_bits = _set_bits(log_bits)
    step = set_bits if of is None else lambda batches: set_bits(of(batches))
    merged = hashes.mapInArrow(step, schema).repartition(min(chunks, 32), "chunk").mapInArrow(_merge, schema)
    return _collected(hashes, merged, chunks, at_once)


def _count_bits(log_bits: int) -> Callable:
    """Two tables of a task: slots met, and slots met twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = 1 << max(0, log_bits - CHUNK_LOG)
        once, twice = np.zeros((2, chunks * _CHUNK_BYTES), dtype=np.uint8)
        for batch in batches:
            slots, count = np.unique(_slots(np.asarray(batch.column(0)).view(np.uint64), log_bits), return_counts=True)
            at, bit = slots >> np.uint64(3), np.uint8(1) << (slots & np.uint64(7)).astype(np.uint8)
            again = (count > 1) | (once[at] & bit > 0)
            np.bitwise_or.at(twice, at[again], bit[again])
            np.bitwise_or.at(once, at, bit)
        yield from _count_rows({c: (o, t) for c, (o, t) in enumerate(zip(np.split(once, chunks), np.split(twice, chunks))) if o.any()})

    return run


def _count_rows(parts: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    codec = pa.Codec("zstd")
    for chunk, both in sorted(parts.items()):
        packed = [pa.array([codec.compress(bits.tobytes(), asbytes=True)], pa.binary()) for bits in both]
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *packed], names=["chunk", "once", "twice"])


def _merge_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec, parts = pa.Codec("zstd"), {}
    for batch in batches:
        for chunk, *both in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            once, twice = (np.frombuffer(codec.decompress(bits.as_buffer(), _CHUNK_BYTES), dtype=np.uint8) for bits in both)
            if chunk in parts:
                known, known_twice = parts[chunk]
                once, twice = once | known, twice | known_twice | (once & known)
            parts[chunk] = once, twice
    yield from _rows({chunk: twice for chunk, (_, twice) in parts.items()})


def build_twice(hashes: DataFrame, log_bits: int, of: Callable | None = None) -> Broadcast:
    """Bit table of what the only column (64-bit hashes as long) holds twice or more, and some others.

    ``of`` makes batches of that column from those of ``hashes`` in the same Python process: two steps of a task
    are two processes, which both keep their memory afterwards.
    """
    schema = "chunk int, once binary, twice binary"
    chunks = 1 << max(0, log_bits - CHUNK_LOG)
    count = _count_bits(log_bits)
    count = count if of is None else lambda batches, count=count: count(of(batches))
    counted = hashes.mapInArrow(count, schema).repartition(min(chunks, 32), "chunk")
    return _collected(hashes, counted.mapInArrow(_merge_counts, "chunk int, bits binary"), chunks, at_once=True)
