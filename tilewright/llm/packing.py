"""Best-fit packing of token sequences, certified by dual-feasible bounds.

Pieces of at most ``CAPACITY`` tokens are dealt to groups of about ``GROUP`` pieces; each group packs
its own by best-fit decreasing. Dual-feasible functions give a lower bound on the group's number of
bins: where it is met, the group is certified. Bins that are not full are opened again unless all
is certified together; their pieces are dealt anew, mixed with those of the other groups, and packed
again. Rounds end when the number of bins equals the bound over all pieces, when a round saves
nothing, or when one group has held the whole pool.

Defined cases: a document of null or empty text is one piece with the end id alone; pieces of the
same length are taken in the order of their row numbers; rows that repeat a ``doc_id`` are packed one
by one; an empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import tokens
from tilewright.llm.shared import stored

CAPACITY = 4096
GROUP = 100_000
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: A bin with fewer free tokens than this is left closed.
CLOSED = 16
MAX_ROUNDS = 8


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Most of the bounds that dual-feasible functions give for ``counts`` pieces of ``lengths``.

    For every threshold t up to half of the capacity: pieces over ``capacity - t`` count as full,
    those under t as nothing. For k up to 20: ``x`` counts as ``floor((k + 1) x / capacity) / k``,
    and as it is where that division has no rest. The thresholds include 0, the plain sum.
    """
    if not len(lengths):
        return 0
    order = np.argsort(lengths)
    x, n = np.asarray(lengths)[order].astype(np.int64), np.asarray(counts)[order].astype(np.int64)
    number = np.concatenate([[0], np.cumsum(n)])
    total = np.concatenate([[0], np.cumsum(n * x)])
    t = np.concatenate([[0], x[x <= capacity // 2]])
    small = np.searchsorted(x, t, "left")
    big = np.searchsorted(x, capacity - t, "right")
    value = (number[-1] - number[big]) * capacity + total[big] - total[small]
    best = int(np.max(-(-value // capacity)))
    for k in range(1, 21):
        whole = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity)
        f = np.where(whole, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, int(-(-np.sum(f * n) // (k * capacity))))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece. Open bins are found through a bit set of free lengths."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_lengths, n = 0, 0
    for piece, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = free_lengths >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            own = by_free[free].pop()
            if not by_free[free]:
                free_lengths &= ~(1 << free)
        else:
            own, free = n, capacity
            n += 1
        bins[piece], offsets[piece] = own, capacity - free
        rest = free - length
        if rest:
            by_free[rest].append(own)
            free_lengths |= 1 << rest
    return bins, offsets


def _pieces(vocabulary: str, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokens.encoder(vocabulary), np.array([END_ID], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 36
        step = 4 * capacity
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.ids(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out.append((row, doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    row += 1
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["row", "doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def token_pieces(documents: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """row (unique), doc_id, piece, start, length, ids_crc32: whole documents, longer ones cut."""
    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_pieces(vocabulary, capacity), schema)


def _pack(round_number: int, capacity: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[np.asarray(batch.column(c)) for c in range(3)] for batch in batches]
        if not parts:
            return
        group, rows, lengths = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((rows, group))
        group, rows, lengths = group[order], rows[order], lengths[order]
        cuts = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = lengths[a:b]
            bins, offsets = best_fit_decreasing(own, capacity)
            n = int(bins.max()) + 1
            free = capacity - np.bincount(bins, own, n).astype(np.int64)
            sizes, counts = np.unique(own, return_counts=True)
            gap = n - lower_bound(sizes, counts, capacity)
            number = (np.int64(round_number) << np.int64(56)) + (group[a].astype(np.int64) << np.int64(28)) + bins
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[a:b]),
                    pa.array(own),
                    pa.array(number),
                    pa.array(offsets),
                    pa.array(free[bins]),
                    pa.array(np.full(b - a, gap, dtype=np.int32)),
                ],
                names=["row", "length", "sequence_id", "offset", "free", "gap"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP) -> DataFrame:
    """row, sequence_id, offset for the rows of ``pieces`` (row, length: 1 to ``capacity``)."""
    pool = pieces.select("row", "length")
    sizes = pool.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    bound = lower_bound(np.array([r.length for r in sizes]), np.array([r.n for r in sizes]), capacity)
    pooled, closed, packed = sum(r.n for r in sizes), [], None
    closed_bins, pool_bins = 0, None
    for number in range(MAX_ROUNDS):
        groups = max(1, -(-pooled // group_size))
        dealt = pool.select((F.pmod(F.xxhash64("row", F.lit(number)), F.lit(groups))).cast("int").alias("group"), "row", "length")
        schema = "row long, length long, sequence_id long, offset long, free long, gap int"
        result = stored(dealt.repartition(groups, "group").mapInArrow(_pack(number, capacity), schema), "packed")
        ends = result.where("offset = 0")
        counts = ends.agg(F.count(F.lit(1)).alias("bins"), F.count_if(F.col("free") >= CLOSED).alias("open"), F.max("gap").alias("gap")).first()
        if pool_bins is not None and counts.bins >= pool_bins:
            break  # the exchange saved nothing: the bins before stay
        packed = result
        pool_bins = counts.open
        closed_now = result.where(F.col("free") < CLOSED)
        if closed_bins + counts.bins <= bound or groups == 1 or not counts.open:
            break
        closed.append(closed_now)
        closed_bins += counts.bins - counts.open
        packed = pool_result = result.where(F.col("free") >= CLOSED)
        pool = pool_result.select("row", "length")
        pooled = pool.count()
    for part in closed:
        packed = packed.unionByName(part)
    return packed.select("row", "sequence_id", "offset")


def packed_pieces(documents: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    pieces = stored(token_pieces(documents, vocabulary, capacity), "pieces")
    return pieces.join(pack(pieces, capacity), "row").drop("row")
