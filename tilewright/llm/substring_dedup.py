"""Removal of repeated passages by fixed-block anchors.

Every document is a reference cut into blocks of ``BLOCK`` words that do not overlap; any window of
``WINDOW = 2 * BLOCK`` words covers a whole block of the document it stands in. All rolling windows
of ``BLOCK`` words of all documents probe the index of blocks. Around the blocks that a second,
larger document has too, the hits are extended: each window of ``WINDOW`` words that holds the hit
is compared with those of the other documents, and the union of the equal ones is the maximal
repeat. A word is removed if such a window covers it whose words also start in a smaller document.

Words are compared by 64-bit hashes (wrong with probability n * n / 2 ** 65 for n windows).

Defined cases: null and blank texts have no words; documents with a null ``doc_id`` are neither
referred to nor changed; rows that share a ``doc_id`` are not smaller than each other, so both keep
what only they share; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import bitfilter, textkit
from tilewright.llm.shared import stored

BLOCK = 25
WINDOW = 2 * BLOCK
#: Sizes of the bit tables that keep probes and texts without a partner out of the shuffle.
BLOCK_LOG_BITS = 29
SHARED_LOG_BITS = 27
DOC_LOG_BITS = 25


def _windows(w: textkit.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes; hashes, first words and rows of the rolling blocks."""
    hashes = w.hashes(lower=False)
    blocks, at = textkit.window_hashes(hashes, w.first, BLOCK)
    rows = np.searchsorted(w.first, at, "right") - 1
    return hashes, blocks, at, rows


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for w in textkit.words(batch.column(1)):
            _, blocks, at, rows = _windows(w)
            own = blocks[(at - w.first[rows]) % BLOCK == 0]
            yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], names=["block"])


def _probes(table: Broadcast) -> Callable:
    """Per slice and block that hits the index: the smallest referred and the largest probing document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for w in textkit.words(batch.column(1)):
                _, blocks, at, rows = _windows(w)
                hit = bitfilter.contains(table, blocks, BLOCK_LOG_BITS)
                blocks, at, rows = blocks[hit], at[hit], rows[hit]
                docs = ids[w.rows][rows]
                own = (at - w.first[rows]) % BLOCK == 0
                order = np.argsort(blocks, kind="stable")
                blocks, docs, own = blocks[order], docs[order], own[order]
                starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else np.zeros(0, dtype=np.int64)
                if not len(starts):
                    continue
                none = np.iinfo(np.int64).max
                low = np.minimum.reduceat(np.where(own, docs, none), starts)
                high = np.maximum.reduceat(docs, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[starts].view(np.int64)), pa.array(low), pa.array(high)], names=["block", "low", "high"]
                )

    return run


def _extensions(table: Broadcast) -> Callable:
    """All windows of WINDOW words that hold a shared block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for w in textkit.words(batch.column(1)):
                hashes, blocks, at, _ = _windows(w)
                at = at[bitfilter.contains(table, blocks, SHARED_LOG_BITS)]
                step = np.zeros(len(hashes) + 1, dtype=np.int64)
                np.add.at(step, np.maximum(at - BLOCK + 1, 0), 1)
                np.add.at(step, at + 1, -1)
                near = np.cumsum(step[:-1]) > 0
                windows, starts = textkit.window_hashes(hashes, w.first, WINDOW)
                chosen = near[starts]
                windows, starts = windows[chosen], starts[chosen]
                rows = np.searchsorted(w.first, starts, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(windows.view(np.int64)),
                        pa.array(ids[w.rows][rows]),
                        pa.array((starts - w.first[rows]).astype(np.int32)),
                    ],
                    names=["window", "doc_id", "start"],
                )

    return run


def _split(table: Broadcast, inside: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = bitfilter.contains(table, np.asarray(batch.column(2)).view(np.uint64), DOC_LOG_BITS)
            yield batch.select([0, 1]).filter(pa.array(hit == inside))

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = batch.column(2)
        for w in textkit.words(batch.column(1)):
            hashes = w.hashes(lower=False)
            cover = np.zeros(len(hashes) + 1, dtype=np.int64)
            for row in range(len(w.counts)):
                hits = found[w.rows.start + row]
                if not hits.is_valid:
                    continue
                starts = w.first[row] + np.asarray(hits.values.field("start"), dtype=np.int64)
                windows = np.asarray(hits.values.field("window")).view(np.uint64)
                inside = starts + WINDOW <= w.first[row + 1]
                starts, windows = starts[inside], windows[inside]
                # rows that share an id: a hit belongs to the text that has its words
                starts = starts[textkit.span_hashes(hashes, starts, starts + WINDOW, textkit._WINDOW_BASE) == windows]
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + WINDOW, -1)
            keep = np.cumsum(cover[:-1]) == 0
            n, texts, removed = len(w.counts), [], []
            data = w.data.tobytes()
            for row in range(n):
                a, b = w.first[row], w.first[row + 1]
                own = np.flatnonzero(keep[a:b]) + a
                texts.append(b" ".join([data[s:e] for s, e in zip(w.starts[own].tolist(), w.ends[own].tolist())]))
                removed.append(b - a - len(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(w.rows.start, n),
                    pa.array(w.counts.astype(np.int64)),
                    pa.array(np.array(removed, dtype=np.int64)),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "text"],
            )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text (kept words, one space between); a row per row of ``documents``."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id is not null and text is not null")
    index = bitfilter.build(known.mapInArrow(_blocks, "block long"), BLOCK_LOG_BITS)
    shared = (
        known.mapInArrow(_probes(index), "block long, low long, high long")
        .groupBy("block")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .where("low < high")
    )
    near = bitfilter.build(shared.select("block"), SHARED_LOG_BITS)
    windows = known.mapInArrow(_extensions(near), "window long, doc_id long, start int")
    # pre-aggregated, and joined back on a key that adaptive execution can split
    first = windows.groupBy("window").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    repeated = windows.join(first.select("window", "low"), "window").where("doc_id > low")
    per_doc = repeated.groupBy("doc_id").agg(F.collect_list(F.struct("start", "window")).alias("hits"))
    per_doc = stored(per_doc, "repeats")
    # documents without a hit don't meet the others in the shuffle; the bit table only splits the two kinds
    hashed = bitfilter.build(per_doc.select(F.xxhash64("doc_id")), DOC_LOG_BITS)
    keyed = docs.withColumn("h", F.xxhash64("doc_id"))
    schema = "doc_id long, text string"
    untouched = keyed.mapInArrow(_split(hashed, False), schema).withColumn("hits", F.lit(None).cast(per_doc.schema["hits"].dataType))
    touched = keyed.mapInArrow(_split(hashed, True), schema).join(per_doc, "doc_id", "left")
    kept = "doc_id long, n_words long, n_removed long, text string"
    return untouched.mapInArrow(_kept, kept).unionByName(touched.select("doc_id", "text", "hits").mapInArrow(_kept, kept))
