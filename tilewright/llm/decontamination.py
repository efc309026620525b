"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with white space runs as one space. An item of ``m`` characters
may be changed by ``k = m // 20`` edits (``ERROR_SHARE`` of its length). It is cut into ``k + 1``
pieces, of which at least one survives ``k`` edits, so every match holds an exact piece; documents
are searched for all pieces at once, and around each hit Myers' bit-parallel algorithm finds the
smallest edit distance of the whole item to any part of the text there.

Items are the stated query set. They go to the tasks in blocks of at most ``BLOCK_CHARS``
characters (single longer items are blocks of their own), one pass over the documents for each
block, so what is broadcast has a fixed bound.

Defined cases: null and blank items match nothing; null and empty texts match nothing; items of the
same text are all reported; an item shorter than 20 characters has to occur as it is; repeated
documents are reported as often as they occur, and null ids as null; other columns are not read by
the search and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_SHARE = 1 / 20
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str) -> int:
    return int(len(item) * ERROR_SHARE + 1e-9)


def pieces(item: str) -> list[tuple[int, str]]:
    """(place, piece): ``budget + 1`` pieces of nearly equal length."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def edit_search(item: str, text: str) -> tuple[int, int]:
    """(distance, end): the smallest edit distance of ``item`` to a part of ``text``, and its first end."""
    m, rows = len(item), {}
    for i, c in enumerate(item):
        rows[c] = rows.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, (m, 0)
    for j, c in enumerate(text):
        same = rows.get(c, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | (full & ~(diagonal | up))
        right_down = up & diagonal
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up <<= 1
        right_down <<= 1
        up = full & (right_down | ~(diagonal | right_up))
        down = right_up & diagonal & full
        if score < best[0]:
            best = (score, j + 1)
    return best


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, item) in enumerate(items):
            for at, piece in pieces(item):
                places.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> dict[int, tuple[int, int]]:
        """Number of an item -> (distance, end) in the normal form of ``text``."""
        found: dict[int, tuple[int, int]] = {}
        text = normal(text)
        if not self.items or not text:
            return found
        starts: dict[int, list[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, at in where:
                starts.setdefault(number, []).append(end + 1 - length - at)
        for number, places in starts.items():
            item = self.items[number][1]
            k, m = budget(item), len(item)
            whole = text.find(item)
            if whole >= 0:
                found[number] = (0, whole + m)
                continue
            low = high = None
            spans = []
            for start in sorted(set(places)):
                if high is not None and start <= high + 2 * k:
                    high = start
                else:
                    if low is not None:
                        spans.append((low, high))
                    low = high = start
            spans.append((low, high))
            for low, high in spans:
                begin = max(0, low - k)
                distance, end = edit_search(item, text[begin : high + m + k])
                if distance <= k and (number not in found or distance < found[number][0]):
                    found[number] = (distance, begin + end)
        return found


def _pairs(block: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value)
        for batch in batches:
            rows, out = [], []
            for row, text in enumerate(batch.column(1)):
                for number, (distance, end) in sorted(matcher.matches(text.as_py()).items()):
                    rows.append(row)
                    out.append((matcher.items[number][0], distance, end))
            items, distances, ends = (list(c) for c in zip(*out)) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(items, pa.int64()),
                    pa.array(distances, pa.int32()),
                    pa.array(ends, pa.int32()),
                ],
                names=["doc_id", "item_id", "distance", "end"],
            )

    return run


def _clean(block: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array(np.array([not matcher.matches(text.as_py()) for text in texts], dtype=bool)))

    return run


def item_blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """(item_id, normal text) of all items, in broadcasts of bounded size."""
    context = benchmark.sparkSession.sparkContext
    block: list[tuple[int, str]] = []
    size = 0
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    for row in rows.toLocalIterator():
        item = normal(row.text)
        if not item:
            continue
        if block and size + len(item) > BLOCK_CHARS:
            yield context.broadcast(block)
            block, size = [], 0
        block.append((row.item_id, item))
        size += len(item)
    yield context.broadcast(block)


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, distance, end (of the match, in the normal form): all pairs within the budget."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for block in item_blocks(benchmark):
        part = docs.mapInArrow(_pairs(block), "doc_id long, item_id long, distance int, end int")
        found = part if found is None else found.unionByName(part)
    return found


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no item; all columns, no shuffle."""
    for block in item_blocks(benchmark):
        documents = documents.mapInArrow(_clean(block), documents.schema)
    return documents
