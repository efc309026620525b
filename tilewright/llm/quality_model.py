"""Quality classifier: random-indexing word vectors, pooled, and a small calibrated network.

A text is cut into runs of letters, of digits, of white space with a line feed, and of other
characters; a run's features are the run itself, in lower case, and its shape (kind, capitals,
length class). Features are hashed to ``FEATURES`` rows. Random indexing: every feature owns a
sparse random index vector (``DRAWS`` signed ones, from its hash); the context vector of a feature is
the sum of the index vectors of the features next to it, over all documents. Vectors are divided by
the logarithm of their length and pooled per document into mean, spread and a few shares. A network
of one hidden layer is fitted on a bounded sample of labelled documents (``SAMPLE``), and its
temperature on a part of the sample that the fit doesn't see.

Label, language, source and id are not inputs of a score. Labels of held-out documents are not read.

Defined cases: null and empty texts get the score of a text without runs; unlabelled and repeated
documents are scored row by row; labels with null ``doc_id`` or ``quality`` are ignored, and of
several labels of a document the lowest counts; without labels of both kinds every score is 1; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import textkit
from tilewright.llm.shared import held_out, stored

FEATURES = 1 << 14
WIDTH = 32
DRAWS = 2
#: Labelled documents of each quality that the fit reads at most, taken by the hash of their id.
SAMPLE = 10_000
HIDDEN = 24
#: Bytes of text worked on at once; a run has vectors of ``WIDTH`` numbers, and a worker keeps what it once took.
SLICE_BYTES = 1 << 18
EPOCHS = 60
THRESHOLD = 0.3
HELD_OUT = (5, 0)

_KIND = np.full(256, 3, dtype=np.uint8)  # 0 space, 1 letter (also all bytes beyond ASCII), 2 digit, 3 other, 4 line feed
_KIND[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 0
_KIND[0x0A] = 4
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1
_KIND[48:58] = 2
_UPPER = np.zeros(256, dtype=np.int64)
_UPPER[65:91] = 1
_VALUES = textkit._BYTE_VALUES[textkit._LOWER]


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature of the run, feature of its shape, first run of each row)."""
    kind = _KIND[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = edge[:-1].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    hashes = textkit.span_hashes(_VALUES[data], starts, ends)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    length = ends - starts
    capitals = upper[ends] - upper[starts]
    case = np.where(capitals == 0, 0, np.where(capitals == length, 3, np.where(capitals == 1, 1, 2)))
    shape = kind[starts].astype(np.int64) * 64 + case * 16 + np.minimum(np.log2(length + 0.5).astype(np.int64), 7)
    word = 512 + (hashes % np.uint64(FEATURES - 512)).astype(np.int64)
    return word, shape, np.searchsorted(starts, offsets)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(FEATURES, DRAWS) columns and signs."""
    rnd = np.random.default_rng(1905)
    return rnd.integers(0, WIDTH, (FEATURES, DRAWS)), rnd.choice([-1, 1], (FEATURES, DRAWS)).astype(np.int64)


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of sums for each block of 1024 features of the task."""
    columns, signs = _index_vectors()
    table = np.zeros(FEATURES * WIDTH, dtype=np.int64)
    for batch in batches:
        data, offsets = textkit.ragged(batch.column(0))
        for rows in textkit.row_slices(offsets, SLICE_BYTES):
            local = offsets[rows.start : rows.stop + 1]
            word, shape, first = runs(data[local[0] : local[-1]], local - local[0])
            same = np.ones(max(0, len(word) - 1), dtype=bool)
            inner = first[(first > 0) & (first < len(word))] - 1
            same[inner] = False
            left, right = np.flatnonzero(same), np.flatnonzero(same) + 1
            for of, by in ((word, word), (shape, shape), (word, shape), (shape, word)):
                for a, b in ((left, right), (right, left)):
                    for draw in range(DRAWS):
                        seen = by[b]
                        np.add.at(table, of[a] * WIDTH + columns[seen, draw], signs[seen, draw])
    size = 1024 * WIDTH
    for block in range(FEATURES // 1024):
        part = table[block * size : (block + 1) * size]
        if part.any():
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(sums.as_buffer(), dtype=np.int64)
            totals[block] = totals[block] + part if block in totals else part
    for block, part in totals.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})


def word_vectors(documents: DataFrame) -> np.ndarray:
    """(FEATURES, WIDTH) context vectors over all documents; a table of fixed size."""
    schema = "block int, sums binary"
    partial = documents.where("text is not null").select("text").mapInArrow(_context_sums, schema)
    summed = partial.repartition(FEATURES // 1024, "block").mapInArrow(_added, schema).collect()
    table = np.zeros((FEATURES // 1024, 1024 * WIDTH))
    for row in summed:
        table[row.block] = np.frombuffer(bytes(row.sums), dtype=np.int64)
    vectors = table.reshape(FEATURES, WIDTH)
    length = np.sqrt((vectors**2).sum(1, keepdims=True))
    return (vectors / np.maximum(length, 1) * np.log1p(np.maximum(length, 1)) / 10).astype(np.float32)


#: Mean and spread of run and shape vectors, shares of ten classes of shapes, and two lengths.
POOLED = 4 * WIDTH + 12


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(rows, POOLED) features of the texts."""
    out = np.zeros((len(offsets) - 1, POOLED), dtype=np.float32)
    last = np.zeros(0, dtype=np.int64)
    for rows in textkit.row_slices(offsets, SLICE_BYTES):
        local = offsets[rows.start : rows.stop + 1]
        last = _pool(data[local[0] : local[-1]], local - local[0], vectors, last, out[rows])
    return out


def _pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray, last: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Fills ``out``; takes the four runs before the texts and gives the last four."""
    word, shape, first = runs(data, offsets)
    n = np.diff(first)
    full = np.flatnonzero(n)
    if not len(full):
        return last
    starts, count = first[:-1][full], n[full][:, None]
    for k, of in enumerate((word, shape)):
        values = vectors[of]
        mean = np.add.reduceat(values, starts) / count
        out[full, 2 * k * WIDTH : (2 * k + 1) * WIDTH] = mean
        spread = np.add.reduceat(values**2, starts) / count - mean**2
        out[full, (2 * k + 1) * WIDTH : (2 * k + 2) * WIDTH] = np.sqrt(np.maximum(spread, 0))
    at = 4 * WIDTH
    kind, case = shape // 64, shape // 16 % 4
    for j, chosen in enumerate([kind == 1, kind == 2, kind == 3, kind == 4, case == 0, case == 1, case == 2, (case == 3) & (shape % 16 > 0), shape % 16 < 2, shape % 16 > 2]):
        out[full, at + j] = np.add.reduceat(chosen.astype(np.float32), starts) / count[:, 0]
    out[full, at + 10] = np.log1p(n[full]) / 10
    # how many runs are the same as one of the four runs before
    known = np.concatenate([last, word])
    again = np.zeros(len(known), dtype=np.float32)
    for back in range(1, 5):
        again[back:] = np.maximum(again[back:], known[back:] == known[:-back])
    out[full, at + 11] = np.add.reduceat(again[len(last) :], starts) / count[:, 0]
    return known[-4:]


class Network:
    """POOLED -> HIDDEN (tanh) -> one logit, over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 12):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        fold = rnd.random(len(x)) < 0.2
        both = len(np.unique(y[fold])) == 2 and len(np.unique(y[~fold])) == 2
        fit, hold = (~fold, fold) if both else (np.ones(len(x), dtype=bool), np.ones(len(x), dtype=bool))
        self.w1, self.b1 = rnd.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN)
        self.w2, self.b2 = rnd.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0
        self.temperature = 1.0
        self._fit((x[fit] - self.mean) / self.scale, y[fit], rnd)
        logits = self.logits(x[hold])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [np.mean(np.logaddexp(0, -(2 * y[hold] - 1) * logits / t)) for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def _fit(self, x: np.ndarray, y: np.ndarray, rnd: np.random.Generator) -> None:
        params = [self.w1, self.b1, self.w2, np.array([self.b2])]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rnd.permutation(len(x))
            for at in range(0, len(x), 128):
                xb, yb = x[order[at : at + 128]], y[order[at : at + 128]]
                h = np.tanh(xb @ params[0] + params[1])
                p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3][0], -30, 30)))
                d = (p - yb) / len(xb)
                dh = np.outer(d, params[2]) * (1 - h**2)
                grads = [xb.T @ dh + 1e-4 * params[0], dh.sum(0), h.T @ d + 1e-4 * params[2], np.array([d.sum()])]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    params[i] = params[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = params[0], params[1], params[2], float(params[3][0])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _pooled(vectors: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.ragged(batch.column(1))
            for rows in textkit.row_slices(offsets):
                local = offsets[rows.start : rows.stop + 1]
                x = pooled(data[local[0] : local[-1]], local - local[0], vectors.value)
                packed = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(rows.start, len(x)), packed], names=["quality", "x"])

    return run


def _scored(vectors: Broadcast, network: Broadcast, text_column: int, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = textkit.ragged(batch.column(text_column))
            for rows in textkit.row_slices(offsets):
                local = offsets[rows.start : rows.stop + 1]
                n = len(local) - 1
                if network.value is None:
                    scores = np.ones(n)
                else:
                    scores = network.value.scores(pooled(data[local[0] : local[-1]], local - local[0], vectors.value))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(rows.start, n).columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, name]
                )

    return run


def train(documents: DataFrame, labels: DataFrame) -> tuple[Broadcast, Broadcast]:
    """(word vectors, network or None); labels of held-out documents are left out before anything else."""
    context = documents.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(documents))
    label = (
        labels.where("doc_id is not null and quality is not null")
        .where(~held_out(F.col("doc_id"), *HELD_OUT))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    # the sample is the rows with the smallest hashes, whatever their order in the files
    chosen = None
    for quality in (0, 1):
        part = label.where(F.col("quality") == quality).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = stored(chosen, "quality-sample")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select("quality", "text").mapInArrow(_pooled(vectors), "quality int, x binary").collect()
    y = np.array([r.quality for r in rows], dtype=np.float64)
    if len(np.unique(y)) < 2:
        return vectors, context.broadcast(None)
    x = np.frombuffer(b"".join(bytes(r.x) for r in rows), dtype=np.float32).reshape(len(rows), POOLED).astype(np.float64)
    order = np.lexsort(np.vstack([x[:, :8].T, y]))  # the fit doesn't depend on the order of tasks
    return vectors, context.broadcast(Network(x[order], y[order]))


def score(documents: DataFrame, labels: DataFrame, name: str = "score") -> DataFrame:
    """``documents`` and the column ``name``, which they must not have: the probability that ``quality`` is 1."""
    vectors, network = train(documents, labels)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    return documents.mapInArrow(_scored(vectors, network, documents.columns.index("text"), name), f"{types}, `{name}` double")
