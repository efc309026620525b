"""Language-model scores by online logistic mixing of hashed-context bit predictors.

Every token has a code of ``CODE_BITS`` bits, the head of its hash. The bits are predicted one after
the other by counts in hashed contexts, together with the bits before: no context, the token before,
the one before that, and the code of the token before while it still agrees (a match model). The
log-odds of the predictors are mixed by weights that a gate selects (place of the bit, and how often
the context of the token before was seen), and refined by an adaptive table that maps the mixed
probability to the observed one. Between tokens of the same code decides their count with add-one
smoothing, where all unknown tokens of a code count as one. Probabilities thus sum to one over the
known tokens and one unknown token per code.

Learning reads the training documents twice. First all counts: words exactly (a distributed table),
contexts in tables of fixed size that tasks fill and Spark adds up. Then each task runs its documents
in small batches through the mixer, each batch predicted without its own occurrences before the
weights and the refinement learn from it; the weights of the tasks are averaged by tokens. Scoring
changes nothing. Counts of the most frequent words are broadcast (``FREQUENT`` at most); those of the
others are joined.

Defined cases: null and empty texts are one end token; rows that repeat a ``doc_id`` are scored one by
one; a null ``doc_id`` is not held out; without training documents N and V are 0 and every token is
unknown; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import dense, textkit
from tilewright.llm.shared import held_out, stored

HELD_OUT = (7, 2)
CODE_BITS = 12
LEAVES = 1 << CODE_BITS
#: Contexts of the token before and of the one before that.
BEFORE, EARLIER = 1 << 10, 1 << 8
FREQUENT = 1 << 18
#: Training batches of the mixer, in bytes of text.
BATCH_BYTES = 1 << 17
RATE = 0.25
GATES = 8
LEVELS = 33
_INPUTS = 5
_PRIOR = 0.4
_CLIP = 8.0
_END = np.uint64(0x5EED0E4D0C5EED01)
_START = np.uint64(0x5EED5747A27C0DE5)
_CELLS = LEAVES * (BEFORE + EARLIER)
_MATCH = 2 * (CODE_BITS + 1)


def token_stream(w: textkit.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all rows with an end after each row, first token and row of the tokens."""
    n = len(w.counts)
    first = w.first + np.arange(n + 1)
    stream = np.full(first[-1], _END, dtype=np.uint64)
    rows = np.repeat(np.arange(n), np.diff(first))
    at = np.ones(len(stream), dtype=bool)
    at[first[1:] - 1] = False
    stream[at] = w.hashes(lower=True)
    return stream, first, rows


def _shifted(stream: np.ndarray, first: np.ndarray, by: int) -> np.ndarray:
    out = np.full(len(stream), _START, dtype=np.uint64)
    out[by:] = stream[:-by]
    for k in range(by):
        at = first[:-1] + k
        out[at[at < first[1:]]] = _START
    return out


class Codes:
    """Codes and contexts of a token stream."""

    def __init__(self, stream: np.ndarray, first: np.ndarray):
        before, earlier = _shifted(stream, first, 1), _shifted(stream, first, 2)
        shift = np.uint64(64 - CODE_BITS)
        self.code = (stream >> shift).astype(np.int64)
        self.old = (before >> shift).astype(np.int64)
        self.before = ((before >> np.uint64(20)) & np.uint64(BEFORE - 1)).astype(np.int64)
        self.earlier = ((earlier >> np.uint64(30)) & np.uint64(EARLIER - 1)).astype(np.int64)
        self.run = (before == earlier).astype(np.int64)
        # how many leading bits agree with the code before
        differ = self.code ^ self.old
        self.agree = CODE_BITS - np.where(differ > 0, np.floor(np.log2(np.maximum(differ, 1))).astype(np.int64) + 1, 0)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush():
        words, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "c"])

    for batch in batches:
        for w in textkit.words(batch.column(0)):
            stream, _, _ = token_stream(w)
            held.append(stream)
            size += len(stream)
            if size > 1 << 20:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _context_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, match = np.zeros(_CELLS, dtype=np.int64), np.zeros(_MATCH, dtype=np.int64)
    for batch in batches:
        for w in textkit.words(batch.column(0)):
            stream, first, _ = token_stream(w)
            c = Codes(stream, first)
            np.add.at(cells, c.before * LEAVES + c.code, 1)
            np.add.at(cells, (BEFORE + c.earlier) * LEAVES + c.code, 1)
            match += np.bincount(c.run * (CODE_BITS + 1) + c.agree, minlength=_MATCH)
    yield from dense.rows(np.concatenate([cells, match]))


class Tables:
    """Counts of the left and right branch of every node of the code, in every context."""

    def __init__(self, cells: np.ndarray, match: np.ndarray):
        leaves = cells.reshape(BEFORE + EARLIER, LEAVES)
        left, right = self._branches(leaves)
        top = np.iinfo(np.int32).max
        self.packed = [dense.Packed(np.minimum(x, top).astype(np.int32)) for x in (left, right)]
        self.left0, self.right0 = left[:BEFORE].sum(0), right[:BEFORE].sum(0)
        histogram = match.reshape(2, CODE_BITS + 1)
        alive = histogram[:, ::-1].cumsum(1)[:, ::-1]  # agreeing in at least d bits
        self.hits, self.misses = alive[:, 1:], histogram[:, :-1]

    @property
    def left(self) -> np.ndarray:
        return self.packed[0].values

    @property
    def right(self) -> np.ndarray:
        return self.packed[1].values

    @staticmethod
    def _branches(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left, right = np.zeros_like(leaves), np.zeros_like(leaves)
        below = leaves
        for depth in reversed(range(CODE_BITS)):
            left[:, 1 << depth : 2 << depth], right[:, 1 << depth : 2 << depth] = below[:, ::2], below[:, 1::2]
            below = below[:, ::2] + below[:, 1::2]
        return left, right


def log_odds(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    return np.clip(np.log((right + _PRIOR) / (left + _PRIOR)), -_CLIP, _CLIP)


class Mixer:
    """Weights by gate and the refining table; ``learn`` and ``predict`` go bit by bit over many tokens."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.weights = np.tile(np.array([0.3, 0.5, 0.25, 0.4, 0.0]), (CODE_BITS * GATES, 1))
        self.seen = np.zeros((CODE_BITS, LEVELS, 2))  # zeros and ones at each level of the mixed log-odds
        self.match = np.log((tables.hits + _PRIOR) / (tables.misses + _PRIOR))
        self.ready = False

    def prepare(self) -> None:
        """Log-odds of all nodes at once, for scoring."""
        t = self.tables
        self.odds = log_odds(t.right.astype(np.float32), t.left.astype(np.float32)).astype(np.float32).reshape(-1)
        self.gates = self._gate(t.left + t.right.astype(np.int64)).astype(np.int8).reshape(-1)
        self.odds0 = log_odds(t.right0, t.left0)
        zeros, ones = self.seen[..., 0], self.seen[..., 1]
        level = np.linspace(-_CLIP, _CLIP, LEVELS)
        prior = 1 / (1 + np.exp(-level))
        self.refined = (ones + 20 * prior) / (zeros + ones + 20)
        self.ready = True

    @staticmethod
    def _gate(n: np.ndarray) -> np.ndarray:
        return np.minimum(np.log2(n + 1.0) / 2.5, GATES - 1).astype(np.int64)

    def _bit(self, c: Codes, depth: int, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bit, inputs, gate) of all tokens at a depth; ``own``: count each token's own occurrence out."""
        bit = c.code >> (CODE_BITS - 1 - depth) & 1
        node = (1 << depth) + (c.code >> (CODE_BITS - depth))
        inputs = np.empty((_INPUTS, len(bit)))
        a, b = c.before * LEAVES + node, (BEFORE + c.earlier) * LEAVES + node
        if own:
            t = self.tables
            flat_left, flat_right = t.left.reshape(-1), t.right.reshape(-1)
            out = 1 - bit
            inputs[0] = log_odds(t.right0[node] - bit, t.left0[node] - out)
            left, right = flat_left[a] - out, flat_right[a] - bit
            inputs[1] = log_odds(right, left)
            gate = self._gate(left + right)
            inputs[2] = log_odds(flat_right[b] - bit, flat_left[b] - out)
        else:
            inputs[0], inputs[1], inputs[2], gate = self.odds0[node], self.odds[a], self.odds[b], self.gates[a]
        expected = c.old >> (CODE_BITS - 1 - depth) & 1
        inputs[3] = np.where(c.agree >= depth, self.match[c.run, depth] * (2 * expected - 1), 0)
        inputs[4] = 0.3
        return bit, inputs, depth * GATES + gate.astype(np.int64)

    def _mixed(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        w = self.weights[gate]
        total = inputs[0] * w[:, 0]
        for i in range(1, _INPUTS):
            total += inputs[i] * w[:, i]
        return np.clip(total, -_CLIP, _CLIP)

    def learn(self, c: Codes) -> None:
        for depth in range(CODE_BITS):
            bit, inputs, gate = self._bit(c, depth, own=True)
            mixed = self._mixed(inputs, gate)
            error = bit - 1 / (1 + np.exp(-mixed))
            level = np.rint((mixed + _CLIP) * ((LEVELS - 1) / (2 * _CLIP))).astype(np.int64)
            self.seen[depth] += np.bincount(level * 2 + bit, minlength=2 * LEVELS).reshape(LEVELS, 2)
            n = np.bincount(gate, minlength=CODE_BITS * GATES) + 50
            for i in range(_INPUTS):
                self.weights[:, i] += RATE * np.bincount(gate, error * inputs[i], CODE_BITS * GATES) / n

    def log_probabilities(self, c: Codes) -> np.ndarray:
        """Natural logarithm of the probability of each token's code."""
        total = np.zeros(len(c.code))
        for depth in range(CODE_BITS):
            bit, inputs, gate = self._bit(c, depth, own=False)
            mixed = self._mixed(inputs, gate)
            place = (mixed + _CLIP) * ((LEVELS - 1) / (2 * _CLIP))
            low = np.minimum(place.astype(np.int64), LEVELS - 2)
            part = place - low
            refined = self.refined[depth, low] * (1 - part) + self.refined[depth, low + 1] * part
            p = (1 / (1 + np.exp(-mixed)) + refined) / 2
            total += np.log(np.where(bit == 1, p, 1 - p))
        return total


def _learned(tables: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, total = Mixer(tables.value), 0
        for batch in batches:
            for w in textkit.words(batch.column(0), BATCH_BYTES):
                stream, first, _ = token_stream(w)
                mixer.learn(Codes(stream, first))
                total += len(stream)
        yield _mixer_row(total, mixer.weights * total, mixer.seen)

    return run


def _mixer_row(total: int, weights: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"n": pa.array([total], pa.int64()), "weights": pa.array([weights.tobytes()], pa.binary()), "seen": pa.array([seen.tobytes()], pa.binary())}
    )


def _add_mixers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weights, seen = 0, np.zeros((CODE_BITS * GATES, _INPUTS)), np.zeros((CODE_BITS, LEVELS, 2))
    for batch in batches:
        for n, w, s in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            total += n
            weights += np.frombuffer(w.as_buffer()).reshape(weights.shape)
            seen += np.frombuffer(s.as_buffer()).reshape(seen.shape)
    if total:
        yield _mixer_row(total, weights, seen)


class Model:
    """What scoring needs in the tasks: mixer, counts of frequent words, and the size of every code."""

    def __init__(self, mixer: Mixer, words: np.ndarray, counts: np.ndarray, code_total: np.ndarray):
        order = np.argsort(words)
        self.mixer, self.words, self.logs = mixer, words[order], np.log10(counts[order] + 1.0)
        self.code_log = np.log10(code_total)


def _scored(model: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        if not m.mixer.ready:
            m.mixer.prepare()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            for w in textkit.words(batch.column(1), 1 << 19):
                stream, first, rows = token_stream(w)
                c = Codes(stream, first)
                n = len(w.counts)
                at = np.minimum(np.searchsorted(m.words, stream), max(0, len(m.words) - 1))
                known = m.words[at] == stream if len(m.words) else np.zeros(len(stream), dtype=bool)
                logs = np.where(known, m.logs[at], 0.0) if len(m.words) else np.zeros(len(stream))
                code = m.mixer.log_probabilities(c) / math.log(10) - m.code_log[c.code]
                sums = lambda x: pa.array(np.bincount(rows, x, n))
                rest = ~known
                bounds = np.concatenate([[0], np.cumsum(np.bincount(rows[rest], minlength=n))]).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(bounds), pa.array(stream[rest].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(n)),
                        batch.column(0).slice(w.rows.start, n),
                        pa.array(np.diff(first)),
                        pa.array(np.diff(w.offsets)),
                        pa.array(np.bincount(rows, known, n).astype(np.int64)),
                        sums(logs),
                        sums(code),
                        rare,
                    ],
                    names=["row", "doc_id", "n_tokens", "n_bytes", "n_known", "logs", "code", "rare"],
                )
                row += n

    return run


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Words and counts above a threshold that leaves ``FREQUENT`` words at most."""
    level = F.floor(8 * F.log2("c"))
    rows = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()  # eight rows per doubling
    total, least = 0, None
    for r in sorted(rows, key=lambda r: -r.level):
        total += r.n
        if total > FREQUENT:
            break
        least = r.level
    if least is None:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    chosen = counts.where(level >= least).toPandas()
    return chosen["word"].to_numpy(np.int64).view(np.uint64), chosen["c"].to_numpy(np.float64)


def train(documents: DataFrame) -> tuple[DataFrame, Broadcast, int, int]:
    """(word counts, model, N, V) from the documents that aren't held out."""
    spark = documents.sparkSession
    context = spark.sparkContext
    texts = documents.where(~held_out(F.col("doc_id"), *HELD_OUT)).select("text")
    counts = stored(
        texts.mapInArrow(_word_counts, "word long, c long").groupBy("word").agg(F.sum("c").alias("c")), "word-counts"
    )
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()

    values = dense.total(texts.mapInArrow(_context_counts, dense.SCHEMA), _CELLS + _MATCH)
    tables = Tables(values[:_CELLS], values[_CELLS:])
    shared = context.broadcast(tables)

    schema = "n long, weights binary, seen binary"
    rows = texts.mapInArrow(_learned(shared), schema).repartition(16).mapInArrow(_add_mixers, schema).collect()
    mixer = Mixer(tables)
    tokens = sum(r.n for r in rows)
    if tokens:
        mixer.weights = sum(np.frombuffer(bytes(r.weights)) for r in rows).reshape(mixer.weights.shape) / tokens
        mixer.seen = sum(np.frombuffer(bytes(r.seen)) for r in rows).reshape(mixer.seen.shape)

    code = F.shiftrightunsigned("word", 64 - CODE_BITS).cast("int")
    per_code = counts.groupBy(code.alias("code")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()  # LEAVES rows at most
    code_total = np.ones(LEAVES)
    for r in per_code:
        code_total[r.code] += r.c + r.v
    return counts, context.broadcast(Model(mixer, *_frequent(counts), code_total)), total, distinct


def score(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts, model, total, distinct = train(documents)
    schema = "row long, doc_id long, n_tokens long, n_bytes long, n_known long, logs double, code double, rare array<long>"
    scored = stored(documents.mapInArrow(_scored(model), schema), "scored")
    rare = (
        scored.select("row", F.explode("rare").alias("word"))
        .groupBy("row", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(counts, "word")
        .groupBy("row")
        .agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_logs"))
    )
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    result = F.col("code") + logs
    return (
        scored.drop("rare")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            held_out(F.col("doc_id"), *HELD_OUT).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (logs - F.col("n_tokens") * F.lit(math.log10(total + distinct + 1))).alias("base_score"),
            result.alias("score"),
            F.when(F.col("n_bytes") > 0, -result * F.lit(math.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"),
        )
    )
