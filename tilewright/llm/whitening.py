"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries become the integers ``floor(64 * c) + 1000000``; equal vectors count once. Sums per dimension
and, about the mean, products of dimensions are added up by tasks; the driver sees a row per dimension and
a matrix of dimensions, whatever the number of vectors. With ``P' A P = L L'``, the columns of the lower
trapezoidal ``L`` are rotated against each other until all are orthogonal: their squared norms are the
eigenvalues, the columns over their norms the components. Neither step forms a product of ``L`` with
itself, so small eigenvalues keep their digits, and pivoting makes few sweeps enough.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped; of
vectors of several lengths the most frequent length is fitted and scored (of equally frequent ones the
greatest) and the others are dropped; repeated rows are scored each, and fitted once; rows with a null
id are scored under null; entries beyond ``GREATEST`` count as non-finite; directions without variance are no components, so fewer than
``COMPONENTS`` come out of few vectors or dimensions, and none of a single one; no rows give no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.shared import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond are no exact integers any more; their rows are dropped like non-finite ones.
GREATEST = 2.0**46
#: A direction has no variance below this share of the greatest diagonal entry.
TINY = 1e-13


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, size, x (int64 bytes) of the rows whose entries are all finite."""
    for batch in batches:
        vectors = batch.column(1)
        sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0)).astype(np.int64)
        entries = vectors.flatten()
        values = np.asarray(pc.fill_null(entries.cast(pa.float64()), float("nan")))
        values = np.where(np.abs(values) < GREATEST, values, np.nan)
        ends = np.cumsum(sizes)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        good = (sizes > 0) & (bad[ends] == bad[ends - sizes])
        x = np.floor(np.where(np.isfinite(values), values, 0) * SCALE).astype(np.int64) + SHIFT
        data = x.tobytes()
        packed = [data[8 * (e - n) : 8 * e] for e, n in zip(ends[good], sizes[good])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(pa.array(good)), pa.array(sizes[good].astype(np.int32)), pa.array(packed, pa.binary())],
            names=["vec_id", "size", "x"],
        )


def integer_vectors(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id, size, x: the vectors of the most frequent length, as int64 bytes."""
    read = embeddings.select(F.col("vec_id").cast("long"), F.col(column).cast("array<double>"))
    vectors = stored(read.mapInArrow(_integers, "vec_id long, size int, x binary"), "whiten-vectors")
    sizes = vectors.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return vectors.where(F.col("size") == (sizes.size if sizes else 0))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a binary column as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.int64).reshape(-1, size)


def _sums(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            total += _matrix(batch.column(0), size).sum(axis=0)
            n += len(batch)
        dims = pa.array(np.arange(size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([dims, pa.array(total), pa.array(np.full(size, n))], names=["i", "s", "n"])

    return run


def _products(size: int, turned: Callable[[np.ndarray], np.ndarray], out: int) -> Callable:
    """i, j, v: products of the columns of ``turned`` vectors, added over a task; j from i on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((out, out))
        for batch in batches:
            y = turned(_matrix(batch.column(0), size))
            total += y.T @ y
        i, j = np.triu_indices(out)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    return run


def _scatter(fit: DataFrame, size: int, turned: Callable[[np.ndarray], np.ndarray], out: int) -> np.ndarray:
    """Sum over the fit list of the products of all dimensions of ``turned``: out * (out + 1) / 2 rows for the driver."""
    parts = fit.select("x").mapInArrow(_products(size, turned, out), "i int, j int, v double")
    matrix = np.zeros((out, out))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toLocalIterator():
        matrix[row.i, row.j] = matrix[row.j, row.i] = row.v
    return matrix


def pivoted_cholesky(matrix: np.ndarray, tiny: float = TINY) -> np.ndarray:
    """L (rows in the order of ``matrix``, rank columns) with ``L L' = matrix``, greatest pivots first."""
    rest, columns = np.array(matrix, dtype=float), []
    least = tiny * max(0.0, rest.diagonal().max(initial=0.0))
    for _ in range(len(rest)):
        p = int(np.argmax(rest.diagonal()))
        if not rest[p, p] > least:
            break
        column = rest[:, p] / np.sqrt(rest[p, p])
        rest -= np.outer(column, column)
        # what is pivoted is done with: no rounding is left behind
        rest[p, :] = rest[:, p] = 0.0
        columns.append(column)
    return np.array(columns).T.reshape(len(rest), len(columns))


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of ``factor @ factor.T``: the columns are rotated in pairs until orthogonal.

    All pairs of a sweep meet in rounds of disjoint pairs, turned in one go. Ends when the greatest
    cosine of a sweep is at rounding level.
    """
    u = np.array(factor, dtype=float)
    rank = u.shape[1]
    order = list(range(rank)) + ([] if rank % 2 == 0 else [-1])
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(order) - 1):
            half = len(order) // 2
            pairs = [(min(a, b), max(a, b)) for a, b in zip(order[:half], order[: half - 1 : -1]) if a >= 0 and b >= 0]
            order = [order[0], order[-1], *order[1:-1]]
            if not pairs:
                continue
            p, q = (np.array(side) for side in zip(*pairs))
            a, b = u[:, p], u[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            cosine = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, cosine.max())
            turn = cosine > 1e-16
            zeta = (bb - aa) / np.where(turn, 2 * ab, 1.0)
            t = np.where(turn, np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            u[:, p], u[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst <= 4 * np.finfo(float).eps * len(u):
            break
    else:
        raise RuntimeError(f"the columns were not orthogonal after {sweeps} sweeps")
    values = (u * u).sum(axis=0)
    falling = np.argsort(-values, kind="stable")
    return values[falling], u[:, falling] / np.sqrt(values[falling])


@dataclass
class Whitening:
    """What was fitted: vectors are projected by ``(x - sums / n) @ turn``."""

    n: int
    sums: list[int]
    turn: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s // self.n for s in self.sums])) - np.array([s % self.n / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.turn

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S) ** 2, exact."""
        sums = np.array(self.sums)
        furthest = max(1, int(np.abs(self.n * x.astype(float) - sums).max(initial=0)))
        if furthest < 2**62 and len(sums) * furthest**2 < 2**62:
            return ((self.n * x - sums) ** 2).sum(axis=1).tolist()
        exact = self.n * x.astype(object) - sums.astype(object)
        return (exact * exact).sum(axis=1).tolist()


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors; None if there are none."""
    distinct = stored(vectors.select("x").distinct(), "whiten-fit")
    added = distinct.mapInArrow(_sums(size), "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rows = sorted(added.collect())  # a row per dimension
    if not rows or not rows[0].n:
        return None
    found = Whitening(rows[0].n, [r.s for r in rows], np.zeros((size, 0)), np.zeros(0), 0.0)
    scatter = _scatter(distinct, size, found.centred, size)
    values, vectors_ = jacobi_columns(pivoted_cholesky(scatter))
    found.explained = values[:components] / scatter.trace() if len(values) else values
    found.turn = vectors_[:, :components] / np.sqrt(values[:components] / found.n)
    kept = found.turn.shape[1]
    if kept:
        # measured on the whitened vectors, centred by their own mean, which is added as one more column
        with_one = lambda x: np.hstack([found.project(x), np.ones((len(x), 1))])
        moments = _scatter(distinct, size, with_one, kept + 1) / found.n
        mean = moments[:kept, kept]
        found.identity_error = float(np.abs(moments[:kept, :kept] - np.outer(mean, mean) - np.eye(kept)).max())
    return found


def _whitened(model: Whitening) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, kept = model.turn.shape
        for batch in batches:
            x = _matrix(batch.column(1), size)
            rows = np.repeat(np.arange(len(x)), kept)
            columns = [
                batch.column(0).take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(rows), model.n)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(rows)),
                pa.array(model.project(x).reshape(-1)),
                pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(rows), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return run


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every valid row and component.

    ``deviation`` is exact; one that does not fit into 64 bits is an error.
    """
    vectors = integer_vectors(embeddings, column)
    first = vectors.select("size").first()
    model = fit(vectors, first.size, components) if first else None
    if model is None or not model.turn.shape[1]:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    return vectors.select("vec_id", "x").mapInArrow(_whitened(model), SCHEMA)
