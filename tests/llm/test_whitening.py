import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("tilewright.llm")

from tilewright.llm import whitening  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string"


def rows_of(vectors, first=0):
    return [(first + i, None if v is None else [None if c is None else float(c) for c in v], i % 3, "x", "n") for i, v in enumerate(vectors)]


def vectors(n=300, size=24, seed=2):
    rnd = np.random.default_rng(seed)
    return (rnd.normal(size=(n, size)) * np.linspace(3, 0.4, size) @ rnd.normal(size=(size, size))).astype(np.float32) + 2


def plain(valid):
    """(n, x by row, sums, covariance, mean) over the distinct vectors, in exact or plain arithmetic."""
    x = [tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in valid]
    fit = np.array(sorted(set(x)), dtype=np.int64)
    mean = fit.sum(axis=0) / len(fit)
    y = fit - mean
    return len(fit), x, [int(s) for s in fit.sum(axis=0)], y.T @ y / len(fit), mean


def test_whitening(spark):
    good = [*vectors(), *vectors()[:50]]
    odd = [None, [], [None] * 24, [float("nan")] + [0.0] * 23, [float("inf")] * 24, [1e30] * 24, [1.0, 2.0]]
    df = spark.createDataFrame(rows_of(good) + rows_of(odd, 1000) + [(None, good[0].tolist(), 0, "", "")], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    n, x, sums, cov, mean = plain(good)
    assert n == 300 and len(got) == 351 * 16
    assert {r.vec_id for r in got} == set(range(350)) | {None}
    values, turn = np.linalg.eigh(cov)
    values, turn = values[::-1][:16], turn[:, ::-1][:, :16]
    want = (np.array(x) - mean) @ turn / np.sqrt(values)
    table = np.zeros((350, 16))
    for r in got:
        if r.vec_id is not None:
            table[r.vec_id, r.component - 1] = r.whitened
            assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    assert np.abs(table - want * np.sign((table * want).sum(axis=0))).max() < 1e-7
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    whitened = table[:300]
    assert np.abs(np.cov(whitened.T, bias=True) - np.eye(16)).max() < 1e-9


def test_few_directions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0 and whitening.whiten(empty).columns[0] == "vec_id"
    for same in ([[1.0, 2.0]], [[1.0, 2.0]] * 5):
        assert whitening.whiten(spark.createDataFrame(rows_of(same), SCHEMA)).count() == 0
    # three vectors span a plane
    three = whitening.whiten(spark.createDataFrame(rows_of([[0, 0, 0, 1], [1, 0, 5, 1], [0, 9, 0, 1]]), SCHEMA)).collect()
    assert {r.component for r in three} == {1, 2} and sum(r.explained for r in three if r.vec_id == 0) == pytest.approx(1)
    # a tie of two lengths is decided for the greater one
    tie = whitening.whiten(spark.createDataFrame(rows_of([[0, 1], [3, 0], [0, 1, 1], [2, 0, 0]]), SCHEMA))
    assert {r.vec_id for r in tie.collect()} == {2, 3}


def test_wide_vectors_and_double_input(spark):
    wide = vectors(40, 300, 7).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(wide)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 40 * 16 and got[0].identity_error < 1e-9


def test_factor_and_rotations():
    rnd = np.random.default_rng(5)
    for rank, size in ((1, 1), (3, 7), (12, 12), (9, 30)):
        b = rnd.normal(size=(size, rank)) * 10.0 ** rnd.integers(-4, 4, rank)
        a = b @ b.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] <= size and np.abs(factor @ factor.T - a).max() <= 1e-10 * a.max()
        values, turn = whitening.jacobi_columns(factor)
        assert np.all(np.diff(values) <= 0)
        assert np.abs(turn.T @ turn - np.eye(turn.shape[1])).max() < 1e-12
        assert values[0] == pytest.approx(np.linalg.eigvalsh(a)[-1], rel=1e-12)
    # graded entries: small eigenvalues keep their digits
    graded = np.diag([1e8, 1.0, 1e-4]) + np.array([[0, 1, 1e-3], [1, 0, 1e-3], [1e-3, 1e-3, 0]])
    values, _ = whitening.jacobi_columns(whitening.pivoted_cholesky(graded))
    assert np.prod(values) == pytest.approx(np.linalg.det(graded), rel=1e-9)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_exact_deviation_beyond_64_bits():
    model = whitening.Whitening(10**9, [10**15 + 3, 7], np.zeros((2, 0)), np.zeros(0), 0.0)
    x = np.array([[999_990, 0], [1_000_001, 1]])
    want = [sum((10**9 * int(c) - s) ** 2 for c, s in zip(row, model.sums)) for row in x]
    assert model.deviations(x) == want
    assert pa.array([want[1]], pa.int64())[0].as_py() == want[1]
