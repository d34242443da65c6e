"""Whitening against numpy's eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from marginflow.llm import whitening
from marginflow.llm.queries import QUERIES
from tests.conftest import SF_SMALL

VECTORS = "vec_id long, embedding array<double>, label int, data binary, m long, v string, width long"


def brute(vectors):
    """n, sums, eigenvalues and unit components of the fit list, by numpy."""
    width = max(map(len, vectors))
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    z = fit - sums / n
    values, u = np.linalg.eigh(z.T @ z / n)
    return x, n, sums, values[::-1], u[:, ::-1]


def check(rows, vectors, ids, components=16):
    x, n, sums, values, u = brute(vectors)
    r = min(components, int((values > 1e-9 * values[0]).sum()))
    assert len(rows) == len(ids) * r
    by = {}
    for row in rows:
        by.setdefault((row.vec_id, row.deviation), {}).setdefault(row.component, []).append(row)
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(axis=1)
    assert sorted(map(str, by)) == sorted({str((i, int(d))) for i, d in zip(ids, deviation)})
    z = x - sums / n
    for c in range(r):
        want = z @ u[:, c] / math.sqrt(values[c])
        got = np.array([by[i, int(d)][c + 1][0].whitened for i, d in zip(ids, deviation)])
        clear = (values[c - 1] - values[c] if c else math.inf) > 1e-3 and (c + 1 == len(values) or values[c] - values[c + 1] > 1e-3)
        if clear:
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
        one = by[ids[0], int(deviation[0])][c + 1][0]
        assert one.n == n and abs(one.explained / (values[c] / values.sum()) - 1) < 1e-9
    assert len({row.identity_error for row in rows}) == 1 and rows[0].identity_error < 1e-9


def test_query_matches_numpy(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, SF_SMALL).collect(), [v for _, v in rows], [i for i, _ in rows])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, 1, "x", 2) for i, v in rows], VECTORS)


def test_odd_vectors(spark):
    """Null, non-finite and empty vectors, short ones, copies, ids null and repeated."""
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(60)]
    good += [(None, good[0][1]), (1, good[1][1]), (2, [4.0, -4.0]), (3, []), *[(100 + i, good[5][1]) for i in range(200)]]
    bad = [(4, None), (5, [1.0, None, 2.0, 3.0, 4.0]), (6, [math.nan] * 5), (7, [math.inf, 0.0])]
    df = frame(spark, good + bad)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    check(rows, [v for _, v in good], [i for i, _ in good])


def test_tables_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        df = frame(spark, rows)
        assert whitening.whiten(df, whitening.fit(df)).collect() == []


def test_components_beyond_the_rank_are_left_out(spark):
    rng = np.random.default_rng(5)
    flat = [(i, [float(c) for c in rng.integers(-50, 50, 3)] + [0.0] * 40) for i in range(300)]
    df = frame(spark, flat)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    assert {r.component for r in rows} == {1, 2, 3}
    check(rows, [v for _, v in flat], [i for i, _ in flat])


def test_huge_entries_keep_deviation_exact(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [1e300, -1e300])]
    df = frame(spark, rows[:2])
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, whitening.fit(df)).collect()}
    x = [[2**46, 0], [0, 64]]
    want = {i + 1: sum((2 * a - s) ** 2 for a, s in zip(v, [2**46, 64])) for i, v in enumerate(x)}
    assert got == {i: (d if d < 2**63 else None) for i, d in want.items()}
    df = frame(spark, rows)
    assert all(math.isfinite(r.whitened) for r in whitening.whiten(df, whitening.fit(df)).collect())


@pytest.mark.parametrize("spread", [0.0, 1e-9, 0.01, 1.0])
def test_close_and_equal_eigenvalues_are_certified(spread):
    """The iteration alone: clusters at the cut, also exact ties."""
    rng = np.random.default_rng(7)
    d = 200
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = np.concatenate([[50.0, 49.0], 10 + spread * rng.random(40), 9 * rng.random(d - 42)])
    matrix = (q * values) @ q.T
    passes = []
    apply = lambda x: (passes.append(x.shape[1]), (matrix @ x, float(values.sum())))[1]
    e, u, trace = whitening._leading(apply, d, 16, 32)
    assert np.abs(e - np.sort(values)[::-1][:16]).max() < 1e-10
    assert np.abs(u.T @ u - np.eye(16)).max() < 1e-12
    assert np.abs(matrix @ u - u * e).max() < 1e-10
