"""Whitening: the qd solver against numpy's SVD, the operator against plain eigenvectors of the covariance, edge rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from callcast.llm import whitening as W
from callcast.llm.queries import QUERIES
from callcast.sources.tables import table

RNG = np.random.default_rng(4)
MATRICES = {
    "plain": RNG.normal(size=(300, 40)),
    "graded": RNG.normal(size=(300, 40)) * np.logspace(0, -6, 40),
    "one column": RNG.normal(size=(20, 1)),
    "few rows": RNG.normal(size=(6, 15)),
    "zero": np.zeros((5, 4)),
    "rank one": np.ones((30, 5)),
    "equal values": np.vstack([np.eye(9)] * 3),
    "near-equal pairs": np.diag(np.abs(np.arange(-10.0, 11)) + 1) + np.diag(np.ones(20), 1),
    "blocks": np.kron(np.eye(4), RNG.normal(size=(6, 3))),
    "repeated columns": np.hstack([x := RNG.normal(size=(50, 5)), x]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_against_svd(name):
    a = MATRICES[name]
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    squares, v = W.principal_directions(r, a.shape[1])
    want = np.zeros(a.shape[1])
    s = np.linalg.svd(a, compute_uv=False)
    want[: len(s)] = s
    top = max(want[0], 1e-300)
    assert np.abs(np.sqrt(squares) - want).max() <= 1e-14 * top
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-11
    assert np.abs(a.T @ (a @ v) - v * squares).max() <= 1e-13 * top**2


def test_dqds_keeps_small_values_relatively_accurate():
    diag, off = np.logspace(0, -12, 12), np.logspace(-1, -13, 11)
    got = W.dqds(diag, off)
    assert np.prod(got) == pytest.approx(np.prod(diag), rel=1e-12)  # the determinant, of size 1e-72
    assert np.all(np.diff(got) <= 0) and got[-1] > 0


def brute(rows):
    """Contract by plain means: integers, covariance of all rows, numpy's eigenvectors."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    dev = {i: int(((n * r - s) ** 2).sum()) for (i, _), r in zip(kept, x)}
    c = x.astype(float) - np.array([float(t) / n for t in s])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    return kept, n, dev, c, e, q


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_against_plain_covariance(spark, sf):
    sf = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    kept, n, dev, c, e, q = brute(rows)
    at = {i: k for k, (i, _) in enumerate(kept)}
    got = QUERIES["op12_whitening"](spark, sf).collect()
    assert len(got) == 8 * n and {(r.vec_id, r.component) for r in got} == {(i, k) for i in at for k in range(1, 9)}
    white = np.zeros((n, 8))
    for r in got:
        assert r.n == n and r.deviation == dev[r.vec_id] == int(r.deviation_wide)
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-10)
        white[at[r.vec_id], r.component - 1] = r.whitened
    want = c @ q[:, :8] / np.sqrt(e[:8])
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white * sign - want).max() < 1e-7
    m = white - white.mean(axis=0)
    error = np.abs(m.T @ m / n - np.eye(8)).max()
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-9 and error <= 1e-9


def test_many_blocks_and_rounds_give_one_factor(spark, monkeypatch):
    monkeypatch.setattr(W, "_BLOCK_ROWS", 16)
    a = RNG.integers(99_000, 101_000, size=(700, 12))
    rows = spark.createDataFrame([(r.tolist(),) for r in a], "x array<bigint>").repartition(13)
    n, s = W.sums(rows)
    assert n == 700 and s == a.sum(axis=0).tolist()
    r = W.triangular_factor(rows, n, s, fan_in=3)
    c = a - a.mean(axis=0)
    assert np.allclose(r.T @ r, c.T @ c, rtol=1e-12, atol=1e-6) and np.allclose(r, np.triu(r))


def test_deviation_stays_exact_beyond_64_bits():
    x = RNG.integers(-(10**5), 10**5, size=(20, 6))
    for n, shift in ((10, 0), (10**6, 3), (10**9, 5), (10**14, 7)):
        total = np.array([int(v) * n + shift for v in x[0]], dtype=object)
        want = [int(sum((n * int(c) - t) ** 2 for c, t in zip(r, total))) for r in x]
        assert W.deviations(x, n, total) == want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [inf, 0.0]), (6, [1.0]), (7, []), (8, [0.5, -2.0]), (8, [0.5, -2.0]), (None, [3.0, 0.25])]
    got = W.whitened_components(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == [(False, 1, 1), (False, 1, 2), (False, 8, 1), (False, 8, 1), (False, 8, 2), (False, 8, 2), (True, 0, 1), (True, 0, 2)]
    assert all(r.n == 4 and math.isfinite(r.whitened) for r in got) and got[0].identity_error < 1e-9
    flat = spark.createDataFrame([(i, [1.5, float(i)]) for i in range(5)], "vec_id long, embedding array<double>").withColumn("component", F.lit("old"))
    assert {r.component for r in W.whitened_components(flat).collect()} == {1}
    same = spark.createDataFrame([(i, [1.5, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")
    assert W.whitened_components(same).count() == 0
    assert W.whitened_components(same.limit(0)).count() == 0
