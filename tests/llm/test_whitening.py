import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabml.llm import whitening as wh


def frame(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("x", "n", "component", "vector", "label")})


def plain(vectors, k):
    """n, exact deviations, eigenvalues, whitened rows and trace, with numpy's dense solver."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x)]
    off = [[n * c - s for c, s in zip(r, sums)] for r in x]
    centred = np.array(off, object) / n
    centred = centred.astype(float)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, [sum(c * c for c in r) for r in off], e, centred @ u / np.sqrt(np.maximum(e, 1e-300)), float((centred ** 2).sum() / n)


def compare(rows, ids, vectors, k, close=1e-9):
    n, deviations, e, white, trace = plain(vectors, k)
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(ids) * len(e)
    got = np.array([[by[i][c + 1].whitened for c in range(len(e))] for i in ids])
    sign = np.sign((got * white).sum(axis=0))
    assert np.abs(got * sign - white).max() < close
    assert [by[i][1].deviation for i in ids] == deviations and {r.n for r in rows} == {n}
    assert np.allclose([by[ids[0]][c + 1].explained for c in range(len(e))], e / trace, rtol=1e-10)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    vectors = (rng.standard_normal((40, 5)) * [3, 2, 1, 0.5, 0.1] + 7).tolist()
    data = [(i, v) for i, v in enumerate(vectors)]
    data += [(100, None), (101, [None] + vectors[0][1:]), (102, [float("nan")] * 5), (103, [float("inf")] + vectors[0][1:]), (104, []),
             (105, vectors[0][:4]), (106, [1e300] + vectors[0][1:])]
    got = wh.whiten(frame(spark, data), components=8).collect()
    compare(got, list(range(40)), vectors, 5)


def test_repeated_rows_count(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((12, 3)).tolist()
    data = [(i, v) for i, v in enumerate(vectors)] + [(50 + i, vectors[0]) for i in range(30)] + [(None, vectors[1])]
    got = wh.whiten(frame(spark, data), components=2).collect()
    named = [r for r in got if r.vec_id is not None]
    assert len(got) == len(data) * 2 and {r.n for r in got} == {43}
    n, deviations, e, white, _ = plain([v for _, v in data], 2)
    assert [r.deviation for r in sorted(named, key=lambda r: (r.vec_id, r.component)) if r.component == 1] == deviations[:42]
    assert np.allclose([r.explained for r in sorted(got, key=lambda r: r.component)][0], e[0] / np.trace(np.cov(np.floor(1024 * np.array([v for _, v in data])).T, bias=True)))


def test_rank_of_one_and_of_none(spark):
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)]
    got = wh.whiten(frame(spark, line)).collect()
    assert len(got) == 30 and all((r.whitened is None) == (r.component > 1) for r in got)
    assert {round(r.explained, 12) for r in got} == {1.0, 0.0} and got[0].identity_error < 1e-12
    same = wh.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(same) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 and r.identity_error is None for r in same)


def test_empty_tables(spark):
    assert wh.whiten(frame(spark, [(1, [1.0])]).where("false")).count() == 0
    assert wh.whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_exact_where_64_bits_do_not_hold(spark):
    big = [(i, [float(2 ** 41 + 3 * i * i), -float(i)]) for i in range(5)]
    rows = [r for r in wh.whiten(frame(spark, big)).collect() if r.component == 1]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in big]
    sums = [sum(c) for c in zip(*x)]
    assert [r.deviation for r in sorted(rows)] == [sum((5 * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    far = wh.whiten(frame(spark, [(1, [2.0 ** 41]), (2, [-(2.0 ** 41)])])).collect()
    assert all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-12 for r in far)


def test_whole_table(spark, sf_tiny):
    table = spark.read.parquet(f"{sf_tiny}/embeddings.parquet")
    rows = sorted((r.vec_id, r.embedding) for r in table.collect())
    compare(wh.whiten(table).collect(), [i for i, _ in rows], [v for _, v in rows], 8)


def test_sums_of_many_tasks(spark):
    rows = spark.range(0, 3000, 1, 100).select(F.array(F.col("id"), -F.col("id")).alias("x"))
    for tasks in (1, 100):  # added by the driver alone, or in ten tasks first
        got = wh._sum_of(rows, tasks, lambda b: wh._matrix(b.column(0)).sum(axis=0).astype(float), (2,))
        assert got.tolist() == [2999 * 1500.0, -2999 * 1500.0]


class Dense:
    """A covariance at hand, which counts products."""

    def __init__(self, a):
        self.a, self.dim, self.products = a, len(a), 0

    def __matmul__(self, q):
        self.products += 1
        return self.a @ q


@pytest.mark.parametrize("spectrum", ["near", "far", "ties", "tail"])
def test_solver_restarts_and_locks(spectrum):
    """600 dimensions, a search space of 40: the space is restarted before the pairs are right."""
    rng = np.random.default_rng(7)
    d, k = 600, 8
    e = {"near": 1 + 0.2 * np.sort(rng.random(d))[::-1], "far": np.geomspace(1e6, 1e-3, d),
         "ties": np.concatenate([np.full(5, 9.0), np.full(6, 4.0), np.linspace(3, 0, d - 11)]),
         "tail": np.concatenate([np.linspace(10, 9, 12), np.zeros(d - 12)])}[spectrum]
    u = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (u * e) @ u.T
    a = (a + a.T) / 2
    v = Dense(a)
    values, q = wh.leading(v, k, space=40)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=1e-12)
    assert np.abs(a @ q - q * values).max() < 1e-11 * e[0] and np.abs(q.T @ q - np.eye(k)).max() < 1e-11


def test_minres_against_a_direct_solution():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    q = np.linalg.qr(rng.standard_normal((20, 3)))[0]
    p = np.eye(20) - q @ q.T
    b = rng.standard_normal((20, 2))
    theta = np.array([0.3, -1.1])
    t = wh.minres(Dense(a), theta, q, b, 40)
    for j in range(2):
        assert np.abs(p @ (a - theta[j] * np.eye(20)) @ p @ t[:, j] - p @ b[:, j]).max() < 1e-8
