"""Rows grouped by their bins, tasks of several streams of steps, and tables without ids: against the rows themselves."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabml.fits import ensembles, frame as fr, gradient
from tabml.functions.exprs import md5_key


def table(spark, n=600):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 4, n), rng.integers(0, 3, n)]).astype(float)
    y = (x.sum(axis=1) + rng.standard_normal(n) > 2.5).astype(int)
    df = spark.createDataFrame([(f"r{i}", x[i].tolist(), int(y[i]), i % 3) for i in range(n)], "id string, a array<double>, label int, fold int")
    return df.withColumn("h", md5_key("id", seed=42)).withColumn("split", F.lit("train")).withColumn("features", array_to_vector("a"))


@pytest.fixture(scope="module")
def data(spark):
    return table(spark).cache()


def blocks_of(table):
    schema = fr.CELL_BLOCK if "c" in table.columns else fr.BLOCK
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in table.collect()], schema=schema)
    return list(fr.rows_in(batch))


def by_bins(bins, *columns):
    out = {}
    for b, *v in zip(map(tuple, bins.tolist()), *columns):
        out[b] = np.add(out.get(b, 0), v)
    return {k: v.tolist() for k, v in out.items()}


def test_cells_have_the_sums_of_the_rows(data):
    part = fr.Part((1, 2, None), 150)
    with fr.training_frame(data, 3, curve=True) as frame:
        rows = blocks_of(frame.blocks)
        cells = blocks_of(frame.cells)
    assert sum(c.n for c in cells) == sum(r.n for r in rows) == frame.n == 600
    assert all(c.c <= 12 and len(np.unique(c.bins, axis=0)) == c.c for c in cells)   # each combination of bins once
    assert sorted(np.concatenate([c.key for c in cells])) == sorted(np.concatenate([r.key for r in rows]))
    want, got = {}, {}
    for kind, out in ((rows, want), (cells, got)):
        for r in kind:
            weight = r.member(part) * (r.uniform(7) < 0.6).astype(float)
            one = by_bins(fr.binned(r.x, frame.edges), weight, weight * r.y) if kind is rows else by_bins(r.bins, *r.sums(weight))
            for k, v in one.items():
                out[k] = np.add(out.get(k, 0), v).tolist()
    assert want == got and sum(v[0] for v in want.values()) > 0


def test_cells_are_made_for_trees_only_and_shuffle_nothing(data):
    with fr.training_frame(data) as frame:
        gradient.fit_sgd(frame, [(fr.Part(), {"max_iter": 1})])
        assert not frame.made
        ensembles.fit_samme(frame, [(fr.Part(), {"n_estimators": 2})])
        assert "Exchange" not in frame.cells._jdf.queryExecution().sparkPlan().toString().split("InMemoryRelation")[0]
        assert frame.cells.rdd.getNumPartitions() == frame.blocks.rdd.getNumPartitions()
    assert not frame.made


def test_more_tasks_make_no_more_cells(spark, data):
    """A cell lies in one task, but for those that a task's range cuts; a frequent one is cut into several tasks."""
    with fr.training_frame(data, 3) as frame:
        tasks, cells = frame.blocks.rdd.getNumPartitions(), blocks_of(frame.cells)
        assert tasks > 2 and sum(c.c for c in cells) <= 12 + tasks - 1
    one = data.withColumn("features", array_to_vector(F.array(F.lit(1.0), F.lit(2.0))))
    with fr.training_frame(one, 3) as frame:
        cells = blocks_of(frame.cells)
        assert sum(c.n for c in cells) == 600 and max(c.n for c in cells) < 300


def test_trees_that_draw_alike_are_summed_once_a_block(data, monkeypatch):
    made = []
    monkeypatch.setattr(fr.Cells, "sums", lambda rows, weight, own=fr.Cells.sums: made.append(1) or own(rows, weight))
    with fr.training_frame(data, 3) as frame:
        block = blocks_of(frame.cells)[0]
        jobs = [(fr.Part().without(0, f), True) for f in (0, 1)] * 4   # four candidates of two folds, three trees each
        owner = [j for j in range(8) for _ in range(3)]
        source = ensembles.ForestSource(frame.edges, jobs, owner, [100 + i for _ in range(8) for i in range(3)])
        for e in sorted(range(24), key=source.order):
            a = source.of(block, e)
            weight = block.member(jobs[owner[e]][0]) * np.searchsorted(ensembles.POISSON, block.uniform(source.seeds[e]), "right")
            want = np.bincount(block.cell, weight, block.c)
            assert a is None and not want.any() or np.array_equal(a[1], want[want > 0])
    assert len(made) == 6


def test_streams_are_averaged_as_tasks_are(data):
    with fr.training_frame(data) as frame:
        rows = max(blocks_of(frame.blocks), key=lambda r: r.n)
    some = [rows.take(own) for own in np.split(np.arange(rows.n), [3, rows.n - 5])]
    group = dict(design=gradient.Design(), parts=[fr.Part(), fr.Part().without(1, 0)], alpha=np.array([0.01, 0.1]), hinge=np.array([True, False]),
                 t0=np.array([10.0, 10.0]), schedule=np.array([2, 2]), eta0=np.array([0.1, 0.1]), w=np.zeros((2, 2)), b=np.zeros(2), t=np.zeros(2))

    def epoch(rows, streams):
        task = gradient.LinearEpoch(([group], 9, streams))
        for r in rows:
            task.see(r)
        return task.result()

    assert len(some) > 1
    assert np.allclose(epoch(some, len(some)), sum(epoch([r], 1) for r in some))
    assert np.allclose(epoch(some * 2, 4 * len(some)), sum(epoch([r], 1) for r in some * 2))
    assert not epoch([], 4).any()


def test_streams_of_networks_are_averaged_as_tasks_are(data):
    with fr.training_frame(data) as frame:
        rows = max(blocks_of(frame.blocks), key=lambda r: r.n)
    some = [rows.take(own) for own in np.split(np.arange(rows.n), [rows.n // 4, rows.n - 3])]
    shape, size = (2, 3, 1), 2 * 3 + 3 + 3 + 1
    v = np.concatenate([np.random.default_rng(5).standard_normal((2, size)), np.zeros((2, 2 * size))], axis=1)
    group = dict(design=gradient.Design(), shape=shape, batch=8, parts=[fr.Part(), fr.Part().without(1, 0)], early=np.array([True, False]),
                 alpha=np.array([0.01, 0.1]), rate=np.array([0.05, 0.01]), v=v, t=np.zeros(2))

    def epoch(rows, streams):
        task = gradient.MlpEpoch(([group], 5 + 3 * size, streams))
        for r in rows:
            task.see(r)
        return task.result()

    assert np.allclose(epoch(some, len(some)), sum(epoch([r], 1) for r in some))
    assert np.allclose(epoch(some * 2, 4 * len(some)), sum(epoch([r], 1) for r in some * 2))
    assert not epoch([], 4).any()


def test_cosines_are_cosines():
    rng = np.random.default_rng(0)
    x, w, b = rng.standard_normal((300, 3)) * 5, rng.standard_normal((3, 17)), rng.uniform(0, 6, 17)
    assert np.allclose(gradient.cosines(x, w, b, 0.3), 0.3 * np.cos(x @ w + b), rtol=0, atol=1e-13)


def test_stored_margins_give_the_same_probability(data, monkeypatch):
    with fr.training_frame(data) as frame:
        job = [(fr.Part(), {"max_iter": 2, "n_features": 8})]
        stored = gradient.fit_svm(frame, job)[0]
        monkeypatch.setattr(gradient, "STORED_JOBS", 0)
        assert np.allclose(stored.platt, gradient.fit_svm(frame, job)[0].platt, rtol=1e-9)


def test_a_table_without_ids_gives_the_same_rows(data):
    lean = data.withColumn(fr.KEY, F.xxhash64("id")).drop("id")
    with fr.training_frame(data, 3) as a, fr.training_frame(lean, 3) as b:
        assert sorted(map(str, a.rows.collect())) == sorted(map(str, b.rows.collect()))
