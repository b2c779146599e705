import math
import random

import numpy as np
from pyspark.sql import functions as F

from tabml.functions.quantile import bracketed_counts, exact_quantiles, fit_quantiles


def test_even_median_interpolates(spark):
    # tiny_even_median: 1,2,3,4 -> 2.5 (a lower-median imputer gives 2)
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert fit_quantiles(df, ["x"], [0.5])["x"] == [2.5]


def test_quantiles_match_numpy_with_duplicates_and_gaps(spark):
    rng = random.Random(11)
    vals = [float(rng.randint(0, 40)) for _ in range(777)] + [None] * 5 + [float("nan")] * 3
    df = spark.createDataFrame([(v, v * 3 if v is not None else None) for v in vals], "a double, b double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = fit_quantiles(df, ["a", "b"], probs)
    clean = np.array([v for v in vals if v is not None and not math.isnan(v)])
    for c, arr in (("a", clean), ("b", clean * 3)):
        for p, q in zip(probs, got[c]):
            assert abs(q - np.percentile(arr, p * 100)) < 1e-9


def test_grouped_and_all_null(spark):
    df = spark.createDataFrame([("g", 1.0, None), ("g", 5.0, None), ("h", 7.0, None)],
                               "k string, x double, y double")
    rows = exact_quantiles(df, ["x", "y"], [0.5], group_cols=["k"]).collect()
    got = {(r.k, r.column): r.value for r in rows}
    assert got == {("g", "x"): 3.0, ("h", "x"): 7.0}   # all-NULL column absent
    assert fit_quantiles(df, ["y"], [0.5]) == {"y": [None]}


def test_refinement_rounds_give_exact_values(spark):
    # tiny buckets and final windows force several refinement rounds,
    # including a dense cluster of distinct values
    rng = random.Random(4)
    vals = [rng.random() for _ in range(600)] + [0.5 + i * 1e-9 for i in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.1, 0.5, 0.77, 0.99]
    rows = exact_quantiles(df, ["x"], probs, buckets=4, max_final=3).collect()
    got = {r.p_idx: r.value for r in rows}
    for i, p in enumerate(probs):
        assert abs(got[i] - np.percentile(np.array(vals), p * 100)) < 1e-12


def test_approx_method_close_to_exact(spark):
    rng = random.Random(8)
    vals = [rng.gauss(0, 1) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ex = fit_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    ap = fit_quantiles(df, ["x"], [0.25, 0.5, 0.75], method="approx")["x"]
    srt = sorted(vals)
    for e, a in zip(ex, ap):
        # rank error of the approximation is bounded: compare positions
        assert abs(np.searchsorted(srt, e) - np.searchsorted(srt, a)) <= 5


def test_brackets_hold_every_target(spark):
    """A coarse sketch, so that most values lie outside the brackets; ties, clusters and the ends."""
    rng = random.Random(9)
    vals = [rng.gauss(0, 1) for _ in range(6000)] + [0.25] * 1500 + [1e9 + i for i in range(40)] + [-5.0] * 700
    rng.shuffle(vals)
    df = spark.createDataFrame([(v, float(i % 3)) for i, v in enumerate(vals)], "x double, y double").repartition(7)
    probs = [0.0, 0.001, 0.1, 0.25, 0.333, 0.5, 0.6, 0.75, 0.999, 1.0]
    counts = bracketed_counts(df, ["x", "y"], probs, accuracy=200)
    assert counts.where("column = 'x'").count() < 2500 and counts.groupBy("column").sum("__cnt").where("`sum(__cnt)` <> 8240").count() == 0
    got = {(r.column, r.p_idx): r.value for r in exact_quantiles(df, ["x", "y"], probs, accuracy=200).collect()}
    for c, arr in (("x", np.array(vals)), ("y", np.arange(len(vals)) % 3.0)):
        for i, p in enumerate(probs):
            assert abs(got[c, i] - np.percentile(arr, p * 100)) <= 1e-12 * max(1, abs(got[c, i]))
    few = {r.p_idx: r.value for r in exact_quantiles(df, ["x"], probs, buckets=8, max_final=5, accuracy=200).collect()}
    assert all(few[i] == got["x", i] for i in few) and len(few) == len(probs)


def test_any_number_of_groups(spark):
    """120,000 (group, column) pairs; their rows stay a table."""
    df = spark.range(360_000).select((F.col("id") % 60_000).alias("k"), F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    out = exact_quantiles(df, ["x", "y"], [0.5], ["k"])
    assert out.count() == 120_000
    bad = out.where(F.col("value") != F.when(F.col("column") == "x", F.col("k") + 150_000.0).otherwise(-F.col("k") - 150_000.0))
    assert bad.count() == 0
    assert fit_quantiles(df, ["x"], [0.5])["x"] == [179_999.5]
