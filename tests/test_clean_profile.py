import math

import numpy as np

from tabml.operators import clean as cl
from tabml.operators import profile as pf
from tabml.operators import scale as sc

LAB = "id long, a double, b double, diagnosis string"


def _tiny_labelled(spark):
    rows = [(1, 1.0, 10.0, "M"), (2, 2.0, None, "B"), (3, float("nan"), 30.0, "M"),
            (4, 4.0, 40.0, "B"), (5, 4.0, 40.0, "B"), (6, 6.0, 60.0, "X"),
            (7, 7.0, 70.0, "M"), (8, 8.0, 80.0, "B")]
    return spark.createDataFrame(rows, LAB)


def test_clean_table(spark):
    out = cl.clean_table(_tiny_labelled(spark))
    rows = sorted(tuple(r) for r in out.collect())
    assert "id" not in out.columns and len(rows) == 7          # ids 4 and 5 collapse
    med_a = np.median([1, 2, 4, 4, 6, 7, 8])
    assert (med_a, 30.0, 1) in rows                             # NaN imputed
    assert (2.0, 40.0, 0) in rows                               # NULL imputed (median of b)
    assert any(r[2] is None for r in rows)                      # unmatched label -> NULL


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,), (None,)], "x double")
    assert cl.impute_median(df).where("x IS NULL").count() == 3


def test_constant_column(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "c double, v double")
    z = sc.apply_scaler(df, sc.fit_scaler(df, ["c", "v"]))
    assert all(r.c == 0.0 for r in z.collect())
    corr = {(r.col_i, r.col_j): r.corr for r in pf.correlation_matrix(df, ["c", "v"]).collect()}
    assert corr[("c", "v")] is None and corr[("v", "v")] == 1.0


def test_correlation_pairwise_complete(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 7.0), (4.0, 8.5), (None, 1.0), (6.0, 9.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    got = {(r.col_i, r.col_j): r.corr for r in pf.correlation_matrix(df, ["x", "y"]).collect()}
    xs = np.array([1, 3, 4, 6.0])
    ys = np.array([2, 7, 8.5, 9.0])
    assert abs(got[("x", "y")] - round(np.corrcoef(xs, ys)[0, 1], 6)) < 1e-9


def test_box_whiskers_end_on_points(spark):
    # tiny_outliers: ten values, two far out
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 40.0, -30.0]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(vals)], "id string, x double")
    st = pf.box_stats(df, ["x"]).first()
    z = (np.array(vals) - np.mean(vals)) / np.std(vals)
    assert st.n_outliers == 2
    inside = z[(z >= st.lower_fence - 1e-9) & (z <= st.upper_fence + 1e-9)]
    assert abs(st.whisker_low - round(inside.min(), 6)) < 1e-9
    assert abs(st.whisker_high - round(inside.max(), 6)) < 1e-9
    assert pf.box_outliers(df, ["x"]).count() == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], LAB)
    assert cl.clean_table(df).count() == 0
    assert pf.missing_profile(df, ["a", "b"]).where("n_missing > 0").count() == 0
    assert pf.dataset_summary(df.withColumnRenamed("diagnosis", "label")).first().n_rows == 0


def test_standard_scale_moments(spark, sf_small):
    from tabml.sources import bindings as b
    f = b.feat(spark, sf_small)
    z = sc.apply_scaler(f, sc.fit_scaler(f, b.FEATURES)).select(*b.FEATURES).toPandas()
    assert np.allclose(z.mean().values, 0, atol=1e-9)
    assert np.allclose(z.std(ddof=0).values, 1, atol=1e-9)


def test_power_lambda_matches_bruteforce(spark):
    rng = np.random.RandomState(0)
    x = np.round(rng.lognormal(0, 0.7, 400) - 0.5, 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")

    def llf(lam):
        t = np.where(x >= 0,
                     np.log1p(x) if abs(lam) < 1e-12 else ((x + 1) ** lam - 1) / lam,
                     -np.log1p(-x) if abs(lam - 2) < 1e-12 else -((-x + 1) ** (2 - lam) - 1) / (2 - lam))
        return -len(x) / 2 * math.log(t.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    coarse = max(sc.coarse_grid(), key=llf)
    fine = max(sc.fine_grid(coarse), key=llf)
    lam, _, _ = sc.fit_power(df, ["x"])["x"]
    assert abs(lam - fine) < 1e-12


def test_wide_correlation_matches_pandas(spark):
    import pandas as pd
    rng = np.random.RandomState(1)
    data = rng.normal(1000.0, 3.0, size=(300, 12))
    data[rng.rand(300, 12) < 0.1] = np.nan
    data[:, 3] = 5.0                                   # constant column
    pdf = pd.DataFrame(data, columns=[f"c{i}" for i in range(12)])
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in data],
                               ", ".join(f"c{i} double" for i in range(12)))
    cols = list(pdf.columns)
    for wide in (True,):
        got = {(r.col_i, r.col_j): r.corr for r in pf.correlation_matrix(df, cols).collect()}
        ref = pdf.corr()
        for a in cols:
            for b_ in cols:
                want = ref.loc[a, b_]
                if a == "c3" or b_ == "c3":
                    assert got[(a, b_)] is None
                else:
                    assert abs(got[(a, b_)] - want) < 2e-6, (a, b_, wide)


def test_missing_values_of_any_type(spark):
    df = spark.createDataFrame([(1, "a", 1.0, True), (2, None, float("nan"), None), (3, "x", None, False)], "id int, t string, d double, b boolean")
    got = {r.column: r.n_missing for r in pf.missing_profile(df, ["t", "d", "b", "id"]).collect()}
    assert got == {"t": 1, "d": 2, "b": 1, "id": 0}
    assert sorted((r.id, r.column) for r in pf.missing_cells(df, ["t", "d", "b"]).collect()) == [(2, "b"), (2, "d"), (2, "t"), (3, "d")]


def test_nan_is_missing_in_fits(spark):
    df = spark.createDataFrame([(1.0, 2.0), (float("nan"), 3.0), (3.0, None), (5.0, 1.0), (6.0, 7.0)], "a double, b double")
    assert pf.fit_standard(df, ["a"])["a"][0] == 3.75
    got = {(r.col_i, r.col_j): r.corr for r in pf.correlation_matrix(df, ["a", "b"]).collect()}
    want = df.toPandas().corr()
    assert abs(got[("a", "b")] - want.loc["a", "b"]) < 2e-6


def test_power_lambda_beyond_the_first_grid(spark):
    """A left-skewed column whose best lambda lies above 3, and a constant column, which is only centred."""
    from tabml.operators import scale as sc

    xs = [10.0 * (1 - (i / 200) ** 6) for i in range(200)]
    df = spark.createDataFrame([(x, 5.0) for x in xs], "x double, c double")
    fitted = sc.fit_power(df, ["x", "c"])
    lam = fitted["x"][0]
    assert lam > 3.09

    def llf(v):
        import numpy as np
        t = ((np.array(xs) + 1) ** v - 1) / v
        return -len(xs) / 2 * np.log(t.var()) + (v - 1) * np.log1p(xs).sum()

    assert llf(lam) >= max(llf(lam - 0.01), llf(lam + 0.01)) and llf(lam) >= max(llf(lam + k / 4) for k in range(-10, 11))
    assert all(abs(r.c) < 1e-12 for r in sc.apply_power(df, fitted).collect())


def test_power_lambda_to_the_maximum(spark):
    """With ``tol`` the lambda is the likelihood's own maximum, not a grid's, on several columns at once."""
    rng = np.random.RandomState(3)
    cols = {"a": rng.lognormal(0, 0.7, 500) - 0.5, "b": rng.normal(2, 3, 500), "c": -rng.lognormal(1, 0.4, 500),
            "d": np.expm1(rng.normal(1, 0.3, 500))}
    df = spark.createDataFrame([tuple(map(float, r)) + (4.0,) for r in zip(*cols.values())], "a double, b double, c double, d double, k double")
    fitted = sc.fit_power(df, [*cols, "k"], tol=1e-8)
    coarse = sc.fit_power(df, list(cols))
    assert fitted["k"] == (1.0, 4.0, 1.0)

    def transformed(x, lam):
        a, m = np.log1p(np.abs(x)), np.where(x >= 0, lam, 2 - lam)
        return np.where(x >= 0, 1, -1) * np.expm1(m * a) / m

    for c, x in cols.items():
        lam, mean, scale = fitted[c]

        def llf(v, x=x):
            return -len(x) / 2 * math.log(transformed(x, v).var()) + (v - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

        # the vertex of the parabola around it is the lambda itself, and no point of a dense grid is likelier
        h = 1e-3
        low, mid, high = llf(lam - h), llf(lam), llf(lam + h)
        assert abs(h * (low - high) / (2 * (low - 2 * mid + high))) < 1e-5
        assert mid >= max(llf(coarse[c][0] + k * 1e-4) for k in range(-150, 151)) - 1e-9
        assert abs(lam - coarse[c][0]) <= 0.01
        t = transformed(x, lam)
        assert abs(mean - t.mean()) < 1e-9 and abs(scale - t.std()) < 1e-9


def test_power_terms_near_their_series(spark):
    """Lambda 0 above zero and 2 below: transform and derivative agree with differences there."""
    from pyspark.sql import functions as F
    xs, h = (0.0, 0.5, 30.0, -0.5, -30.0), 1e-3
    df = spark.createDataFrame([(x, lam) for x in xs for lam in (0.0, 1e-7, 2.0, 2 - 1e-7, 1.0)], "x double, lam double")
    t, d = sc._power_terms(F.col("x"), F.col("lam"))
    up, down = (sc._power_terms(F.col("x"), F.col("lam") + F.lit(s))[0] for s in (h, -h))
    for r in df.select("x", "lam", t.alias("t"), d.alias("d"), ((up - down) / (2 * h)).alias("diff"),
                       sc._yeo_johnson_lam_col(F.col("x"), F.col("lam")).alias("plain")).collect():
        assert abs(r.d - r["diff"]) <= 2e-5 * max(1, abs(r.d)), r
        assert abs(r.t - r.plain) <= 1e-5 * max(1, abs(r.t)), r
