"""Profiling tables: shape and class counts, class distribution, missing-value
profile and cells, feature ranges, box-plot statistics and outliers, and the
Pearson correlation matrix.

Wide statistics are one aggregate over all columns (partial aggregation on
the map side, a single row out); long outputs are produced by unpivoting the
one-row result, not the data, except where the output itself is per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.exprs import CLASS_NAMES, class_name, nan_to_null, safe_div
from tabml.functions.quantile import exact_quantiles, unpivot_values

R = 6


def _r(c):
    return F.round(c, R)


def dataset_summary(df: DataFrame, label_col: str = "label",
                    exclude: Sequence[str] = ("id", "h")) -> DataFrame:
    """n_rows, n_columns, n_features, per-class counts and NULL labels."""
    cols = [c for c in df.columns if c not in set(exclude)]
    feats = [c for c in cols if c != label_col]
    lab = F.col(label_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(cols)).alias("n_columns"),
        F.lit(len(feats)).alias("n_features"),
        F.count_if(lab == 0).alias("n_class0"),
        F.count_if(lab == 1).alias("n_class1"),
        F.count_if(lab.isNull()).alias("n_label_null"))


def class_distribution(df: DataFrame, label_col: str = "label", names=CLASS_NAMES) -> DataFrame:
    """value_counts of the label (missing labels dropped) with class names and
    shares. The total is a window over the per-class table (one row per
    class), not over the data."""
    counts = (df.where(F.col(label_col).isNotNull())
                .groupBy(label_col).agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(F.col(label_col).alias("label"),
                         class_name(label_col, names).alias("class_name"),
                         "n", _r(safe_div("n", total)).alias("share"))


def _missing(df: DataFrame, c: str) -> Column:
    """NULL, or NaN in a column of a floating type; columns of any type are fine."""
    null = F.col(c).isNull()
    return null | F.isnan(c) if df.schema[c].dataType.typeName() in ("double", "float") else null


def missing_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n_missing, frac_missing) from one wide aggregate."""
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count_if(_missing(df, c)).alias(f"m{i}")
        for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing"))
                      for i, c in enumerate(cols)])
    return (wide.select("__n", F.inline(stack))
                .select("column", "n_missing", _r(safe_div("n_missing", "__n")).alias("frac_missing")))


def missing_cells(df: DataFrame, cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """The missing cells themselves: (id, column). Output size = number of
    missing cells; rows are unpivoted lazily and filtered in the same stage."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"),
                               _missing(df, c).alias("miss"))
                      for c in cols])
    return (df.select(id_col, F.inline(cells)).where("miss").select(id_col, "column"))


def feature_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, min, max, median) per feature (slider bounds)."""
    q = exact_quantiles(df, cols, [0.5]).select("column", F.col("value").alias("median"))
    mm = (unpivot_values(df, cols).groupBy("column")
          .agg(F.min("value").alias("min"), F.max("value").alias("max")))
    return mm.join(q, on="column", how="left").select(
        "column", "min", "max", _r(F.col("median")).alias("median"))


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict:
    """{column: (mean, scale)} with population std; zero std -> scale 1.
    NaN counts as missing. A fit: one aggregate, d values collected."""
    x = [nan_to_null(F.col(c).cast("double")) for c in cols]
    row = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)],
                 *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(x)]).first()
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m{i}"], row[f"s{i}"]
        out[c] = (m, 1.0 if (s is None or s == 0.0) else s)
    return out


def apply_standard(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def box_stats(df: DataFrame, cols: Sequence[str], whis: float = 1.5) -> DataFrame:
    """Box-plot numbers of z-scored features: quartiles (linear), IQR, fences,
    whiskers at the last data point inside the fences, outlier count."""
    z = apply_standard(df, fit_standard(df, cols))
    q = exact_quantiles(z, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[F.max(F.when(F.col("p_idx") == i, F.col("value"))).alias(n)
          for i, n in enumerate(["q1", "median", "q3"])])
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lower_fence", F.col("q1") - F.lit(whis) * F.col("iqr"))
          .withColumn("upper_fence", F.col("q3") + F.lit(whis) * F.col("iqr")))
    v = unpivot_values(z, cols)
    inside = (F.col("value") >= F.col("lower_fence")) & (F.col("value") <= F.col("upper_fence"))
    # q has one row per column: bounded by the number of features.
    w = (v.join(F.broadcast(q.select("column", "lower_fence", "upper_fence")), on="column")
          .groupBy("column")
          .agg(F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
               F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
               F.count_if(~inside).alias("n_outliers")))
    out = q.join(w, on="column")
    return out.select("column", *[_r(F.col(c)).alias(c) for c in
                                  ("q1", "median", "q3", "iqr", "lower_fence", "upper_fence",
                                   "whisker_low", "whisker_high")], "n_outliers")


def box_outliers(df: DataFrame, cols: Sequence[str], id_col: str = "id",
                 whis: float = 1.5) -> DataFrame:
    """(id, column, z) of every point outside the box-plot fences."""
    z = apply_standard(df, fit_standard(df, cols))
    q = exact_quantiles(z, cols, [0.25, 0.75]).groupBy("column").agg(
        F.max(F.when(F.col("p_idx") == 0, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p_idx") == 1, F.col("value"))).alias("q3"))
    q = q.select("column", (F.col("q1") - F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("lo"),
                 (F.col("q3") + F.lit(whis) * (F.col("q3") - F.col("q1"))).alias("hi"))
    v = unpivot_values(z, cols, [id_col])
    return (v.join(F.broadcast(q), on="column")
             .where((F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi")))
             .select(id_col, "column", _r(F.col("value")).alias("z")))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair over pairwise-complete rows (like
    pandas; NaN is missing), NULL for a constant column (never an ANSI
    division error).

    Each task computes the pairwise-complete moment matrices of its rows with
    numpy (counts, sums, sums of squares and cross products, each restricted
    to rows where both columns are present), and one aggregate sums the
    per-task matrices. Values are centred on the column means first (moments
    are shift-invariant), so the sum-of-products form does not cancel
    catastrophically. The result, d^2 numbers, passes the driver."""
    cols = list(cols)
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = []
    for (i, j), v in _moment_corr(df, cols, pairs).items():
        for a, b in {(i, j), (j, i)}:
            rows.append((cols[a], cols[b], a, b, v))
    long = df.sparkSession.createDataFrame(
        rows, "col_i string, col_j string, i int, j int, corr double")
    return long.select("col_i", "col_j", "i", "j", _r(F.col("corr")).alias("corr"))


def _moment_partials(cols: list, means: list):
    """mapInPandas body: per task, pairwise-complete moment matrices of the
    centred columns with numpy (N = M'M, SX = X'M, SXX = (X*X)'M, SXY = X'X,
    missing values as 0 with mask M), emitted once per task as one vector."""
    import numpy as np
    import pandas as pd

    mu = np.asarray(means, dtype=float)

    def fn(batches):
        acc = None
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float) - mu
            m = (~np.isnan(x)).astype(float)
            x0 = np.where(m > 0, x, 0.0)
            blocks = np.concatenate([(m.T @ m).ravel(), (x0.T @ m).ravel(),
                                     ((x0 * x0).T @ m).ravel(), (x0.T @ x0).ravel()])
            acc = blocks if acc is None else acc + blocks
        if acc is not None:
            yield pd.DataFrame({"v": [acc.tolist()]})
    return fn


def _moment_corr(df: DataFrame, cols: list, pairs: list) -> dict:
    """{(i, j): corr}: numpy moment matrices per task (Arrow batches in,
    4 d^2 numbers out per task), summed by one ``Summarizer`` aggregate."""
    import math

    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    d = len(cols)
    means = df.agg(*[F.avg(nan_to_null(F.col(c).cast("double"))).alias(f"m{i}")
                     for i, c in enumerate(cols)]).first()
    mu = [means[f"m{i}"] if means[f"m{i}"] is not None else 0.0 for i in range(d)]
    src = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    parts = src.mapInPandas(_moment_partials(cols, mu), "v array<double>")
    total = parts.select(array_to_vector("v").alias("v")).agg(Summarizer.sum(F.col("v")).alias("s")).first()
    s = total["s"].toArray() if total["s"] is not None else np.zeros(4 * d * d)
    N, SX, SXX, SXY = (s[k * d * d:(k + 1) * d * d].reshape(d, d) for k in range(4))
    out = {}
    for i, j in pairs:
        n, sx, sy = N[i, j], SX[i, j], SX[j, i]
        vx, vy = n * SXX[i, j] - sx * sx, n * SXX[j, i] - sy * sy
        den = math.sqrt(max(vx, 0.0) * max(vy, 0.0))
        out[(i, j)] = float((n * SXY[i, j] - sx * sy) / den) if n > 0 and den > 0 else None
    return out


def correlation_lower(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict lower triangle of the correlation matrix (the heat-map mask
    hides the diagonal and the upper triangle)."""
    return correlation_matrix(df, cols).where(F.col("i") > F.col("j"))


def segment_importance(df: DataFrame, cols: Sequence[str], segment_col: str,
                       label_col: str = "label") -> DataFrame:
    """(model, feature, importance) with importance = |corr(feature, label)|
    inside each segment: one grouped aggregate (partial aggregation keeps one
    row per segment per task), unpivoted after aggregation."""
    aggs = []
    y = nan_to_null(F.col(label_col).cast("double"))
    for i, c in enumerate(cols):
        x = nan_to_null(F.col(c).cast("double"))
        corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        aggs.append(F.abs(corr).alias(f"i{i}"))
    wide = df.groupBy(F.col(segment_col).alias("model")).agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"i{i}").alias("importance"))
                    for i, c in enumerate(cols)])
    return wide.select("model", F.inline(arr))
