"""Feature scaling: standard (population std), robust (median / IQR) and
Yeo-Johnson power transform followed by standardisation.

Each scaler is a fit / apply pair. The fit runs one or two aggregates over the
training rows and returns a small dict (size = number of columns); the apply
is pure column expressions, so it works on any DataFrame, including a
streaming one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabml.functions.quantile import fit_quantiles, unpivot_values
from tabml.operators.profile import apply_standard, fit_standard

SCALERS = ("standard", "robust", "power")


def fit_robust(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict:
    """{column: (median, iqr)}; zero IQR -> 1 (centre only)."""
    q = fit_quantiles(df, cols, [0.25, 0.5, 0.75], method)
    out = {}
    for c in cols:
        q1, med, q3 = q[c]
        iqr = None if q1 is None else q3 - q1
        out[c] = (med, 1.0 if not iqr else iqr)
    return out


def apply_robust(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


# --------------------------------------------------------------- Yeo-Johnson

def yeo_johnson(x, lam: float) -> Column:
    """Yeo-Johnson transform of a column for a fixed lambda."""
    x = F.col(x) if isinstance(x, str) else x
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(-x + 1.0, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def coarse_grid() -> list[float]:
    return [k / 10 for k in range(-30, 31)]


def widened(rows, best: dict) -> dict:
    """Further coarse grids, beyond an end point that is a column's best lambda so far."""
    out = {}
    for c, lam in best.items():
        tried = [r["lam"] for r in rows if r["column"] == c]
        lo, hi = min(tried), max(tried)
        if lam == hi:
            out[c] = [round(hi + k / 10, 1) for k in range(1, 61)]
        elif lam == lo:
            out[c] = [round(lo - k / 10, 1) for k in range(1, 61)]
    return out


def fine_grid(center: float) -> list[float]:
    return [round(center + k / 100, 2) for k in range(-9, 10)]


def _yeo_johnson_lam_col(x: Column, lam: Column) -> Column:
    """Yeo-Johnson with lambda as a column (branches are short-circuit)."""
    pos = F.when(F.abs(lam) < 1e-12, F.log1p(x)).otherwise(
        F.try_divide(F.pow(x + 1.0, lam) - 1.0, lam))
    neg = F.when(F.abs(lam - 2.0) < 1e-12, -F.log1p(-x)).otherwise(
        -F.try_divide(F.pow(-x + 1.0, F.lit(2.0) - lam) - 1.0, F.lit(2.0) - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def _lambda_sums(vc: DataFrame, grids: dict, means: dict) -> list:
    """Per (column, lambda): S0 = sum(c), S1 = sum(c t), S2 = sum(c t^2) of the
    transformed distinct values t = yj(x, lambda) - yj(mean, lambda) (the
    shift keeps the variance from cancelling). The grid is exploded per
    distinct value and reduced by a grouped aggregate; columns x grid rows
    come back."""
    cols = list(grids)
    grid_map = F.create_map(*[x for c in cols for x in (
        F.lit(c), F.array(*[F.lit(float(v)) for v in grids[c]]))])
    mean_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(means[c])))])
    ex = vc.select("column", "value", "__c",
                   F.explode(F.element_at(grid_map, F.col("column"))).alias("lam"))
    lam = F.col("lam")
    t = (_yeo_johnson_lam_col(F.col("value"), lam)
         - _yeo_johnson_lam_col(F.element_at(mean_map, F.col("column")), lam))
    w = F.col("__c").cast("double")
    return ex.groupBy("column", "lam").agg(F.sum(w).alias("s0"), F.sum(w * t).alias("s1"),
                                           F.sum(w * t * t).alias("s2")).collect()


def _argmax(rows, n: dict, s: dict) -> tuple[dict, dict]:
    """Best lambda per column (ties -> smaller lambda) and its sums.
    llf = -n/2 * log(var(t)) + (lambda - 1) * sum(sign(x) log1p(|x|))."""
    best, top = {}, {}
    for r in sorted(rows, key=lambda r: (r["column"], r["lam"])):
        c = r["column"]
        var = r["s2"] / r["s0"] - (r["s1"] / r["s0"]) ** 2
        if not var or var <= 0:
            continue
        llf = -n[c] / 2.0 * math.log(var) + (r["lam"] - 1.0) * s[c]
        if c not in top or llf > top[c]:
            top[c], best[c] = llf, r
    return {c: r["lam"] for c, r in best.items()}, best


def _power_terms(x: Column, lam: Column) -> tuple[Column, Column]:
    """Yeo-Johnson transform t and dt/dlambda. Both come from g(m) = (exp(m a) - 1) / m with
    a = log1p(|x|): m = lambda for x >= 0; m = 2 - lambda, and t = -g, below."""
    a = F.log1p(F.abs(x))
    m = F.when(x >= 0, lam).otherwise(2.0 - lam)
    u = m * a
    near = F.abs(u) < 1e-4   # where the quotients cancel: three terms of their series
    g = F.when(near, a * (1 + u / 2 + u * u / 6)).otherwise(F.try_divide(F.expm1(u), m))
    slope = F.when(near, a * a * (0.5 + u / 3 + u * u / 8)).otherwise(
        F.try_divide(u * F.exp(u) - F.expm1(u), m * m))
    return F.when(x >= 0, g).otherwise(-g), slope


def _lambda_slopes(vc: DataFrame, points: dict, means: dict) -> dict:
    """{column: the sums of c t', c t, c t^2, c t t' and c at that column's lambda}: one aggregate
    for all columns, one row a column back. t and t' are shifted by their values at the mean."""
    at = F.create_map(*[x for c, lam in points.items() for x in (F.lit(c), F.lit(float(lam)))])
    mid = F.create_map(*[x for c in points for x in (F.lit(c), F.lit(float(means[c])))])
    lam, w = F.element_at(at, F.col("column")), F.col("__c").cast("double")
    t, d = _power_terms(F.col("value"), lam)
    t0, d0 = _power_terms(F.element_at(mid, F.col("column")), lam)
    t, d = t - t0, d - d0
    rows = vc.where(F.col("column").isin(list(points))).groupBy("column").agg(
        F.sum(w).alias("s0"), F.sum(w * t).alias("s1"), F.sum(w * t * t).alias("s2"),
        F.sum(w * d).alias("d1"), F.sum(w * t * d).alias("td"))
    return {r["column"]: r for r in rows.collect()}


def refined(vc: DataFrame, start: dict, n: dict, s: dict, means: dict, tol: float,
            half: float = 0.01) -> tuple[dict, dict]:
    """The likelihood's maximum within ``half`` of each column's ``start``, to ``tol``; with its sums.

    The root of the likelihood's derivative by secants kept inside a bracket (the Illinois rule:
    an end that stays has its value halved). All columns advance together, a job a step. A column
    whose derivative has one sign on the bracket keeps its start."""
    def slope(points: dict) -> dict:
        out = {}
        for c, r in _lambda_slopes(vc, points, means).items():
            var = r["s2"] / r["s0"] - (r["s1"] / r["s0"]) ** 2
            cov = r["td"] / r["s0"] - r["s1"] / r["s0"] * r["d1"] / r["s0"]
            out[c] = (-n[c] * cov / var + s[c] if var > 0 else math.nan, r)
        return out

    lo, hi = ({c: v + side * half for c, v in start.items()} for side in (-1, 1))
    mid = slope(start)
    f_lo, f_hi = ({c: v for c, (v, _) in slope(p).items()} for p in (lo, hi))
    lam, sums = dict(start), {c: r for c, (_, r) in mid.items()}
    todo = {c for c in start if f_lo[c] > 0 > f_hi[c]}
    kept = dict.fromkeys(start, 0)
    while todo:
        points = {c: (lo[c] * f_hi[c] - hi[c] * f_lo[c]) / (f_hi[c] - f_lo[c]) for c in todo}
        for c, (f, r) in slope(points).items():
            moved = abs(points[c] - lam[c]) if kept[c] else math.inf
            lam[c], sums[c] = points[c], r
            if f >= 0:
                lo[c], f_lo[c] = points[c], f
                f_hi[c] = f_hi[c] / 2 if kept[c] > 0 else f_hi[c]
            else:
                hi[c], f_hi[c] = points[c], f
                f_lo[c] = f_lo[c] / 2 if kept[c] < 0 else f_lo[c]
            kept[c] = 1 if f >= 0 else -1
            if moved <= tol or hi[c] - lo[c] <= tol or f == 0 or f_lo[c] <= 0 or f_hi[c] >= 0:
                todo.discard(c)
    return lam, sums


def fit_power(df: DataFrame, cols: Sequence[str], tol: float | None = None) -> dict:
    """{column: (lambda, mean_t, scale_t)}: lambda by a coarse grid (step 0.1,
    from [-3, 3] on for as long as its end point is the best) refined on a
    0.01 grid around the best point, and with ``tol`` to the likelihood's
    maximum between the neighbours of that grid, within ``tol``; then the
    population mean / std of the transformed column. A constant column is only
    centred (lambda 1).

    Works on the distinct values of each column with their counts (one
    aggregate, persisted for the two grid passes), so low-cardinality
    columns cost almost nothing; the mean / std come from the fine pass's
    sums at the chosen lambda (no third pass)."""
    cols = list(cols)
    vc = (unpivot_values(df, cols).groupBy("column", "value")
          .agg(F.count(F.lit(1)).alias("__c")).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        mom = {r["column"]: r for r in vc.groupBy("column").agg(
            F.sum("__c").alias("n"),
            (F.sum(F.col("__c") * F.col("value")) / F.sum("__c")).alias("mean"),
            F.sum(F.col("__c") * F.signum("value") * F.log1p(F.abs("value"))).alias("s")).collect()}
        live = [c for c in cols if c in mom]
        n = {c: mom[c]["n"] for c in live}
        s = {c: mom[c]["s"] for c in live}
        means = {c: mom[c]["mean"] for c in live}
        rows = _lambda_sums(vc, {c: coarse_grid() for c in live}, means)
        lam1, _ = _argmax(rows, n, s)
        while more := widened(rows, lam1):   # until every best lambda has neighbours on both sides
            rows += _lambda_sums(vc, more, means)
            before, (lam1, _) = lam1, _argmax(rows, n, s)
            if all(lam1[c] == before[c] for c in more):
                break
        fine = {c: fine_grid(lam1[c]) if c in lam1 else [1.0] for c in live}
        lam2, rows = _argmax(_lambda_sums(vc, fine, means), n, s)
        if tol is not None and lam2:
            lam2, rows = refined(vc, lam2, n, s, means, tol)
    finally:
        vc.unpersist()
    out = {}
    for c in cols:
        if c not in lam2:   # constant, or without values
            out[c] = (1.0, means.get(c, 0.0), 1.0)
            continue
        r = rows[c]
        shift = _yj_scalar(means[c], lam2[c])
        m1 = r["s1"] / r["s0"]
        var = r["s2"] / r["s0"] - m1 * m1
        std = math.sqrt(var) if var > 0 else 0.0
        out[c] = (lam2[c], shift + m1, std if std > 0 else 1.0)
    return out


def _yj_scalar(x: float, lam: float) -> float:
    if x >= 0:
        return math.log1p(x) if abs(lam) < 1e-12 else ((x + 1.0) ** lam - 1.0) / lam
    return -math.log1p(-x) if abs(lam - 2.0) < 1e-12 else -((-x + 1.0) ** (2.0 - lam) - 1.0) / (2.0 - lam)


def apply_power(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (yeo_johnson(c, lam) - F.lit(m)) / F.lit(s)
                           for c, (lam, m, s) in params.items()})


# ------------------------------------------------------------------ dispatch

def fit_scaler(df: DataFrame, cols: Sequence[str], method: str = "standard",
               tol: float | None = None) -> tuple[str, dict]:
    """``tol`` is the power transform's (see fit_power)."""
    if method == "standard":
        return method, fit_standard(df, cols)
    if method == "robust":
        return method, fit_robust(df, cols)
    if method == "power":
        return method, fit_power(df, cols, tol)
    raise ValueError(f"unknown scaling method {method!r}; expected one of {SCALERS}")


def apply_scaler(df: DataFrame, fitted: tuple[str, dict]) -> DataFrame:
    method, params = fitted
    return {"standard": apply_standard, "robust": apply_robust, "power": apply_power}[method](df, params)


def scale_split(df: DataFrame, cols: Sequence[str], method: str = "standard",
                split_col: str = "split") -> DataFrame:
    """Fit on the training rows only, apply to every row. Every fit reads
    the rows once (the multi-pass fits persist their own distinct-value
    tables), so nothing is persisted here."""
    fitted = fit_scaler(df.where(F.col(split_col) == "train").select(*cols), cols, method)
    return apply_scaler(df, fitted)
