"""Exact, interpolated quantiles (``quantile_cont`` / numpy 'linear') computed
as a distributed selection instead of one in-memory value map.

Two passes over the data, neither of which shuffles it:

* a mergeable sketch (``percentile_approx``) brackets every target rank of each
  (group, column) by two values, a few parts in 10,000 of the ranks apart;
* a counting pass keeps the distinct values inside the brackets, with counts,
  and one count for each stretch between them. That table is a small share of
  the data, and every target rank lies inside a bracket, so the selection on it
  is exact.

The selection is a running count over the table. Without groups, where one
column's part of it is too long for one task, value windows are refined first
by equal-width buckets; only one row per column and target returns to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.exprs import nan_to_null
from tabml.functions.rank import DEFAULT_NUMERIC_BUCKETS, equal_width_bucket


def unpivot_values(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., column, value) with NaN and NULL dropped. Lazy; meant to be
    aggregated immediately (never materialised d-times wide)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               nan_to_null(F.col(c).cast("double")).alias("value")) for c in cols])
    return (df.select(*group_cols, F.inline(pairs))
              .where(F.col("value").isNotNull()))


MAX_FINAL_BUCKET = 1 << 20   # distinct values ordered inside one window task
#: Parts of the ranks that the sketch tells apart; brackets are 4 parts to either side.
ACCURACY = 10_000


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    group_cols: Sequence[str] = (),
                    buckets: int = DEFAULT_NUMERIC_BUCKETS,
                    max_final: int = MAX_FINAL_BUCKET, accuracy: int = ACCURACY) -> DataFrame:
    """Long result (group..., column, p_idx, p, n, value).

    With groups the result is lazy, of any number of groups: a task orders one
    (group, column)'s bracketed values, about ``9 * len(probs) / accuracy`` of
    its rows. Without, the fit happens here, and one row per column and
    probability comes back; a column of more than ``max_final`` bracketed values
    is narrowed by ``select_quantiles`` first."""
    g = list(group_cols)
    counts = bracketed_counts(df, cols, probs, g, accuracy)
    if g:
        return ordered_quantiles(counts, probs, g)
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if counts.groupBy("column").count().where(F.col("count") > max_final).isEmpty():
            out = ordered_quantiles(counts, probs)
            return df.sparkSession.createDataFrame(out.collect(), out.schema)
        return select_quantiles(counts, probs, buckets, max_final)
    finally:
        counts.unpersist()


def bracketed_counts(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     group_cols: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """(group..., column, value, __cnt): the distinct values in a bracket around each target rank, with
    counts, and each stretch outside of all brackets as its largest value with its count. A (group, column)
    of at most ``accuracy`` values keeps them all."""
    keys = [*group_cols, "column"]
    values = unpivot_values(df, cols, group_cols)
    d = 4.0 / accuracy
    ends = sorted({min(max(p + s * d, 0.0), 1.0) for p in map(float, probs) for s in (-1, 1)})
    at = {e: F.get("__q", F.lit(i)) for i, e in enumerate(ends)}
    sketch = values.groupBy(*keys).agg(F.percentile_approx("value", ends, accuracy).alias("__q"), F.min("value").alias("__min"),
                                       F.max("value").alias("__max"), F.count(F.lit(1)).alias("__n"))
    bounds = []
    for i, p in enumerate(map(float, probs)):
        lo, hi = max(p - d, 0.0), min(p + d, 1.0)
        bounds += [(F.col("__min") if lo == 0.0 else at[lo]).alias(f"__lo{i}"), (F.col("__max") if hi == 1.0 else at[hi]).alias(f"__hi{i}")]
    sketch = sketch.select(*keys, (F.col("__n") <= accuracy).alias("__all"), *bounds)
    # without groups the sketch has one row per column, which proves its size
    placed = values.join(sketch if group_cols else F.broadcast(sketch), on=keys)
    inside, slot = F.col("__all"), F.lit(0)
    for i in range(len(probs)):
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        inside = inside | ((F.col("value") >= lo) & (F.col("value") <= hi))
        slot = slot + (F.col("value") >= lo).cast("int") + (F.col("value") > hi).cast("int")
    return (placed.select(*keys, "value", slot.alias("__slot"), F.when(inside, F.col("value")).alias("__v"))
            .groupBy(*keys, "__slot", "__v").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("__cnt"))
            .select(*keys, "value", "__cnt"))


def ordered_quantiles(counts: DataFrame, probs: Sequence[float], group_cols: Sequence[str] = ()) -> DataFrame:
    """The quantiles by a running count over a (group..., column, value, __cnt) table, one (group, column) a task."""
    keys = [*group_cols, "column"]
    run = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ends = counts.withColumn("__end", F.sum("__cnt").over(run)).withColumn("n", F.sum("__cnt").over(Window.partitionBy(*keys)))
    targets = F.array(*[F.struct(F.lit(i).alias("p_idx"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    each = ends.select(*keys, "n", "value", "__cnt", "__end", F.inline(targets)).withColumn("__pos", F.col("p") * (F.col("n") - 1).cast("double"))

    def holds(rank):
        return (F.col("__end") - F.col("__cnt") <= rank) & (rank < F.col("__end"))

    low, high = F.floor("__pos"), F.ceil("__pos")
    each = each.where(holds(low) | holds(high))
    picked = each.groupBy(*keys, "p_idx", "p", "n", "__pos").agg(F.max(F.when(holds(low), F.col("value"))).alias("__v0"),
                                                                F.max(F.when(holds(high), F.col("value"))).alias("__v1"))
    return picked.select(*keys, "p_idx", "p", F.col("n").cast("long").alias("n"),
                         (F.col("__v0") + (F.col("__v1") - F.col("__v0")) * (F.col("__pos") - F.floor("__pos"))).alias("value"))


def select_quantiles(vc: DataFrame, probs: Sequence[float],
                     buckets: int = DEFAULT_NUMERIC_BUCKETS,
                     max_final: int = MAX_FINAL_BUCKET) -> DataFrame:
    """The refining selection over a (column, value, __cnt) table (persist it:
    every round reads it). Long result as ``exact_quantiles``; what comes to
    the driver is one row per column and target.

    Every target rank k (two per probability) keeps a value window [lo, hi] and
    the number of values below it. Each round bins the values inside the
    windows into equal-width buckets, locates the bucket holding k by prefix
    sums over the small bucket table, and narrows the window to that bucket's
    [min, max]. A window with at most ``max_final`` distinct values is finished
    by one ordered window per target."""
    keys = ["column"]
    spark = vc.sparkSession
    stats_df = vc.groupBy(*keys).agg(F.sum("__cnt").alias("n"), F.min("value").alias("__lo"),
                                     F.max("value").alias("__hi"))
    stats = stats_df.collect()   # one row per column
    key_fields = [vc.schema[c] for c in keys]
    targets, open_, done = [], [], []
    for r in stats:
        kv = tuple(r[c] for c in keys)
        n = r["n"]
        for i, p in enumerate(probs):
            pos = float(p) * float(n - 1)
            k0, k1 = math.floor(pos), math.ceil(pos)
            targets.append((kv, i, float(p), n, pos, k0, k1))
            for k in {k0, k1}:
                open_.append((kv, k, r["__lo"], r["__hi"], 0))
    win_schema = T.StructType(key_fields + [
        T.StructField("__k", T.LongType()), T.StructField("__lo", T.DoubleType()),
        T.StructField("__hi", T.DoubleType()), T.StructField("__before", T.LongType())])

    def windows(rows):
        # one row per target rank: bounded by groups x columns x probabilities
        return F.broadcast(spark.createDataFrame([(*kv, k, lo, hi, b) for kv, k, lo, hi, b in rows],
                                                 win_schema))

    def inside(rows):
        return (vc.join(windows(rows), on=keys)
                  .where((F.col("value") >= F.col("__lo")) & (F.col("value") <= F.col("__hi"))))

    while open_:
        c = inside(open_).withColumn("__bucket", equal_width_bucket("value", "__lo", "__hi", buckets))
        bt = c.groupBy(*keys, "__k", "__before", "__bucket").agg(
            F.sum("__cnt").alias("__bc"), F.count(F.lit(1)).alias("__nd"),
            F.min("value").alias("__bmin"), F.max("value").alias("__bmax"))
        wb = Window.partitionBy(*keys, "__k").orderBy("__bucket").rowsBetween(
            Window.unboundedPreceding, -1)
        bt = bt.withColumn("__pre", F.col("__before") + F.coalesce(F.sum("__bc").over(wb), F.lit(0)))
        hits = bt.where((F.col("__pre") <= F.col("__k"))
                        & (F.col("__k") < F.col("__pre") + F.col("__bc"))).collect()
        open_ = []
        for h in hits:
            row = (tuple(h[c] for c in keys), h["__k"], h["__bmin"], h["__bmax"], h["__pre"])
            if h["__nd"] <= max_final or h["__bmin"] == h["__bmax"]:
                done.append(row)
            else:
                open_.append(row)
    picked = {}
    if done:
        wr = Window.partitionBy(*keys, "__k").orderBy("value").rowsBetween(
            Window.unboundedPreceding, 0)
        fin = (inside(done).withColumn("__end", F.col("__before") + F.sum("__cnt").over(wr))
               .where((F.col("__end") - F.col("__cnt") <= F.col("__k")) & (F.col("__k") < F.col("__end"))))
        for r in fin.select(*keys, "__k", "value").collect():
            picked[(tuple(r[c] for c in keys), r["__k"])] = r["value"]
    out = []
    for kv, i, p, n, pos, k0, k1 in targets:
        v0, v1 = picked[(kv, k0)], picked[(kv, k1)]
        out.append((*kv, i, p, n, v0 + (v1 - v0) * (pos - k0)))
    schema = T.StructType(key_fields + [
        T.StructField("p_idx", T.IntegerType()), T.StructField("p", T.DoubleType()),
        T.StructField("n", T.LongType()), T.StructField("value", T.DoubleType())])
    return spark.createDataFrame(out, schema)


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   names: Sequence[str] | None = None) -> DataFrame:
    """One row per column with one field per probability (names default to
    q<p*100>). Columns without any value are absent (see ``fit_quantiles``)."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    long = exact_quantiles(df, cols, probs)
    return (long.groupBy("column")
                .agg(*[F.max(F.when(F.col("p_idx") == i, F.col("value"))).alias(n)
                       for i, n in enumerate(names)]))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 100_000) -> DataFrame:
    """Opt-in approximation: one pass of ``percentile_approx`` (rank error at
    most n / accuracy), for tables where the exact selection's distinct-value
    table is too expensive. Same long layout as ``exact_quantiles``."""
    pa = F.percentile_approx("value", [float(p) for p in probs], accuracy)
    agg = unpivot_values(df, cols).groupBy("column").agg(pa.alias("__q"), F.count(F.lit(1)).alias("n"))
    plist = F.array(*[F.struct(F.lit(i).alias("p_idx"), F.lit(float(p)).alias("p"))
                      for i, p in enumerate(probs)])
    return agg.select("column", "n", "__q", F.inline(plist)).select(
        "column", "p_idx", "p", "n", F.element_at("__q", F.col("p_idx") + 1).cast("double").alias("value"))


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                  method: str = "exact") -> dict:
    """Driver-side {column: [q...]} -- a *fit*: the collected result has
    len(cols) rows, independent of the data size. All-NULL columns map to
    [None, ...]. ``method='approx'`` trades exactness for one pass."""
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown quantile method {method!r}")
    fn = exact_quantiles if method == "exact" else approx_quantiles
    rows = fn(df, cols, probs).collect()
    out = {c: [None] * len(probs) for c in cols}
    for r in rows:
        out[r["column"]][r["p_idx"]] = r["value"]
    return out
