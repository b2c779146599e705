"""Evaluation operators over the long predictions table
``preds(model, id, split, label, score, prediction)``.

Every operator is one plan over *all* models: per-model figures are
``groupBy('model')`` aggregates (algebraic, so map-side partial aggregation
keeps each task's output at one row per model) or bucketed prefix sums (ROC /
PR), never a per-model driver loop and never a window holding a whole model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabml.functions.exprs import CLASS_NAMES, f1_expr, safe_div
from tabml.functions.rank import DEFAULT_NUMERIC_BUCKETS, bucketed_cumsum, sketch_bucket

R = 6  # decimals kept in derived floating results


def _r(c):
    return F.round(c, R)


def _cnt(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def confusion_counts(preds: DataFrame, split: str = "test") -> DataFrame:
    """(model, n, tp, tn, fp, fn) on one split."""
    p = preds.where(F.col("split") == split) if split else preds
    lab, pr = F.col("label"), F.col("prediction")
    return p.groupBy("model").agg(
        F.count(F.lit(1)).alias("n"),
        _cnt((lab == 1) & (pr == 1)).alias("tp"),
        _cnt((lab == 0) & (pr == 0)).alias("tn"),
        _cnt((lab == 0) & (pr == 1)).alias("fp"),
        _cnt((lab == 1) & (pr == 0)).alias("fn"))


def model_metrics(preds: DataFrame, training_time: dict | None = None) -> DataFrame:
    """One row per model: train/test accuracy, sensitivity, specificity,
    precision (zero-guarded), training_time. A single aggregate over both
    splits."""
    lab, pr, sp = F.col("label"), F.col("prediction"), F.col("split")
    ok = lab == pr
    agg = preds.groupBy("model").agg(
        _cnt(sp == "train").alias("n_train"),
        _cnt((sp == "train") & ok).alias("train_correct"),
        _cnt(sp == "test").alias("n_test"),
        _cnt((sp == "test") & (lab == 1) & (pr == 1)).alias("tp"),
        _cnt((sp == "test") & (lab == 0) & (pr == 0)).alias("tn"),
        _cnt((sp == "test") & (lab == 0) & (pr == 1)).alias("fp"),
        _cnt((sp == "test") & (lab == 1) & (pr == 0)).alias("fn"))
    times = training_time or {}
    tmap = F.create_map(*[x for k, v in times.items() for x in (F.lit(k), F.lit(float(v)))]) \
        if times else None
    out = agg.select(
        "model", "n_train", "n_test",
        _r(safe_div("train_correct", "n_train")).alias("train_accuracy"),
        _r(safe_div(F.col("tp") + F.col("tn"), "n_test")).alias("test_accuracy"),
        _r(safe_div("tp", F.col("tp") + F.col("fn"), zero=0)).alias("sensitivity"),
        _r(safe_div("tn", F.col("tn") + F.col("fp"), zero=0)).alias("specificity"),
        _r(safe_div("tp", F.col("tp") + F.col("fp"), zero=0)).alias("precision"),
        (F.element_at(tmap, F.col("model")) if tmap is not None
         else F.lit(None).cast("double")).alias("training_time"))
    return out


def confusion_matrix(preds: DataFrame, split: str = "test") -> DataFrame:
    """(model, label, prediction, n) with all four cells present (zeros)."""
    p = preds.where(F.col("split") == split)
    cells = p.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    grid = (p.select("model").distinct()
             .withColumn("label", F.explode(F.array(F.lit(0), F.lit(1))))
             .withColumn("prediction", F.explode(F.array(F.lit(0), F.lit(1)))))
    # both sides have at most 4 rows per model
    return (grid.join(cells, on=["model", "label", "prediction"], how="left")
                .select("model", "label", "prediction",
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def confusion_normalized(preds: DataFrame, split: str = "test") -> DataFrame:
    """Row-normalised confusion: share of each true class (NULL for an
    absent class). The window runs over the 4-row-per-model cell table."""
    cm = confusion_matrix(preds, split)
    w = Window.partitionBy("model", "label")
    return cm.withColumn("rate", _r(safe_div("n", F.sum("n").over(w))))


def classification_report(preds: DataFrame, split: str = "test",
                          names=CLASS_NAMES) -> DataFrame:
    """Per-class precision / recall / F1 / support plus 'accuracy',
    'macro avg' and 'weighted avg' rows (zero-division -> 0)."""
    c = confusion_counts(preds, split)
    tp, tn, fp, fn, n = (F.col(x) for x in ("tp", "tn", "fp", "fn", "n"))
    p0, r0 = safe_div(tn, tn + fn, 0), safe_div(tn, tn + fp, 0)
    p1, r1 = safe_div(tp, tp + fp, 0), safe_div(tp, tp + fn, 0)
    s0, s1 = tn + fp, tp + fn
    c = c.select("model", "n", p0.alias("p0"), r0.alias("r0"), p1.alias("p1"), r1.alias("r1"),
                 s0.alias("s0"), s1.alias("s1"), safe_div(tp + tn, n).alias("acc"))
    c = c.withColumn("f0", f1_expr("p0", "r0")).withColumn("f1", f1_expr("p1", "r1"))

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        s.cast("bigint").alias("support"))

    P0, R0, F0, S0 = F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")
    P1, R1, F1, S1 = F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")
    N = F.col("n")
    rows = F.array(
        row(names[0], P0, R0, F0, S0),
        row(names[1], P1, R1, F1, S1),
        row("accuracy", F.lit(None), F.lit(None), F.col("acc"), N),
        row("macro avg", (P0 + P1) / 2, (R0 + R1) / 2, (F0 + F1) / 2, N),
        row("weighted avg", safe_div(P0 * S0 + P1 * S1, N), safe_div(R0 * S0 + R1 * S1, N),
            safe_div(F0 * S0 + F1 * S1, N), N))
    out = c.select("model", F.inline(rows))
    return out.select("model", "class", _r(F.col("precision")).alias("precision"),
                      _r(F.col("recall")).alias("recall"), _r(F.col("f1")).alias("f1"), "support")


def error_analysis(preds: DataFrame, split: str = "test") -> DataFrame:
    """False positives / negatives, totals and zero-guarded rates per model
    (all models; the reference's cap of seven was a plotting limit)."""
    c = confusion_counts(preds, split)
    return c.select(
        "model", F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives"),
        (F.col("fp") + F.col("fn")).alias("total_errors"),
        _r(safe_div("fp", F.col("tn") + F.col("fp"), 0)).alias("fp_rate"),
        _r(safe_div("fn", F.col("fn") + F.col("tp"), 0)).alias("fn_rate"))


# --------------------------------------------------------------------- curves

def _score_points(preds: DataFrame, split: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """One row per (model, distinct score) with pos/neg counts, cumulative tp
    / fp in descending score order, and the model totals P / N; and the table
    of the totals (one row per model). Models without probabilities (NULL
    score) are absent.

    The monotone bucket follows a sketch of each model's distinct scores, so
    scores that crowd near 0 and 1 are spread like any others. P and N come
    from the bucket totals of the prefix sums, so the distinct-score table is
    exchanged once."""
    p = preds.where((F.col("split") == split) & F.col("score").isNotNull())
    pts = p.groupBy("model", "score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"),
        F.sum((1 - F.col("label")).cast("bigint")).alias("neg"))
    pts = sketch_bucket(pts, ["model"], "score", "bucket", buckets)
    cum, totals = bucketed_cumsum(pts, ["model"], "score",
                                  F.col("bucket"), {"tp": F.col("pos"), "fp": F.col("neg")},
                                  descending=True, return_totals=True)
    # one row per model: bounded by the number of models
    tot = totals.groupBy("model").agg(F.sum("tp_total").alias("P"), F.sum("fp_total").alias("N"))
    return cum.join(F.broadcast(tot), on="model"), tot


def roc_points(preds: DataFrame, split: str = "test",
               buckets: int = DEFAULT_NUMERIC_BUCKETS) -> DataFrame:
    return _score_points(preds, split, buckets)[0]


def _roc_select(df: DataFrame) -> DataFrame:
    return df.select("model", F.col("score").alias("threshold"),
                     F.col("tp").cast("bigint").alias("tp"), F.col("fp").cast("bigint").alias("fp"),
                     _r(safe_div("tp", "P")).alias("tpr"), _r(safe_div("fp", "N")).alias("fpr"))


def _origin(tot: DataFrame) -> DataFrame:
    return tot.select("model", F.lit(None).cast("double").alias("threshold"),
                      F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"),
                      F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))


def roc_curve(preds: DataFrame, split: str = "test",
              buckets: int = DEFAULT_NUMERIC_BUCKETS) -> DataFrame:
    """Every distinct score is a threshold: (model, threshold, tp, fp, tpr,
    fpr) plus the origin (threshold NULL)."""
    pts, tot = _score_points(preds, split, buckets)
    return _roc_select(pts).unionByName(_origin(tot))


def roc_curve_pruned(preds: DataFrame, split: str = "test",
                     buckets: int = DEFAULT_NUMERIC_BUCKETS) -> DataFrame:
    """ROC without collinear intermediate points: a point is kept when its
    (pos, neg) increment differs from the next point's, and the first and
    last points are always kept. The 'next point' is found bucket-locally;
    the first row of the next non-empty bucket comes from the small
    per-bucket table."""
    pts, tot = _score_points(preds, split, buckets)
    first = (pts.groupBy("model", "bucket")
                .agg(F.max_by(F.struct("pos", "neg"), F.col("score")).alias("f")))
    wb = Window.partitionBy("model").orderBy(F.col("bucket").desc())
    nxt_bucket = first.select("model", "bucket",
                              F.lead("f").over(wb).alias("nb"))
    wr = Window.partitionBy("model", "bucket").orderBy(F.col("score").desc())
    x = (pts.join(nxt_bucket, on=["model", "bucket"])
            .withColumn("nxt", F.coalesce(F.lead(F.struct("pos", "neg")).over(wr), F.col("nb"))))
    is_first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    is_last = F.col("nxt").isNull()
    changes = (F.col("nxt.pos") != F.col("pos")) | (F.col("nxt.neg") != F.col("neg"))
    kept = x.where(is_first | is_last | changes)
    return _roc_select(kept).unionByName(_origin(tot))


def roc_auc(preds: DataFrame, split: str = "test",
            buckets: int = DEFAULT_NUMERIC_BUCKETS) -> DataFrame:
    """Trapezoidal area under the full ROC curve: sum over distinct scores of
    neg * (tp_before + tp_after) / 2, over P * N. Exact integer numerator."""
    pts = roc_points(preds, split, buckets)
    dec = "decimal(38,0)"
    num = F.col("neg").cast(dec) * (2 * F.col("tp") - F.col("pos")).cast(dec)
    agg = pts.groupBy("model").agg(F.sum(num).alias("num"), F.first("P").alias("n_pos"),
                                   F.first("N").alias("n_neg"))
    den = F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2.0
    return agg.select("model", F.col("n_pos").cast("bigint").alias("n_pos"),
                      F.col("n_neg").cast("bigint").alias("n_neg"),
                      _r(F.try_divide(F.col("num").cast("double"), den)).alias("auc"))


def pr_curve(preds: DataFrame, split: str = "test",
             buckets: int = DEFAULT_NUMERIC_BUCKETS) -> DataFrame:
    """Precision-recall points, one per distinct score, plus the (recall 0,
    precision 1) end point. Recall is 1 when a model saw no positive."""
    pts, tot = _score_points(preds, split, buckets)
    rec = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(safe_div("tp", "P"))
    curve = pts.select("model", F.col("score").alias("threshold"),
                       _r(safe_div("tp", F.col("tp") + F.col("fp"))).alias("precision"),
                       _r(rec).alias("recall"))
    end = tot.select(
        "model", F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)
