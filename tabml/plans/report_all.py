"""Report driver: every table behind the original application's figures and
summary, computed from a labelled table, a long predictions table and a
per-model metrics table, and written as Parquet (one folder per table).

The inputs are persisted once; each report is an independent plan over
them, so a failing report is recorded and the others still run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabml.functions.exprs import md5_key
from tabml.operators import evaluate as ev
from tabml.operators import profile as pf
from tabml.operators import report as rp
from tabml.operators import split as sp
from tabml.sources.tables import write_result


def report_tables(labelled: DataFrame, features: Sequence[str], preds: DataFrame,
                  metrics: DataFrame, label_col: str = "label", curves: DataFrame | None = None,
                  importance: DataFrame | None = None, id_col: str = "id") -> dict[str, DataFrame]:
    """Name -> DataFrame of every report (lazy). ``curves`` (of
    ``plans.train.learning_curve``) and ``importance`` (of
    ``permutation_importances`` or ``tree_importance``) add the reports on
    them; a table without an id gets one from its rows' content."""
    feats = list(features)
    test = preds.where("split = 'test'")
    keyed = labelled if id_col in labelled.columns else labelled.withColumn(id_col, md5_key(*feats, label_col, seed="row"))
    keyed = keyed.withColumn("h", md5_key(id_col, seed=42))
    more = {}
    if curves is not None:
        agg = rp.learning_curve_agg(curves)
        more |= {"learning_curve": agg, "overfit_gap": rp.overfit_gap(agg)}
    if importance is not None:
        more["importance_topk"] = rp.importance_topk_pivot(importance, k=10, models=sorted(
            r.model for r in importance.select("model").distinct().collect()))  # one row per model
    return more | {
        "cv_fold_layout": sp.cv_fold_layout(keyed.where(F.col(label_col).isNotNull()), label_col=label_col, id_col=id_col),
        "missing_cells": pf.missing_cells(keyed, feats + [label_col], id_col=id_col),
        "correlation_lower": pf.correlation_lower(labelled, feats + [label_col]),
        "model_leaderboard": rp.model_leaderboard(metrics),
        "time_vs_accuracy": rp.time_vs_accuracy(metrics),
        "radar_metrics": rp.radar_metrics(metrics),
        "metric_ranks": rp.metric_ranks(metrics),
        "overall_stats": rp.overall_stats(metrics),
        "best_worst_model": rp.best_worst_model(metrics),
        "top3_models": rp.top_models(metrics, 3),
        "format_metrics": rp.format_metrics(metrics),
        "error_analysis": ev.error_analysis(preds),
        "confusion_matrix": ev.confusion_matrix(preds),
        "confusion_normalized": ev.confusion_normalized(preds),
        "classification_report": ev.classification_report(preds),
        "roc_curve": ev.roc_curve(preds),
        "roc_auc": ev.roc_auc(preds),
        "pr_curve": ev.pr_curve(preds),
        "prediction_table": rp.prediction_table(test),
        "consensus_vote": rp.consensus_vote(test),
        "box_stats": pf.box_stats(labelled, feats),
        "class_distribution": pf.class_distribution(labelled, label_col),
        "correlation_matrix": pf.correlation_matrix(labelled, feats + [label_col]),
        "missing_profile": pf.missing_profile(labelled, feats + [label_col]),
    }


def run_all(spark: SparkSession, labelled: DataFrame, features: Sequence[str], preds: DataFrame,
            metrics: DataFrame, out_dir: str, only: Sequence[str] | None = None,
            curves: DataFrame | None = None, importance: DataFrame | None = None) -> DataFrame:
    """Write every report under ``out_dir``; returns (report, n_rows, error)
    -- one row per report."""
    ins = [x.persist(StorageLevel.MEMORY_AND_DISK) for x in (labelled, preds, metrics)]
    status = []
    try:
        for name, df in report_tables(*ins[:1], features, *ins[1:], curves=curves, importance=importance).items():
            if only and name not in only:
                continue
            path = f"{out_dir.rstrip('/')}/{name}"
            try:
                write_result(df, path)
                status.append((name, spark.read.parquet(path).count(), None))
            except Exception as e:  # noqa: BLE001 -- recorded per report
                status.append((name, None, f"{type(e).__name__}: {e}"))
    finally:
        for x in ins:
            x.unpersist()
    return spark.createDataFrame(status, "report string, n_rows bigint, error string")
