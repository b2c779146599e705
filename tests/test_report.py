from pyspark.sql import functions as F

from tabml.functions.exprs import fmt_fixed, fmt_percent
from tabml.operators import report as rp


def _metrics(spark):
    rows = [("a", 0.9, 0.95, 1.0, 0.8, 0.9, 0.7, 0), ("b", 0.8, 0.85, 2.0, 0.7, 0.8, 0.6, 1),
            ("c", 0.9, 0.91, 0.5, 0.6, 0.9, 0.8, 2), ("d", 0.5, 0.55, 4.0, 0.0, 1.0, 0.0, 3)]
    return spark.createDataFrame(rows, "model string, test_accuracy double, train_accuracy double, "
                                       "training_time double, sensitivity double, specificity double, "
                                       "precision double, model_order int")


def test_leaderboard_and_top3(spark):
    lb = {r.model: (r.rank, r.position) for r in rp.model_leaderboard(_metrics(spark)).collect()}
    assert lb == {"a": (1, 1), "c": (1, 2), "b": (2, 3), "d": (3, 4)}
    top = [r.model for r in rp.top_models(_metrics(spark), 3).orderBy("position").collect()]
    assert top == ["a", "c", "b"]


def test_best_worst_first_in_order(spark):
    r = rp.best_worst_model(_metrics(spark)).first()
    assert r.best_model == "a" and r.worst_model == "d"


def test_radar_efficiency_and_f1(spark):
    rows = {(r.model, r.metric): r.value for r in rp.radar_metrics(_metrics(spark)).collect()}
    eff = {m: acc / (t + 0.1) for m, acc, t in [("a", .9, 1.0), ("b", .8, 2.0), ("c", .9, .5), ("d", .5, 4.0)]}
    top = max(eff.values())
    assert abs(rows[("c", "Efficiency")] - 1.0) < 1e-9
    assert abs(rows[("a", "Efficiency")] - round(eff["a"] / top, 6)) < 1e-9
    assert rows[("d", "F1-Score")] == 0.0


def test_fixed_formatting(spark):
    vals = [0.0, 0.123456, 0.98765, 1.0, 12.3456789, 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [tuple(r) for r in df.select(fmt_fixed("x", 4), fmt_percent("x", 2)).collect()]
    assert got == [(f"{v:.4f}", f"{v:.2%}") for v in vals]


def test_overfit_flag(spark):
    sc = spark.createDataFrame([("m", 0, 10, 1.0, 0.9), ("m", 1, 10, 1.0, 0.92), ("m", 0, 5, 0.9, 0.9)],
                               "model string, fold int, train_size bigint, train_score double, val_score double")
    g = rp.overfit_gap(rp.learning_curve_agg(sc)).first()
    assert g.train_size == 10 and abs(g.gap - 0.09) < 1e-9 and g.overfit


def test_run_all_writes_every_report(spark, sf_small, tmp_path):
    from tabml.plans.report_all import report_tables, run_all
    from tabml.sources import bindings as b
    labelled = b.feat_raw(spark, sf_small).select(*b.FEATURES, "label")
    status = run_all(spark, labelled, b.FEATURES, b.preds(spark, sf_small), b.metrics(spark, sf_small),
                     str(tmp_path / "reports"))
    rows = {r.report: r for r in status.collect()}
    assert set(rows) == set(report_tables(labelled, b.FEATURES, b.preds(spark, sf_small),
                                          b.metrics(spark, sf_small)))
    assert all(r.error is None and r.n_rows >= 1 for r in rows.values())
