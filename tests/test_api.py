"""End-to-end workflow from a CSV file with a header (the original input
format), on rows derived from the driver's lineitem table."""

from pyspark.sql import functions as F

from tabml import api
from tabml.plans.report_all import run_all


def test_workflow_from_csv(spark, sf_small, tmp_path):
    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    src = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
                    F.when(F.col("l_returnflag") == "R", "M").when(F.col("l_returnflag") == "A", "B")
                     .otherwise("X").alias("diagnosis"),
                    "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                    "l_extendedprice")
    path = str(tmp_path / "labelled.csv")
    src.coalesce(1).write.option("header", True).csv(path)

    data = api.load_data(spark, path)
    assert set(data.columns) == {"id", "h", "l_quantity", "l_discount", "l_extendedprice", "label"}
    assert data.where("l_discount IS NULL").count() == 0          # imputed
    prepared = api.prepare_data(data, folds=3)
    n_labelled = data.where("label IS NOT NULL").count()
    assert prepared.count() == n_labelled
    scaled = api.scale_data(prepared, api.feature_columns(data))
    res = api.train_and_evaluate(spark, scaled, preset="check", names=["SGD Classifier"], search=False)
    assert res.metrics.count() == 1 and res.errors.count() == 0
    features = api.feature_columns(data)
    scaler = api.fit_scaler(prepared, features)
    api.save(spark, "SGD Classifier", res.models["SGD Classifier"], scaler, features, str(tmp_path / "m"))
    again = api.load(spark, "SGD Classifier", str(tmp_path / "m"))
    new = prepared.select("id", *features)
    got = sorted((r.id, r.prediction) for r in api.score({"SGD Classifier": again}, new).collect())
    assert got == sorted((r.id, r.prediction) for r in res.preds.collect())   # an id may occur twice
    summary = api.final_summary(res)
    assert summary["ranking"].first().position == 1
    status = run_all(spark, data.select(*api.feature_columns(data), "label"), api.feature_columns(data),
                     res.preds, summary["metrics"],
                     str(tmp_path / "reports"), only=["model_leaderboard", "roc_auc", "box_stats"])
    assert [r.error for r in status.collect()] == [None, None, None]


def test_medians_of_the_training_rows_alone(spark, tmp_path):
    rows = [(f"r{i}", "M" if i % 2 else "B", float(i) if i % 3 else None, float(i)) for i in range(60)]
    path = str(tmp_path / "gaps.csv")
    spark.createDataFrame(rows, "id string, diagnosis string, x double, z double").coalesce(1).write.option("header", True).csv(path)
    data = api.load_data(spark, path, fit_on="train")
    assert data.where("x IS NULL").count() == 20
    split = api.prepare_data(data, folds=3).collect()
    known = sorted(r.x for r in split if r.split == "train" and r.x is not None)
    median = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    gaps = {r.id for r in split if r.x is None}
    filled = api.prepare_data(data, folds=3, fit_on="train").collect()
    assert len(filled) == 60 and {r.x for r in filled if r.id in gaps} == {median}
    assert api.load_data(spark, path).where("x IS NULL").count() == 0


def test_all_report_tables(spark, sf_small, tmp_path):
    from tabml.plans import models as md, train as tr
    from tabml.sources import bindings as b

    data = tr.ml_data(b.folded(spark, sf_small, k=3), b.FEATURES)
    spec = md.spec_by_name(md.preset("check"), "XGBoost")
    curves = tr.learning_curve(spec, data, 3, fractions=[0.5, 1.0])
    model = tr.fit_default(spec, data.where("split = 'train'"))
    importance = tr.tree_importance(model, "XGBoost", b.FEATURES, spark)
    status = run_all(spark, b.feat_raw(spark, sf_small).select("id", *b.FEATURES, "label"), b.FEATURES, b.preds(spark, sf_small), b.metrics(spark, sf_small),
                     str(tmp_path / "all"), curves=curves, importance=importance).collect()
    assert {r.report for r in status if r.error} == set()
    got = {r.report: r.n_rows for r in status}
    assert len(got) == 27 and got["learning_curve"] == 2 and got["overfit_gap"] == 1 and got["importance_topk"] >= 1
    assert got["cv_fold_layout"] == 500 and got["missing_cells"] > 0 and got["correlation_lower"] > 0
