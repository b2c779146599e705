"""What the queries over the split shuffle and hold."""

from pyspark.sql import functions as F

from tabml import catalog
from tabml.functions.exprs import md5_key
from tabml.functions.rank import hash_rank
from tabml.operators.evaluate import model_metrics
from tabml.sources import bindings as b


def lineitem(spark, folder, n=500):
    rows = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 4).cast("int").alias("l_linenumber"), (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") * 7919 % 100000 + 900).cast("double").alias("l_extendedprice"), (F.col("id") % 11 / 100).alias("l_discount"),
        (F.col("id") % 9 / 100).alias("l_tax"), F.lit("N").alias("l_returnflag"))
    rows.write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rank_of_a_key_kept_as_bytes(spark):
    df = spark.range(3000).withColumn("g", F.col("id") % 3).withColumn("h", md5_key("id"))
    text = {r.id: r.rn for r in hash_rank(df, ["g"], "h", digits=3).collect()}
    raw = {r.id: r.rn for r in hash_rank(df.withColumn("h", F.unhex("h")), ["g"], "h", digits=3).collect()}
    assert text == raw


def test_metrics_hold_no_rows_and_shuffle_no_id(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    out = catalog.QUERIES["model_metrics"](spark, d)
    assert "InMemoryRelation" not in plan(out)
    folded = b.folded(spark, d)
    assert sorted(out.collect()) == sorted(model_metrics(b.scorecard_preds(folded), b.training_times()).collect())
    folded.unpersist()
    metrics = b.metrics(spark, d)
    assert metrics.count() == 4 and metrics.storageLevel.useMemory
    metrics.unpersist()


def test_the_split_keeps_its_columns_and_key(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    rows = b.split_rows(spark, d)
    assert rows.where(F.col("h") != md5_key("id", seed=b.SEED)).count() == 0
    assert {"id", "h", "label", "split", "fold", "rn", *b.FEATURES} <= set(rows.columns)


def test_scaled_rows_hold_their_own_columns_alone(spark, tmp_path):
    d = lineitem(spark, tmp_path)
    out = catalog.QUERIES["scale_standard"](spark, d)
    relation = [x for x in plan(out).splitlines() if "InMemoryRelation" in x][0]
    assert "h#" not in relation and "train_offset" not in relation and out.count() == 500
