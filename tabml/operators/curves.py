"""Learning-curve scores for predictors that need no fitting (fixed
scorecards, or already-trained models applied per subset): the training
score of every nested subset of every fold and the validation score of the
fold, computed in one plan without one fit per subset.

Each training row of fold f's training part gets the index of the smallest
subset containing it; per-(model, fold, index) counts are then accumulated
over the (small) size grid.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.operators.split import fold_train_ranks, learning_curve_sizes


def subset_sizes(folded: DataFrame) -> list[int]:
    counts = folded.where(F.col("split") == "train").groupBy("fold").count().collect()  # k rows
    n_train = sum(r["count"] for r in counts)
    n_fold0 = next((r["count"] for r in counts if r["fold"] == 0), 0)
    return learning_curve_sizes(n_train - n_fold0)


def fixed_learning_scores(folded: DataFrame, k: int,
                          predict: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(model, fold, train_size, train_score, val_score). ``predict`` maps a
    frame to long predictions keeping its columns plus (model, prediction)."""
    sizes = subset_sizes(folded)
    size_arr = F.array(*[F.lit(s).cast("bigint") for s in sizes])
    ranks = fold_train_ranks(folded, k).where(F.col("rank_f") <= F.lit(sizes[-1]))
    mask = F.transform(size_arr, lambda s: s >= F.col("rank_f"))
    ranks = ranks.withColumn("first_idx", (F.array_position(mask, F.lit(True)) - 1).cast("int"))
    p = predict(ranks)
    ok = (F.col("label") == F.col("prediction")).cast("bigint")
    per = p.groupBy("model", "cv_fold", "first_idx").agg(
        F.count(F.lit(1)).alias("n"), F.sum(ok).alias("ok"))
    grid = per.select("model", "cv_fold").distinct().withColumn(
        "size_idx", F.explode(F.sequence(F.lit(0), F.lit(len(sizes) - 1))))
    # per has at most models x k x len(sizes) rows
    train = (grid.join(per, on=["model", "cv_fold"])
                 .where(F.col("first_idx") <= F.col("size_idx"))
                 .groupBy("model", "cv_fold", "size_idx")
                 .agg((F.sum("ok") / F.sum("n")).alias("train_score"),
                      F.sum("n").alias("n_rows")))
    val = (predict(folded.where(F.col("split") == "train"))
           .groupBy("model", F.col("fold").alias("cv_fold"))
           .agg(F.avg(ok.cast("double")).alias("val_score")))
    out = train.join(val, on=["model", "cv_fold"])
    return out.select("model", F.col("cv_fold").alias("fold"),
                      F.element_at(size_arr, F.col("size_idx") + 1).alias("train_size"),
                      "train_score", "val_score")
