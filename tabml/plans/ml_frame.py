"""The MLlib boundary: feature vectors, score extraction, long predictions.

A training frame keeps its key (``id``), ``split`` and ``fold`` next to the
``features`` vector, so predictions can be joined, evaluated and folded
without relying on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES_COL = "features"


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES_COL,
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns -> one vector column (NULLs must be imputed first)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def with_double_label(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.withColumn(label_col, F.col(label_col).cast("double"))


def positive_score(df: DataFrame, probability_col: str = "probability") -> Column:
    """P(class 1) from a probability vector; NULL when the model has none."""
    if probability_col in df.columns:
        return vector_to_array(F.col(probability_col))[1]
    return F.lit(None).cast("double")


def to_preds(scored: DataFrame, model_name: str, keep: Sequence[str] = ("id", "split", "label"),
             probability_col: str = "probability", prediction_col: str = "prediction") -> DataFrame:
    """Long prediction rows (model, id, split, label, score, prediction)."""
    return scored.select(F.lit(model_name).alias("model"), *keep,
                         positive_score(scored, probability_col).alias("score"),
                         F.col(prediction_col).cast("int").alias("prediction")) \
        .withColumn("label", F.col("label").cast("int"))


def feature_dim(df: DataFrame, col: str = FEATURES_COL) -> int:
    """Vector size from the ML attribute metadata written by the assembler;
    falls back to one row."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    return len(df.select(col).first()[0])


def feature_names(df: DataFrame, col: str = FEATURES_COL) -> list[str]:
    meta = df.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    attrs = sorted((a for group in meta.values() for a in group), key=lambda a: a["idx"])
    return [a["name"] for a in attrs] or [f"f{i}" for i in range(feature_dim(df, col))]
