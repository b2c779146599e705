"""Cleaning: drop the id, map / invert the label, median imputation, full-row
de-duplication and positional feature selection.

Imputation is a fit / apply pair: the medians are computed exactly by the
distributed selection in ``tabml.functions.quantile`` and applied as literal
``coalesce`` expressions (no join, no cross join), like an MLlib model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabml.functions.exprs import LABEL_CODES, nan_to_null, value_map
from tabml.functions.quantile import fit_quantiles
from tabml.sources.tables import numeric_columns


def drop_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Drop the id column if present (a no-op otherwise)."""
    return df.drop(id_col)


def map_label(df: DataFrame, col: str = "diagnosis", mapping: dict | None = None,
              out: str | None = None) -> DataFrame:
    """Text class -> 0/1; unmatched values -> NULL."""
    return df.withColumn(out or col, value_map(col, mapping or LABEL_CODES))


def invert_label(df: DataFrame, col: str = "label", out: str | None = None) -> DataFrame:
    """0 <-> 1 (other values -> NULL)."""
    return df.withColumn(out or col, value_map(col, {0: 1, 1: 0}))


def fit_medians(df: DataFrame, cols: Sequence[str], method: str = "exact") -> dict:
    """{column: median or None}; NaN counts as missing. ``method='approx'``
    uses one ``percentile_approx`` pass instead of the exact selection."""
    return {c: v[0] for c, v in fit_quantiles(df, cols, [0.5], method).items()}


def apply_medians(df: DataFrame, medians: dict) -> DataFrame:
    """Fill missing values; a column whose median is missing stays missing."""
    return df.withColumns({c: (F.coalesce(nan_to_null(F.col(c)), F.lit(m).cast(df.schema[c].dataType))
                               if m is not None else F.col(c))
                           for c, m in medians.items()})


def impute_median(df: DataFrame, cols: Sequence[str] | None = None,
                  exclude: Sequence[str] = ("id",), method: str = "exact") -> DataFrame:
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    return apply_medians(df, fit_medians(df, cols, method))


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (NULL equals NULL). Map-side partial dedup keeps a
    hot duplicated row from reaching the shuffle more than once per task."""
    return df.dropDuplicates()


def dedup_report(df: DataFrame) -> DataFrame:
    """(n_before, n_after, n_removed) in one plan: group by every column
    (NULLs group together, as in de-duplication), then count the groups and
    sum their sizes."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return (groups.agg(F.sum("__c").cast("bigint").alias("n_before"),
                       F.count(F.lit(1)).alias("n_after"))
                  .withColumn("n_removed", F.col("n_before") - F.col("n_after")))


def clean_table(df: DataFrame, label_col: str = "diagnosis", id_col: str = "id",
                mapping: dict | None = None, out_label: str = "label") -> DataFrame:
    """The load-time cleaning of the reference: drop the id, median-impute the
    numeric columns when anything is missing, map the text label (unmatched ->
    NULL), then drop duplicate rows."""
    df = drop_id(df, id_col)
    nums = numeric_columns(df, [label_col])
    df = impute_median(df, nums)
    df = df.withColumn(out_label, value_map(label_col, mapping or LABEL_CODES))
    if out_label != label_col:
        df = df.drop(label_col)
    return dedup_rows(df)


def feature_select(df: DataFrame) -> DataFrame:
    """All columns but the last (the reference's positional rule: it assumes
    the label is the last column)."""
    return df.select(*df.columns[:-1])
