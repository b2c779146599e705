"""Sources and sinks.

``scan_labelled`` is the labelled-table scan (CSV with header or Parquet) with
an explicit schema: no inference pass, NaN turned into NULL at ingest so every
later aggregate sees SQL missing values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabml.functions.exprs import nan_to_null


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def scan_labelled(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Read a labelled table. CSV needs a header; with ``schema`` no inference
    pass is made. Floating NaN becomes NULL."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("inferSchema", schema is None).csv(path)
    else:
        df = reader.format(fmt).load(path)
    if columns:
        df = df.select(*columns)
    fixed = [nan_to_null(F.col(f.name)).alias(f.name)
             if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
             for f in df.schema.fields]
    return df.select(*fixed)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Schema introspection equivalent of select_dtypes(include=number)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def write_result(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Result sink: the table behind a report, as Parquet."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
