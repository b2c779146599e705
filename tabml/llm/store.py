"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabml.session import work_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{work_dir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a reread of the table, not
    the work that made it. The schema is given, so that an empty table reads too.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
