"""Scoring new rows as a stream.

Everything between the source and the sink is stateless (feature derivation,
the fitted scaler as literal expressions, ``Model.transform``, banding), so
the batch operators run unchanged on a streaming DataFrame. The sink is
Parquet with a checkpoint location, which gives exactly-once files across
restarts; ``availableNow`` processes what is there and stops.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabml.session import work_dir


def start_scoring(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame],
                  out_dir: str | None = None, fmt: str = "parquet", glob: str | None = None,
                  max_files_per_trigger: int | None = None) -> tuple[StreamingQuery, str]:
    """Start a file-source -> transform -> Parquet-sink query over the files
    of folder ``source`` (optionally only those matching ``glob``). Returns
    the query and the output folder (under the shared work folder)."""
    out_dir = out_dir or work_dir(spark, f"streams/{uuid.uuid4().hex}")
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = transform(reader.load(source))
    q = (scored.writeStream.format("parquet")
         .option("path", f"{out_dir}/data")
         .option("checkpointLocation", f"{out_dir}/_checkpoint")
         .outputMode("append")
         .trigger(availableNow=True)
         .start())
    return q, f"{out_dir}/data"


def score_available(spark: SparkSession, source: str, schema,
                    transform: Callable[[DataFrame], DataFrame], glob: str | None = None,
                    timeout_s: int | None = None) -> DataFrame:
    """Run the stream over the files available now and return the sink table.
    Waits for as long as it takes unless a time limit is given."""
    q, path = start_scoring(spark, source, schema, transform, glob=glob)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("streaming score did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(path)
