"""Incremental load of delimited season files with Structured Streaming.

The batch loader replaces a table from a complete file set.  When files
arrive over time (one file per matchday or per club), the same parse and
typed cast run as a file-source stream: each trigger picks up only files not
seen before, and the checkpoint records them, so a restarted job or a lost
executor neither skips nor duplicates a file (the parquet sink commits
exactly once per batch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from touchline.session import scratch_path
from touchline.sources.delimited import Field, typed


def stream_delimited(
    spark: SparkSession,
    in_dir: str,
    fields: Sequence[Field],
    out_path: str,
    checkpoint: str | None = None,
    sep: str = ";",
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start an ``availableNow`` stream loading new files of ``in_dir`` into ``out_path``.

    Returns the running query; ``awaitTermination()`` waits until every file
    present at start has been loaded.  ``checkpoint`` defaults to a fresh
    folder under the session's shared checkpoint folder; pass the same one on
    every run to continue where the previous run stopped.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(fields))])
    reader = (
        spark.readStream.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = typed(reader.csv(in_dir), fields)
    return (
        rows.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
