"""Incremental bronze ingest: new JSON-lines files of a raw dataset appended to a table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from sparkplate.sources.schemas import RAW


def ingest_stream(spark: SparkSession, raw_path: str, dataset: str, table: str,
                  checkpoint: str, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start an ``availableNow`` stream: process every file not yet seen, then stop.

    ``checkpoint`` must be a shared folder; it records which files were appended, so a
    restarted job neither loses nor repeats a file.
    """
    stream = (spark.readStream.schema(RAW[dataset])
              .option("maxFilesPerTrigger", max_files_per_trigger).json(raw_path))
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).toTable(table))
