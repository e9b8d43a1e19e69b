"""Streaming event source: the same JSON events as an unbounded table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_events(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Raw rows ``(event_id, payload, ingested_at, source_file)`` from JSON-line files."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        reader.text(path)
        .filter(F.trim("value") != "")
        .select(
            F.get_json_object("value", "$.event_id").alias("event_id"),
            F.col("value").alias("payload"),
            F.current_timestamp().alias("ingested_at"),
            F.col("_metadata.file_path").alias("source_file"),
        )
    )
