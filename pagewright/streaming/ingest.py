"""Structured Streaming over artifacts as they arrive (an extension): elements, and gates kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gate


def stream_elements(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Elements from JSON lines that are added to a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def stream_provenance(elements: DataFrame) -> DataFrame:
    """Provenance issues of a stream of elements; stateless, so each micro-batch stands for itself."""
    return gate.provenance(elements)


def stream_event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums of events (ts, event_type, value) by window and type; what comes later than the watermark is left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
