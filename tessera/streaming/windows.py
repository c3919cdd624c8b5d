"""Windowed aggregation of event streams with late data: beyond the tables, on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the Parquet files of a folder, as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def tumbling(events: DataFrame, time: str, width: str, keys: list[str], late: str = "10 minutes", value: str | None = None) -> DataFrame:
    """Counts, and sums of ``value``, by window and keys. In a stream, state older than ``late`` is dropped."""
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(time, late)
    aggs = [F.count(F.lit(1)).alias("n"), *([F.sum(value).alias("total")] if value else [])]
    out = events.groupBy(F.window(time, width).alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", *(["total"] if value else []))


def sliding(events: DataFrame, time: str, width: str, step: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(time, late)
    out = events.groupBy(F.window(time, width, step).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def sessions(events: DataFrame, time: str, gap: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """Sessions: events of a key that are less than ``gap`` apart."""
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(time, late)
    out = events.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
