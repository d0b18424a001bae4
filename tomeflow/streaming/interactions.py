"""Incremental ratings and windowed counts of a stream of interactions.

The batch operators recompute; these keep their aggregates as state, bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def windowed_actions(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Actions and their last value by user and window; events later than ``late`` are left out."""
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", width), "user_id")
        .agg(F.count("*").alias("nactions"), F.max_by("value", F.struct("ts", "event_id")).alias("last_value"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"))
        .select(F.col("window.start").alias("day"), "user_id", "nactions", "last_value", "first_time", "last_time")
    )


def distinct_events(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Events without redeliveries within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
