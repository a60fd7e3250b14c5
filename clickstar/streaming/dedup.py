"""Dedup of a stream by event id, in Spark's state store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_events(events: DataFrame, delay: str) -> DataFrame:
    """Events without repeats of an id whose times lie within `delay` of each other.

    State holds one id per event of the delay only. Events older than the watermark are dropped,
    so this is a choice, never a default, in front of the warehouse. Events without a time pass;
    their repeats are found within a batch only, and by the warehouse.
    """
    return (
        events.withColumn("_event_time", F.timestamp_seconds("time_stamp"))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(["id"])
        .drop("_event_time")
    )
