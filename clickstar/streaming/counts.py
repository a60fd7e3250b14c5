"""Hourly view counts kept current from a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import event_hour, hour_key
from ..plans.enrich import enrich
from ..sources.messages import accepted_events, parse_messages
from ..sources.warehouse import EPOCH


def hourly_counts(messages: DataFrame, by: Sequence[str], delay: str) -> DataFrame:
    """Views per hour and the enriched columns `by`; a redelivered event counts once.

    State is one id per event within `delay`, and one count per open hour and key.
    """
    timed = (
        enrich(accepted_events(parse_messages(messages)))
        .select("event_id", F.timestamp_seconds("time_stamp").alias("event_time"), *by)
        .withWatermark("event_time", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )
    counts = timed.groupBy(F.window("event_time", "1 hour"), *by).agg(
        F.count("*").alias("views")
    )
    hour_start = event_hour(F.unix_seconds("window.start"))
    return counts.select(hour_key(hour_start).alias("time_id"), *by, "views")


def start_hourly_counts(
    messages: DataFrame,
    by: Sequence[str],
    path: str,
    checkpoint: str,
    delay: str,
    trigger: Mapping[str, object],
) -> StreamingQuery:
    """Keep counts current below `path`: each epoch writes the counts it changed."""

    def write(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    return (
        hourly_counts(messages, by, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .start()
    )


def read_hourly_counts(spark: SparkSession, path: str, by: T.StructType) -> DataFrame:
    """The latest count of every hour and key."""
    schema = T.StructType([T.StructField("time_id", T.LongType()), *by.fields])
    stored = schema.add("views", T.LongType()).add(EPOCH, T.LongType())
    return (
        spark.read.schema(stored)
        .parquet(path)
        .groupBy("time_id", *by.fieldNames())
        .agg(F.max_by("views", EPOCH).alias("views"))
    )
