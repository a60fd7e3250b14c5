"""Stream and worker health, as jobs over logs and samples.

Message logs have the columns of Spark's Kafka source: topic, partition, offset, timestamp.
Commits have group_id, topic, partition, committed_offset, timestamp. Metric samples have job,
instance, metric, labels (a map), timestamp, sample_id, value. Rates are plain increase over
window length. Times come out as epoch seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_MINUTE = 60
_SERIES = ["job", "instance", "metric", "series_labels"]


def _minute(timestamp: str = "timestamp") -> Column:
    seconds = F.unix_seconds(F.col(timestamp))
    return seconds - F.pmod(seconds, F.lit(_MINUTE))


def messages_per_second(log: DataFrame) -> DataFrame:
    """Messages per second by topic and minute. Also runs on a stream."""
    return (
        log.groupBy("topic", F.window("timestamp", "1 minute"))
        .agg(F.count("*").alias("n"))
        .select(
            "topic",
            F.unix_seconds("window.start").alias("minute_start"),
            (F.col("n") / _MINUTE).alias("per_second"),
        )
    )


def messages_per_minute(log: DataFrame) -> DataFrame:
    """Five-minute average of messages per minute, by topic, every minute.

    On a bounded log messages are counted per minute first, and only the counts enter the five
    windows each; a stream takes one aggregation, so there each message does.
    """
    if log.isStreaming:
        minutes = log.select("topic", "timestamp", F.lit(1).cast("bigint").alias("n"))
    else:
        minutes = (
            log.groupBy("topic", F.timestamp_seconds(_minute()).alias("timestamp"))
            .agg(F.count("*").alias("n"))
        )
    return (
        minutes.groupBy("topic", F.window("timestamp", "5 minutes", "1 minute"))
        .agg(F.sum("n").alias("n"))
        .select(
            "topic",
            F.unix_seconds("window.start").alias("window_start"),
            (F.col("n") / 5).alias("per_minute"),
        )
    )


def consumer_lag(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Messages not yet consumed, by group and topic, on the partitions a group commits to."""
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("log_end"))
    positions = commits.groupBy("group_id", "topic", "partition").agg(
        F.max("committed_offset").alias("committed")
    )
    return (
        positions.join(ends, ["topic", "partition"])
        .groupBy("group_id", "topic")
        .agg(F.sum(F.col("log_end") - F.col("committed")).alias("lag"))
    )


def consume_rate(commits: DataFrame) -> DataFrame:
    """Messages consumed per second, by group, topic and minute.

    A minute has what was committed since the last commit of the minute before, so the minutes
    of a series add up to all that it consumed; the first one counts from its first commit.
    """
    series = ["group_id", "topic", "partition"]
    order = F.struct("timestamp", "committed_offset")
    per_minute = commits.groupBy(*series, _minute().alias("minute_start")).agg(
        F.max_by("committed_offset", order).alias("last"),
        F.min_by("committed_offset", order).alias("first"),
    )
    before = F.lag("last").over(W.partitionBy(*series).orderBy("minute_start"))
    moved = per_minute.withColumn("moved", F.col("last") - F.coalesce(before, "first"))
    return moved.groupBy("group_id", "topic", "minute_start").agg(
        (F.sum("moved") / _MINUTE).alias("per_second")
    )


def partitions_per_topic(log: DataFrame) -> DataFrame:
    return log.groupBy("topic").agg(F.countDistinct("partition").alias("partitions"))


def _with_series(samples: DataFrame) -> DataFrame:
    """Labels as sorted entries: a map's own order is not part of a series' identity."""
    return samples.withColumn("series_labels", F.array_sort(F.map_entries("labels")))


def _grown(value: Column, before: Column) -> Column:
    """Increase of a counter; one that fell was reset and has counted from 0 since."""
    return F.when(before.isNull(), 0).when(value < before, value).otherwise(value - before)


def counter_rate(samples: DataFrame, metric: str) -> DataFrame:
    """Per-second rate of a counter, by job, instance and minute, over all its series.

    Samples are compared within their minute, so a long series is spread over many tasks; then
    each minute's first value with the last one of the minute before, on one row per minute.
    """
    timed = (
        _with_series(samples)
        .where(F.col("metric") == metric)
        .select(*_SERIES, _minute().alias("minute_start"), "timestamp", "sample_id", "value")
    )
    minute = [*_SERIES, "minute_start"]
    before = F.lag("value").over(W.partitionBy(*minute).orderBy("timestamp", "sample_id"))
    order = F.struct("timestamp", "sample_id")
    minutes = (
        timed.withColumn("grown", _grown(F.col("value"), before))
        .groupBy(*minute)
        .agg(
            F.sum("grown").alias("within"),
            F.min_by("value", order).alias("first"),
            F.max_by("value", order).alias("last"),
        )
    )
    last_before = F.lag("last").over(W.partitionBy(*_SERIES).orderBy("minute_start"))
    return (
        minutes.withColumn("grown", F.col("within") + _grown(F.col("first"), last_before))
        .groupBy("job", "instance", "minute_start")
        .agg((F.sum("grown") / _MINUTE).alias("per_second"))
    )


def gauge_sum(samples: DataFrame) -> DataFrame:
    """Sum of each series' latest value, by job, metric and minute."""
    latest = (
        _with_series(samples)
        .groupBy(*_SERIES, _minute().alias("minute_start"))
        .agg(F.max_by("value", F.struct("timestamp", "sample_id")).alias("latest"))
    )
    return latest.groupBy("job", "metric", "minute_start").agg(F.sum("latest").alias("total"))


def usage_alerts(
    samples: DataFrame, used_metric: str, total_metric: str, threshold: float = 0.9
) -> DataFrame:
    """Minutes in which a job used more than a share of what it has; nothing had counts as 0."""
    sums = gauge_sum(samples.where(F.col("metric").isin(used_metric, total_metric)))
    used = F.sum(F.when(F.col("metric") == used_metric, F.col("total")))
    had = F.sum(F.when(F.col("metric") == total_metric, F.col("total")))
    ratio = F.when(F.col("had") != 0, F.col("used") / F.col("had")).otherwise(F.lit(0.0))
    return (
        sums.groupBy("job", "minute_start")
        .agg(used.alias("used"), had.alias("had"))
        .select("job", "minute_start", ratio.alias("usage"))
        .where(F.col("usage") > threshold)
    )


def canary_roundtrip(
    sent: DataFrame, received: DataFrame, within_seconds: int = 10
) -> DataFrame:
    """Whether each heartbeat came back: OK, LATE or MISSING, and after how many seconds.

    `sent` has message_id and sent_sec, `received` message_id and recv_sec. Other messages on the
    topic match no heartbeat. Both sides are first reduced to one row per id.
    """
    first_sent = sent.groupBy("message_id").agg(F.min("sent_sec").alias("sent_sec"))
    first_back = received.groupBy("message_id").agg(F.min("recv_sec").alias("recv_sec"))
    latency = F.col("recv_sec") - F.col("sent_sec")
    status = (
        F.when(latency.isNull(), "MISSING")
        .when(latency <= within_seconds, "OK")
        .otherwise("LATE")
    )
    return first_sent.join(first_back, "message_id", "left").select(
        "message_id", status.alias("status"), latency.alias("latency_sec")
    )
