"""Message rates kept current from a stream of log entries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

#: Topic of entries that only tell the time; they close windows when topics fall silent.
HEARTBEAT = "heartbeat"


def start_rates(
    log: DataFrame,
    rate: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    delay: str,
    trigger: Mapping[str, object],
) -> StreamingQuery:
    """Append every window of `rate` (`plans/health.py`) once, when it is closed.

    A window is closed when an entry has come that is `delay` younger than its end. Entries late by
    less than that count in full; later ones are dropped by the watermark. State is one count for
    each open window and topic, pre-counted in each task, so a busy topic is no task of its own.
    """
    return (
        rate(log.withWatermark("timestamp", delay))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
