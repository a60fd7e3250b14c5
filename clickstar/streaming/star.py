"""Messages to the warehouse, batch by batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.geo import GeoTable
from ..operators.lookup import MAX_BROADCAST_BYTES
from ..operators.rows import first_deliveries
from ..plans.enrich import enrich
from ..plans.star import COUNTED_COLUMNS, delivered_views, dimensions
from ..runtime import scratch_path, stored
from ..schema import FACT
from ..sources.keyindex import KeyIndex
from ..sources.messages import accepted_events, parse_messages
from ..sources.rollups import merge_rollups, write_rollup_epoch
from ..sources.runs import EPOCH, FAN_IN, path_exists, remove_path
from ..sources.warehouse import (
    FACT_DATE,
    dims_then_fact,
    fact_index,
    insert_if_absent,
    merge_table,
    read_table,
)
from .dedup import dedup_events

EVERY_30_SECONDS = {"processingTime": "30 seconds"}


def merge_star(
    spark: SparkSession, warehouse: str, epoch: int, index: KeyIndex, fan_in: int = FAN_IN
) -> None:
    """Before an epoch is written: merge what epochs have left, up to the one before the last, which
    the stream might yet run again. Most epochs find nothing to merge."""
    before = epoch - 1

    def merge(table: str) -> None:
        removed = merge_table(spark, warehouse, table, before, fan_in)
        if table == FACT:
            index.forget(spark, removed)

    dims_then_fact(spark, merge)
    merge_rollups(spark, warehouse, before, fan_in)


def write_star(
    batch: DataFrame,
    epoch: int,
    warehouse: str,
    geo: GeoTable,
    brand_prefix: str = "",
    ids_keep_their_date: bool = False,
    index: KeyIndex | None = None,
    fan_in: int = FAN_IN,
) -> None:
    """One batch of accepted events into all eight tables, dimensions before the fact, and the
    hourly counts of what was new.

    The batch is read from the source and enriched once, into the shared folder, of which each table
    reads just its own columns. An error is not caught here: Spark then runs the same epoch again,
    which writes the same rows.
    """
    spark = batch.sparkSession
    index = index or fact_index(warehouse)
    merge_star(spark, warehouse, epoch, index, fan_in)
    stage = scratch_path(spark, "batch")
    try:
        enriched = stored(enrich(batch, geo), f"{stage}/events")
        batch_is = enriched.agg(
            F.count("*").alias("events"),
            F.min("event_date").alias("first"),
            F.max("event_date").alias("last"),
            F.sum(F.octet_length("event_id")).alias("id_bytes"),
        ).first()
        if batch_is["events"] == 0:
            return
        tables = dimensions(enriched, brand_prefix)
        delivered = stored(delivered_views(enriched, COUNTED_COLUMNS), f"{stage}/views")
        tables[FACT] = first_deliveries(delivered, "event_id", "time_stamp", COUNTED_COLUMNS)

        dates = F.col(FACT_DATE).between(F.lit(batch_is["first"]), F.lit(batch_is["last"]))
        own_dates = dates | F.col(FACT_DATE).isNull()

        def write(table: str) -> None:
            if table != FACT:
                insert_if_absent(tables[table], warehouse, table, epoch, batch_is["events"])
                return
            # Ids are as long as their source makes them; the other keys are md5 or numbers.
            bounded = batch_is["id_bytes"] <= MAX_BROADCAST_BYTES
            insert_if_absent(
                tables[FACT],
                warehouse,
                FACT,
                epoch,
                batch_is["events"] if bounded else None,
                own_dates if ids_keep_their_date else None,
                index,
                lambda views: write_rollup_epoch(views, warehouse, epoch),
            )

        dims_then_fact(spark, write)
    finally:
        remove_path(spark, stage)


def start_star_stream(
    messages: DataFrame,
    warehouse: str,
    checkpoint: str,
    geo: GeoTable,
    brand_prefix: str = "",
    trigger: Mapping[str, object] = EVERY_30_SECONDS,
    dedup_delay: str | None = None,
    ids_keep_their_date: bool = False,
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """Start writing a message stream to a warehouse.

    No watermark by default, so no late event is lost: a redelivered one is found in the fact
    itself, by an index of its keys (`keyindex.py`), whatever the history behind it. A source that
    sends an id again only with its own time can say so: with `ids_keep_their_date` a batch reads the
    keys of its own dates instead. With `dedup_delay` repeats within that event time are dropped
    ahead of the write. Folders of `fan_in` epochs are merged as the stream goes on. Epochs restart
    at 0 with a new checkpoint, which must not meet those of an old one.
    """
    spark = messages.sparkSession
    if not path_exists(spark, f"{checkpoint}/metadata"):
        written = read_table(spark, warehouse, FACT).where(F.col(EPOCH) >= 0)
        if not written.isEmpty():
            raise ValueError(f"{warehouse} holds epochs of another checkpoint than {checkpoint}")
    events = accepted_events(parse_messages(messages))
    if dedup_delay is not None:
        events = dedup_events(events, dedup_delay)
    index = fact_index(warehouse)
    return (
        events.writeStream.foreachBatch(
            lambda batch, epoch: write_star(
                batch, epoch, warehouse, geo, brand_prefix, ids_keep_their_date, index, fan_in
            )
        )
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
