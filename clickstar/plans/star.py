"""The star schema: seven dimensions and one fact, from enriched events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import hash_key, location_key
from ..functions.time import hour_attributes, hour_key
from ..functions.url import product_name
from ..operators.geo import GeoTable
from ..operators.rows import deliveries, earliest_per_key, first_deliveries, first_per_key
from ..runtime import scratch_path
from ..schema import FACT, WAREHOUSE
from ..sources.rollups import write_rollup_epoch
from ..sources.warehouse import BACKFILL_EPOCH, conform, dims_then_fact, remove_path, write_epoch
from .enrich import enrich


def dim_time(enriched: DataFrame) -> DataFrame:
    """Distinct hours first; the attributes are worked out once per hour, not per event."""
    hours = enriched.where(F.col("hour_start").isNotNull()).select("hour_start").distinct()
    attributes = hour_attributes(F.col("hour_start"))
    return hours.select(*[column.alias(name) for name, column in attributes.items()])


def dim_store(enriched: DataFrame) -> DataFrame:
    """'085' and '85' are one store with two names; the one seen first names it."""
    names = enriched.groupBy("store_id", "store_name").agg(
        F.min("time_stamp").alias("time_stamp")
    )
    first = first_per_key(names, "store_id", ["time_stamp"], ["store_name"])
    return first.select("store_id", "store_name")


def dim_product(enriched: DataFrame, brand_prefix: str = "") -> DataFrame:
    """The earliest event's page names the product, parsed once per product."""
    first = earliest_per_key(enriched, "product_id", ["time_stamp", "event_id"], ["current_url"])
    return first.select(
        "product_id", product_name(F.col("current_url"), brand_prefix).alias("product_name")
    )


def dim_location(enriched: DataFrame) -> DataFrame:
    """Distinct places, then distinct keys: two places may be written the same, and are one."""
    places = enriched.select("city", "region", "country").distinct()
    key = location_key(F.col("city"), F.col("region"), F.col("country"))
    keyed = places.withColumn("location_id", key)
    return first_per_key(keyed, "location_id", ["city", "region", "country"])


def _hashed_dim(enriched: DataFrame, label: str, key: str) -> DataFrame:
    labels = enriched.where(F.col(label).isNotNull()).select(label).distinct()
    return labels.select(hash_key(F.col(label)).alias(key), label)


def dim_referrer_url(enriched: DataFrame) -> DataFrame:
    return _hashed_dim(enriched, "referrer_url", "referrer_url_id")


def dim_browser(enriched: DataFrame) -> DataFrame:
    return _hashed_dim(enriched, "browser", "browser_id")


def dim_os(enriched: DataFrame) -> DataFrame:
    return _hashed_dim(enriched, "os", "os_id")


# How each fact column after the key comes from an enriched event.
_FACT_COLUMNS = {
    "event_type": lambda: F.col("event_type"),
    "time_id": lambda: hour_key(F.col("hour_start")),
    "product_id": lambda: F.col("product_id"),
    "store_id": lambda: F.col("store_id"),
    "location_id": lambda: location_key(F.col("city"), F.col("region"), F.col("country")),
    "referrer_url_id": lambda: hash_key(F.col("referrer_url")),
    "browser_id": lambda: hash_key(F.col("browser")),
    "os_id": lambda: hash_key(F.col("os")),
    # Not stored in the fact table, for reports straight from events.
    "country": lambda: F.col("country"),
    "browser": lambda: F.col("browser"),
    "os": lambda: F.col("os"),
    "referrer_url": lambda: F.col("referrer_url"),
    "event_date": lambda: F.col("event_date"),
    "domain_country": lambda: F.col("domain_country"),
}


def delivered_views(
    enriched: DataFrame, columns: Sequence[str], until: dt.date | None = None
) -> DataFrame:
    """Event ids with the given fact columns, each once, and the least time they came with.

    Redelivered events carry one id. Only the columns asked for cross the shuffle. With `until`,
    only events up to that date: the earliest of an id is among them or is not wanted, so later
    ones need not be shuffled, while those of earlier days must be.
    """
    if until is not None:
        # The raw time as well, which files and formats can be searched by.
        after = dt.datetime.combine(until, dt.time(), dt.timezone.utc) + dt.timedelta(days=1)
        early = F.col("time_stamp") < int(after.timestamp())
        enriched = enriched.where(early & (F.col("event_date") <= F.lit(until)))
    keyed = enriched.select(
        "event_id",
        "time_stamp",
        *[_FACT_COLUMNS[name]().alias(name) for name in columns],
    )
    return deliveries(keyed, "event_id", "time_stamp", columns)


def unique_views(
    enriched: DataFrame, columns: Sequence[str], until: dt.date | None = None
) -> DataFrame:
    """One row per event id, the earliest, with the given fact columns; `until` as above.

    Runs a job: the deliveries are written to the shared folder, and ids that came with different
    rows looked for there.
    """
    spark = enriched.sparkSession
    path = scratch_path(spark, "deliveries")
    delivered = delivered_views(enriched, columns, until)
    delivered.write.parquet(path)
    stored = spark.read.schema(delivered.schema).parquet(path)
    return first_deliveries(stored, "event_id", "time_stamp", columns).drop("time_stamp")


FACT_COLUMNS = WAREHOUSE[FACT].fieldNames()[1:]
#: Fact columns and what rollups have beside them.
COUNTED_COLUMNS = [*FACT_COLUMNS, "domain_country"]


def fact_view_event(enriched: DataFrame) -> DataFrame:
    return unique_views(enriched, FACT_COLUMNS)


def earliest_event_per_product(enriched: DataFrame) -> DataFrame:
    """The fact with at most one row per product: its earliest event."""
    columns = [name for name in WAREHOUSE[FACT].fieldNames()[1:] if name != "product_id"]
    keyed = enriched.select(
        "event_id",
        "time_stamp",
        "product_id",
        *[_FACT_COLUMNS[name]().alias(name) for name in columns],
    )
    first = earliest_per_key(keyed, "product_id", ["time_stamp", "event_id"], columns)
    return first.select(*WAREHOUSE[FACT].fieldNames())


def dimensions(enriched: DataFrame, brand_prefix: str = "") -> dict[str, DataFrame]:
    """The seven dimensions."""
    tables = {
        "dim_time": dim_time(enriched),
        "dim_product": dim_product(enriched, brand_prefix),
        "dim_location": dim_location(enriched),
        "dim_store": dim_store(enriched),
        "dim_referrer_url": dim_referrer_url(enriched),
        "dim_browser": dim_browser(enriched),
        "dim_os": dim_os(enriched),
    }
    return {table: conform(df, table) for table, df in tables.items()}


def star_tables(enriched: DataFrame, brand_prefix: str = "") -> dict[str, DataFrame]:
    """All eight tables, dimensions before the fact."""
    fact = conform(fact_view_event(enriched), FACT)
    return dimensions(enriched, brand_prefix) | {FACT: fact}


def build_warehouse(
    spark: SparkSession,
    events: DataFrame,
    geo: GeoTable,
    warehouse: str,
    stage: str,
    brand_prefix: str = "",
) -> None:
    """Backfill: accepted events to a fresh warehouse and its hourly counts.

    Events are parsed, enriched and located once, into a staged table; each of the eight tables
    then reads just its own columns of that. `stage` is a path all executors share, so a lost
    executor costs its tasks and not the enrichment.
    """
    enrich(events, geo).write.mode("overwrite").parquet(f"{stage}/events")
    enriched = spark.read.parquet(f"{stage}/events")
    tables = dimensions(enriched, brand_prefix)
    delivered = delivered_views(enriched, COUNTED_COLUMNS)
    delivered.write.mode("overwrite").parquet(f"{stage}/views")
    stored = spark.read.schema(delivered.schema).parquet(f"{stage}/views")
    views = first_deliveries(stored, "event_id", "time_stamp", COUNTED_COLUMNS)
    tables[FACT] = views
    dims_then_fact(
        spark, lambda table: write_epoch(tables[table], warehouse, table, BACKFILL_EPOCH)
    )
    write_rollup_epoch(views, warehouse, BACKFILL_EPOCH)
    remove_path(spark, stage)


def star_join(tables: dict[str, DataFrame]) -> DataFrame:
    """Every fact row with the labels its keys stand for.

    Plain left joins: the planner broadcasts the dimensions whose files are small, and AQE splits
    the partitions of the others (products, referrers) where a key, or none, is on many rows. The
    large ones come last, so the small ones widen rows before anything is shuffled.
    """
    joined = tables[FACT].select(*WAREHOUSE[FACT].fieldNames())
    for table, key in [
        ("dim_time", "time_id"),
        ("dim_store", "store_id"),
        ("dim_location", "location_id"),
        ("dim_browser", "browser_id"),
        ("dim_os", "os_id"),
        ("dim_product", "product_id"),
        ("dim_referrer_url", "referrer_url_id"),
    ]:
        labels = [name for name in tables[table].columns if name != key]
        joined = joined.join(tables[table], key, "left").select(*joined.columns, *labels)
    return joined
