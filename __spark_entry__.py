
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from clickstar import fixtures as fx  # noqa: E402
from clickstar.functions import agent, keys, net, time, url  # noqa: E402
from clickstar.operators import devices  # noqa: E402
from clickstar.operators.geo import (  # noqa: E402
    MAX_BROADCAST_BYTES,
    geo_table,
    locate,
    views_per_range,
)
from clickstar.operators.geo6 import geo6_table, locate_any  # noqa: E402
from clickstar.operators.rows import with_columns_of  # noqa: E402
from clickstar.plans import audit, health, kpi, star  # noqa: E402
from clickstar.plans.enrich import enrich  # noqa: E402
from clickstar.runtime import scratch_path  # noqa: E402
from clickstar.schema import DIMENSIONS, FACT, WAREHOUSE, key_of  # noqa: E402
from clickstar.sources import messages as msg  # noqa: E402
from clickstar.sources import warehouse as wh  # noqa: E402
from clickstar.sources.ranges import read_geo_ranges  # noqa: E402
from clickstar.sources.rollups import ROLLUPS, read_rollup  # noqa: E402
from clickstar.streaming import counts, dedup, rates  # noqa: E402
from clickstar.streaming.star import start_star_stream  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The operators on training data are a part of their own, which may be absent.
try:
    import corpus_pipeline  # noqa: E402, F401
    from clickstar.llm import queries as llm_queries  # noqa: E402
except ImportError:
    llm_queries = None

_ALL_NOW = {"availableNow": True}
_DEVICES = T.StructType().add("browser", "string").add("os", "string")
_PRODUCT = T.StructType().add("product_id", "integer")


# Inputs ------------------------------------------------------------------------------------


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.accepted_events(fx.raw_events(spark, sf_dir))


def _geo(spark: SparkSession, sf_dir: str):
    return geo_table(fx.geo_ranges(spark, sf_dir))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_accepted(spark, sf_dir))


def _enriched_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_accepted(spark, sf_dir), _geo(spark, sf_dir))


def _message_files(spark: SparkSession, sf_dir: str) -> str:
    """The messages as text files in the shared folder, for a file stream."""
    path = scratch_path(spark, "messages")
    fx.raw_messages(spark, sf_dir).write.text(path)
    return path


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return msg.read_message_stream(spark, "text", path=_message_files(spark, sf_dir))


def _views(*columns: str) -> Query:
    """Deduplicated events with the columns a report needs, and no others."""
    until = fx.AS_OF if "event_date" in columns else None
    return lambda spark, sf_dir: star.unique_views(_enriched(spark, sf_dir), columns, until)


def _stored_star(spark: SparkSession, sf_dir: str) -> str:
    """A backfilled warehouse in the shared folder."""
    path = scratch_path(spark, "warehouse")
    star.build_warehouse(
        spark,
        _accepted(spark, sf_dir),
        _geo(spark, sf_dir),
        path,
        scratch_path(spark, "stage"),
        fx.BRAND_PREFIX,
    )
    return path


def _streamed_star(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse written by the stream."""
    path = scratch_path(spark, "warehouse")
    start_star_stream(
        _message_stream(spark, sf_dir),
        path,
        scratch_path(spark, "checkpoint"),
        _geo(spark, sf_dir),
        fx.BRAND_PREFIX,
        trigger=_ALL_NOW,
    ).awaitTermination()
    return path


def _many_epochs(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse written by the stream in five epochs, the last of which bring what has been before,
    and merged on the way by twos. Heartbeats come between the events. An epoch has more files with
    more events, so no task holds an epoch."""
    files = scratch_path(spark, "messages")
    an_epoch = fx.message_files(spark, sf_dir)
    fx.dealt_messages(spark, sf_dir, 4 * an_epoch).write.text(files)
    fx.dealt_messages(spark, sf_dir, an_epoch).write.mode("append").text(files)
    path = scratch_path(spark, "warehouse")
    start_star_stream(
        msg.read_message_stream(spark, "text", {"maxFilesPerTrigger": str(an_epoch)}, files),
        path,
        scratch_path(spark, "checkpoint"),
        _geo(spark, sf_dir),
        fx.BRAND_PREFIX,
        trigger=_ALL_NOW,
        fan_in=2,
    ).awaitTermination()
    return path


# Queries that take more than one step -------------------------------------------------------


def _per_event(**columns: Callable[[], Column]) -> Query:
    """Event id and columns; those are made when a session is there to make them."""
    return lambda spark, sf_dir: fx.raw_events(spark, sf_dir).select(
        F.col("id").alias("event_id"), *[make().alias(name) for name, make in columns.items()]
    )


def _event_columns(events: DataFrame, like: DataFrame) -> DataFrame:
    return events.select(*like.columns)


def _parse_events(spark, sf_dir):
    parsed = msg.parse_messages(fx.raw_messages(spark, sf_dir))
    return _event_columns(parsed, fx.raw_events(spark, sf_dir))


def _src_stream_json(spark, sf_dir):
    out = scratch_path(spark, "parsed")
    parsed = msg.parse_messages(_message_stream(spark, sf_dir))
    writer = _event_columns(parsed, fx.raw_events(spark, sf_dir)).writeStream
    writer.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "checkpoint")
    ).trigger(**_ALL_NOW).start(out).awaitTermination()
    return spark.read.parquet(out)


def _relay_stream(spark, sf_dir):
    out = scratch_path(spark, "relayed")
    msg.relay(
        _message_stream(spark, sf_dir), "text", scratch_path(spark, "checkpoint"), path=out
    ).trigger(**_ALL_NOW).start().awaitTermination()
    relayed = msg.parse_messages(msg.read_messages(spark, "text", path=out))
    return _event_columns(relayed, fx.raw_events(spark, sf_dir))


def _stream_star_fact(spark, sf_dir):
    return wh.read_warehouse(spark, _streamed_star(spark, sf_dir))[FACT].drop(wh.FACT_DATE)


def _stream_star_merged(spark, sf_dir):
    return wh.read_warehouse(spark, _many_epochs(spark, sf_dir))[FACT].drop(wh.FACT_DATE)


def _stream_rollups(spark, sf_dir):
    """Every rollup after many epochs, its counts added up."""
    path = _many_epochs(spark, sf_dir)
    rows = []
    for name, columns in ROLLUPS.items():
        label = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        rows.append(
            read_rollup(spark, path, name)
            .groupBy(F.lit(name).alias("rollup"), "time_id", F.concat_ws("/", *label).alias("keys"))
            .agg(F.sum("views").alias("views"))
        )
    return reduce(DataFrame.unionByName, rows)


def _stream_star_dims(spark, sf_dir):
    tables = wh.read_warehouse(spark, _streamed_star(spark, sf_dir))
    labels = {
        "dim_time": F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        "dim_product": F.col("product_name"),
        "dim_location": F.concat_ws("/", "country", "region", "city"),
        "dim_store": F.col("store_name"),
        "dim_referrer_url": F.col("referrer_url"),
        "dim_browser": F.col("browser"),
        "dim_os": F.col("os"),
    }
    rows = [
        tables[dim].select(
            F.lit(dim).alias("table_name"),
            F.col(key_of(dim)).cast("string").alias("key"),
            labels[dim].alias("label"),
        )
        for dim in DIMENSIONS
    ]
    return reduce(DataFrame.unionByName, rows)


def _stream_resume(spark, sf_dir):
    """Stop after a first delivery, resume on the same checkpoint with a second one that
    repeats it all: repeated ids add nothing."""
    files = scratch_path(spark, "messages")
    warehouse = scratch_path(spark, "warehouse")
    checkpoint = scratch_path(spark, "checkpoint")
    geo = _geo(spark, sf_dir)
    for _delivery in range(2):
        fx.raw_messages(spark, sf_dir).write.mode("append").text(files)
        start_star_stream(
            msg.read_message_stream(spark, "text", path=files),
            warehouse,
            checkpoint,
            geo,
            fx.BRAND_PREFIX,
            trigger=_ALL_NOW,
        ).awaitTermination()
    return wh.read_warehouse(spark, warehouse)[FACT].drop(wh.FACT_DATE)


def _stream_dedup_events(spark, sf_dir):
    out = scratch_path(spark, "unique")
    events = msg.accepted_events(msg.parse_messages(_message_stream(spark, sf_dir)))
    dedup.dedup_events(events, "40 days").writeStream.format("parquet").option(
        "checkpointLocation", scratch_path(spark, "checkpoint")
    ).trigger(**_ALL_NOW).start(out).awaitTermination()
    return spark.read.parquet(out).select(
        F.col("id").alias("event_id"),
        F.col("collection").alias("event_type"),
        time.hour_key(time.event_hour(F.col("time_stamp"))).alias("time_id"),
    )


def _stream_counts(by: T.StructType) -> Query:
    def run(spark, sf_dir):
        out = scratch_path(spark, "counts")
        counts.start_hourly_counts(
            _message_stream(spark, sf_dir),
            by.fieldNames(),
            out,
            scratch_path(spark, "checkpoint"),
            delay="40 days",
            trigger=_ALL_NOW,
        ).awaitTermination()
        return counts.read_hourly_counts(spark, out, by)

    return run


def _stream_rates(rate) -> Query:
    """A log that comes in three parts, one entry in ten a part late, and a heartbeat at its end."""

    def run(spark, sf_dir):
        files, out = scratch_path(spark, "log"), scratch_path(spark, "rates")
        checkpoint = scratch_path(spark, "checkpoint")
        log = fx.message_log(spark, sf_dir).select("topic", "timestamp", "offset")
        since = F.unix_seconds("timestamp") - fx.LOG_START
        part = F.least(F.floor(since / 1200), F.lit(2)) + F.when(F.col("offset") % 10 == 9, 1).otherwise(0)
        parts = log.withColumn("part", F.least(part, F.lit(2)))
        beat = spark.range(1).select(
            F.lit(rates.HEARTBEAT).alias("topic"),
            F.timestamp_seconds(F.lit(fx.LOG_START + 1_000_000)).alias("timestamp"),
        )
        for number in range(4):
            arrived = parts.where(F.col("part") == number).drop("part", "offset") if number < 3 else beat
            arrived.write.mode("append").parquet(files)
            stream = spark.readStream.schema("topic string, timestamp timestamp").parquet(files)
            rates.start_rates(
                stream, rate, out, checkpoint, "45 minutes", _ALL_NOW
            ).awaitTermination()
        return spark.read.parquet(out).where(F.col("topic") != rates.HEARTBEAT)

    return run


def _sink_insert_if_absent(spark, sf_dir):
    """The same stores in three epochs, one of them run twice: each is kept once."""
    warehouse = scratch_path(spark, "warehouse")
    stores = star.dim_store(_enriched(spark, sf_dir))
    for epoch in (0, 1, 1, 2):
        wh.insert_if_absent(stores, warehouse, "dim_store", epoch)
    return wh.read_table(spark, warehouse, "dim_store").drop(wh.EPOCH)


def _warehouse_schema(spark, sf_dir):
    tables = wh.read_warehouse(spark, _stored_star(spark, sf_dir))
    rows = []
    for name, schema in WAREHOUSE.items():
        stored = tables[name].select(*schema.fieldNames())
        columns = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in stored.schema)
        rows.append(
            stored.agg(F.count("*").alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "n_rows"
            )
        )
    return reduce(DataFrame.unionByName, rows)


def _geo_ranges(spark, sf_dir):
    """The range table read from CSV files, with the views each range gets."""
    path = scratch_path(spark, "ranges")
    fx.geo_ranges(spark, sf_dir).write.option("header", True).csv(path)
    ranges = read_geo_ranges(spark, path, "csv", {"header": "true"})
    return views_per_range(_accepted(spark, sf_dir), ranges)


def _split_recommendation(spark, sf_dir):
    return fx.raw_events(spark, sf_dir).select(
        "id", keys.is_recommendation(F.col("collection")).alias("is_recommendation")
    )


def _harmonize_columns(spark, sf_dir):
    """One source lacks the viewed product, both lack the email; the union has all."""
    events = fx.raw_events(spark, sf_dir)
    wanted = T.StructType().add("id", "string").add("product_id", "string")
    wanted = wanted.add("viewing_product_id", "string").add("email", "string")
    with_viewed = F.col("viewing_product_id").isNotNull()
    viewed = events.where(with_viewed).select("id", "product_id", "viewing_product_id")
    others = events.where(~with_viewed).select("id", "product_id")
    whole = [with_columns_of(part, wanted).select(*wanted.fieldNames()) for part in (viewed, others)]
    return whole[0].unionByName(whole[1])


def _cast_ids(spark, sf_dir):
    return fx.raw_events(spark, sf_dir).select(
        "id",
        keys.int_id(F.col("product_id")).alias("product_id"),
        keys.int_id(F.col("store_id")).alias("store_id"),
    )


def _union_branches(spark, sf_dir):
    """Recommendations and other events apart, then as one, as the single pass gives them."""
    events = _accepted(spark, sf_dir)
    recommended = keys.is_recommendation(F.col("collection"))
    ids = [F.col("id").alias("event_id"), F.col("collection").alias("event_type")]
    viewed = F.coalesce("viewing_product_id", "product_id")
    own = events.where(~recommended).select(
        *ids, keys.int_id(F.col("product_id")).alias("product_id")
    )
    shown = events.where(recommended).select(*ids, keys.int_id(viewed).alias("product_id"))
    return shown.unionByName(own)


def _time_parts(spark, sf_dir):
    hour_start = time.event_hour(F.col("time_stamp"))
    parts = time.hour_attributes(F.col("hour_start"))
    return (
        _accepted(spark, sf_dir)
        .select("id", hour_start.alias("hour_start"))
        .select(F.col("id").alias("event_id"), *[c.alias(name) for name, c in parts.items()])
    )


def _hash_keys(spark, sf_dir):
    return _enriched_with_place(spark, sf_dir).select(
        "event_id",
        keys.location_key(F.col("city"), F.col("region"), F.col("country")).alias("location_id"),
        keys.hash_key(F.col("referrer_url")).alias("referrer_url_id"),
        keys.hash_key(F.col("browser")).alias("browser_id"),
        keys.hash_key(F.col("os")).alias("os_id"),
    )


def _device_families(spark, sf_dir):
    """Rules kept as a table, run on the distinct agents, which are stored."""
    kept = scratch_path(spark, "rules")
    devices.rule_table(spark, devices.BROWSERS).write.parquet(f"{kept}/browsers")
    devices.rule_table(spark, devices.SYSTEMS).write.parquet(f"{kept}/systems")
    rules = [
        devices.read_agent_rules(spark.read.parquet(f"{kept}/{name}")) for name in ("browsers", "systems")
    ]
    events = fx.versioned_agents(spark, sf_dir)
    devices.device_table(events, *rules).write.parquet(f"{kept}/devices")
    told = devices.with_devices(events, spark.read.parquet(f"{kept}/devices"))
    return told.drop("user_agent")


def _ip_geolocate(spark, sf_dir):
    located = locate(_accepted(spark, sf_dir), _geo(spark, sf_dir))
    return located.select(F.col("id").alias("event_id"), "ip", "country", "region", "city")


def _locate_any(max_broadcast_bytes: int) -> Query:
    def run(spark, sf_dir):
        four = geo_table(fx.geo_ranges(spark, sf_dir), max_broadcast_bytes)
        six = geo6_table(fx.geo6_ranges(spark, sf_dir), max_broadcast_bytes)
        return locate_any(fx.mixed_addresses(spark, sf_dir), four, six)

    return run


def _domain_suffixes(spark, sf_dir):
    country = url.domain_country(F.col("url"))
    named = fx.shop_hosts(spark, sf_dir).select("event_id", "url", country.alias("domain_country"))
    return named.withColumn("country", url.country_name(F.col("domain_country")))


def _star_join(spark, sf_dir):
    return star.star_join(wh.read_warehouse(spark, _stored_star(spark, sf_dir)))


def _audit_star(spark, sf_dir):
    return audit.audit_warehouse(spark, _stored_star(spark, sf_dir))


def _top_ip_countries(spark, sf_dir):
    enriched = _enriched_with_place(spark, sf_dir)
    views = star.unique_views(enriched, ["event_date", "country"], fx.AS_OF)
    return kpi.top_labels(views, "country", fx.AS_OF)


def _top_referrers(spark, sf_dir):
    columns = ["event_date", "referrer_url_id", "referrer_url"]
    views = star.unique_views(_enriched(spark, sf_dir), columns, fx.AS_OF)
    return kpi.top_labels(views, "referrer_url", fx.AS_OF, 5, by="referrer_url_id")


def _stores_by_country(spark, sf_dir):
    """Stores viewed from the country that most views come from."""
    views = star.unique_views(_enriched_with_place(spark, sf_dir), ["country", "store_id"])
    return kpi.stores_of_top_country(views)


def _hourly_devices(spark, sf_dir):
    columns = ["event_date", "time_id", "browser", "os"]
    return kpi.hourly_devices(_views(*columns)(spark, sf_dir), fx.AS_OF)


def _most_viewed_product(views: DataFrame) -> int | None:
    top = kpi.top_products(views, fx.AS_OF, 1).first()
    return top["product_id"] if top else None


def _product_hourly(spark, sf_dir):
    """The day's most viewed product, hour by hour."""
    views = _views("event_date", "time_id", "product_id")(spark, sf_dir)
    return kpi.product_hourly(views, _most_viewed_product(views), fx.AS_OF)


def _stored(report) -> Query:
    """A report on a stored warehouse, as a dashboard runs it."""

    def run(spark, sf_dir):
        stored = wh.read_warehouse(spark, _stored_star(spark, sf_dir))
        return report(stored)

    return run


def _rolled(report) -> Query:
    """A report on the hourly counts of a stored warehouse."""

    def run(spark, sf_dir):
        path = _stored_star(spark, sf_dir)
        dims = {table: wh.read_table(spark, path, table) for table in DIMENSIONS}
        return report(lambda name: read_rollup(spark, path, name), dims)

    return run


def _rolled_stores_by_country(rollup, dims):
    views, places = rollup("place_store"), dims["dim_location"]
    return kpi.stores_by_ip_country(views, places, kpi.most_viewed_country(views, places))


def _rolled_product_hourly(rollup, dims):
    views = rollup("product")
    return kpi.product_hourly(views, _most_viewed_product(views), fx.AS_OF)


def _stored_stores_by_country(stored):
    views, places = stored[FACT], stored["dim_location"]
    return kpi.stores_by_ip_country(views, places, kpi.most_viewed_country(views, places))


def _geolocate_large(spark, sf_dir):
    """By the plan for range tables that are too large to broadcast."""
    large = geo_table(fx.geo_ranges(spark, sf_dir), max_broadcast_bytes=0)
    located = locate(_accepted(spark, sf_dir), large)
    return located.select(F.col("id").alias("event_id"), "ip", "country", "region", "city")


def _kpi(report, columns: list[str], *parameters) -> Query:
    return lambda spark, sf_dir: report(_views(*columns)(spark, sf_dir), *parameters)


# The contract --------------------------------------------------------------------------------


def _in_utc(query: Query) -> Query:
    """Spark shows timestamps in the session's zone; the SQL they are compared with in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the day's most viewed products, from raw events."""
    return queries()["kpi_top_products"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """Every operator: takes (spark, sf_dir) and gives a DataFrame."""
    registered: dict[str, Query] = {
        # Sources and sinks
        "src_stream_json": _src_stream_json,
        "parse_events": _parse_events,
        "intake_counts": lambda s, d: msg.intake_counts(
            fx.topic_messages(s, d), canaries_apart=True
        ),
        "canary_messages": lambda s, d: msg.canary_messages(fx.topic_messages(s, d)),
        "relay_stream": _relay_stream,
        "stream_star_fact": _stream_star_fact,
        "stream_star_dims": _stream_star_dims,
        "stream_star_merged": _stream_star_merged,
        "stream_rollups": _stream_rollups,
        "stream_resume": _stream_resume,
        "stream_dedup_events": _stream_dedup_events,
        "stream_hourly_counts": _stream_counts(_DEVICES),
        "stream_product_counts": _stream_counts(_PRODUCT),
        "sink_insert_if_absent": _sink_insert_if_absent,
        "warehouse_schema": _warehouse_schema,
        "geo_ranges": _geo_ranges,
        # Projections and predicates
        "filter_allowed": lambda s, d: msg.allowed_events(fx.raw_events(s, d)).select(
            "id", "collection"
        ),
        "split_recommendation": _split_recommendation,
        "harmonize_columns": _harmonize_columns,
        "cast_ids": _cast_ids,
        "effective_product_id": _per_event(
            product_id=lambda: keys.effective_product_id(
                F.col("collection"), F.col("product_id"), F.col("viewing_product_id")
            )
        ),
        "union_branches": _union_branches,
        # Scalars
        "time_parts": _time_parts,
        "hash_keys": _hash_keys,
        "product_name": _per_event(
            product_name=lambda: url.product_name(F.col("current_url"), fx.BRAND_PREFIX)
        ),
        "browser_family": _per_event(browser=lambda: agent.browser_family(F.col("user_agent"))),
        "os_family": _per_event(os=lambda: agent.os_family(F.col("user_agent"))),
        "device_families": _device_families,
        "ip_geolocate": _ip_geolocate,
        "ip_geolocate_large": _geolocate_large,
        "ip_geolocate_any": _locate_any(MAX_BROADCAST_BYTES),
        "ip_geolocate_any_large": _locate_any(0),
        "domain_suffixes": _domain_suffixes,
        "ip_to_long": _per_event(
            ip=lambda: F.col("ip"), ip_number=lambda: net.ip_to_long(F.col("ip"))
        ),
        "domain_country": _per_event(
            domain_label=lambda: url.domain_label(F.col("current_url")),
            domain_country=lambda: url.domain_country(F.col("current_url")),
        ),
        "domain_country_name": _per_event(
            country=lambda: url.country_name(url.domain_country(F.col("current_url")))
        ),
        # Star schema
        "dim_time": lambda s, d: star.dim_time(_enriched(s, d)),
        "dim_product": lambda s, d: star.dim_product(_enriched(s, d), fx.BRAND_PREFIX),
        "dim_location": lambda s, d: star.dim_location(_enriched_with_place(s, d)),
        "dim_store": lambda s, d: star.dim_store(_enriched(s, d)),
        "dim_referrer_url": lambda s, d: star.dim_referrer_url(_enriched(s, d)),
        "dim_browser": lambda s, d: star.dim_browser(_enriched(s, d)),
        "dim_os": lambda s, d: star.dim_os(_enriched(s, d)),
        "fact_view_event": lambda s, d: star.fact_view_event(_enriched_with_place(s, d)),
        "earliest_event_per_product": lambda s, d: star.earliest_event_per_product(
            _enriched_with_place(s, d)
        ),
        "star_join": _star_join,
        "audit_star": _audit_star,
        # KPIs
        "kpi_top_products": _kpi(kpi.top_products, ["event_date", "product_id"], fx.AS_OF),
        "kpi_top_countries_domain": _kpi(
            kpi.top_domain_countries, ["event_date", "domain_country"], fx.AS_OF
        ),
        "kpi_top_countries_ip": _top_ip_countries,
        "kpi_top_referrers": _top_referrers,
        "kpi_stores_by_country": _stores_by_country,
        "kpi_stores_by_domain_country": _kpi(
            kpi.stores_by_domain_country, ["domain_country", "store_id"], fx.DOMAIN_COUNTRY
        ),
        "kpi_product_hourly": _product_hourly,
        "kpi_hourly_browser_os": _hourly_devices,
        "kpi_hourly_browser_os_sets": lambda s, d: kpi.device_sets(_hourly_devices(s, d)),
        # The same on a stored warehouse
        "stored_top_products": _stored(lambda w: kpi.top_products(w[FACT], fx.AS_OF)),
        "stored_top_countries_ip": _stored(
            lambda w: kpi.top_ip_countries(w[FACT], w["dim_location"], fx.AS_OF)
        ),
        "stored_top_referrers": _stored(
            lambda w: kpi.top_referrers(w[FACT], w["dim_referrer_url"], fx.AS_OF)
        ),
        "stored_stores_by_country": _stored(_stored_stores_by_country),
        "stored_product_hourly": _stored(
            lambda w: kpi.product_hourly(w[FACT], _most_viewed_product(w[FACT]), fx.AS_OF)
        ),
        "stored_hourly_browser_os": _stored(
            lambda w: kpi.hourly_browser_os(w[FACT], w["dim_browser"], w["dim_os"], fx.AS_OF)
        ),
        # The same on its hourly counts
        "stored_top_countries_domain": _rolled(
            lambda rollup, dims: kpi.top_domain_countries(rollup("domain_store"), fx.AS_OF)
        ),
        "stored_stores_by_domain_country": _rolled(
            lambda rollup, dims: kpi.stores_by_domain_country(
                rollup("domain_store"), fx.DOMAIN_COUNTRY
            )
        ),
        "stored_hourly_browser_os_sets": _rolled(
            lambda rollup, dims: kpi.hourly_browser_os_sets(
                rollup("device"), dims["dim_browser"], dims["dim_os"], fx.AS_OF
            )
        ),
        "rollup_top_products": _rolled(
            lambda rollup, dims: kpi.top_products(rollup("product"), fx.AS_OF)
        ),
        "rollup_top_countries_ip": _rolled(
            lambda rollup, dims: kpi.top_ip_countries(
                rollup("place_store"), dims["dim_location"], fx.AS_OF
            )
        ),
        "rollup_top_referrers": _rolled(
            lambda rollup, dims: kpi.top_referrers(
                rollup("referrer"), dims["dim_referrer_url"], fx.AS_OF
            )
        ),
        "rollup_stores_by_country": _rolled(_rolled_stores_by_country),
        "rollup_product_hourly": _rolled(_rolled_product_hourly),
        "rollup_hourly_browser_os": _rolled(
            lambda rollup, dims: kpi.hourly_browser_os(
                rollup("device"), dims["dim_browser"], dims["dim_os"], fx.AS_OF
            )
        ),
        # Stream health
        "ops_rate_per_sec": lambda s, d: health.messages_per_second(fx.message_log(s, d)),
        "ops_rate_per_min": lambda s, d: health.messages_per_minute(fx.message_log(s, d)),
        "stream_rate_per_sec": _stream_rates(health.messages_per_second),
        "stream_rate_per_min": _stream_rates(health.messages_per_minute),
        "ops_consumer_lag": lambda s, d: health.consumer_lag(
            fx.message_log(s, d), fx.group_commits(fx.message_log(s, d))
        ),
        "ops_consume_rate": lambda s, d: health.consume_rate(
            fx.group_commits(fx.message_log(s, d))
        ),
        "ops_partitions": lambda s, d: health.partitions_per_topic(fx.message_log(s, d)),
        "ops_counter_rate": lambda s, d: health.counter_rate(
            fx.metric_samples(s, d), "cpu_halfseconds_total"
        ),
        "ops_gauge_sum": lambda s, d: health.gauge_sum(
            fx.metric_samples(s, d).where(F.col("metric").isin("memory_used", "memory_max"))
        ),
        "ops_threshold_alert": lambda s, d: health.usage_alerts(
            fx.metric_samples(s, d), "memory_used", "memory_max", threshold=0.2
        ),
        "canary_roundtrip": lambda s, d: health.canary_roundtrip(
            fx.canary_sent(s, d), fx.canary_received(s, d)
        ),
    }
    ours = {name: _in_utc(query) for name, query in registered.items()}
    return ours | (llm_queries.queries() if llm_queries else {})


def oracle_sql() -> dict[str, str]:
    """For each query, SQL that DuckDB runs on the same tables."""
    return oracles.oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})
