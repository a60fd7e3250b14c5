"""KPI reports on the star.

Each counts on the fact's keys first and joins labels to the counts, never to events: what
crosses a shuffle is one partial count per key and task, and a popular key is no heavier than
another. On a stored fact the day filter prunes to one date's folder.

`views` is the fact, or `unique_views` with the columns a report needs, or a rollup, whose rows are
counts already; all have event_date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import event_hour, hour_key
from ..operators.rows import top_k

_HOURS = 24


def on_day(views: DataFrame, day: dt.date) -> DataFrame:
    return views.where(F.col("event_date") == F.lit(day))


def view_counts(views: DataFrame, *keys: str) -> DataFrame:
    """Views per key; rows without a key do not count."""
    keyed = views
    for key in keys:
        keyed = keyed.where(F.col(key).isNotNull())
    counts = F.sum("views") if "views" in views.columns else F.count("*")
    return keyed.groupBy(*keys).agg(counts.alias("views"))


def top_products(views: DataFrame, day: dt.date, k: int = 10) -> DataFrame:
    return top_k(view_counts(on_day(views, day), "product_id"), "product_id", "views", k)


def top_domain_countries(views: DataFrame, day: dt.date, k: int = 10) -> DataFrame:
    """Country by the shop domain the page was on."""
    counts = view_counts(on_day(views, day), "domain_country")
    return top_k(counts, "domain_country", "views", k)


def top_ip_countries(
    views: DataFrame, dim_location: DataFrame, day: dt.date, k: int = 10
) -> DataFrame:
    """Country by the visitor's address."""
    places = view_counts(on_day(views, day), "location_id")
    countries = (
        places.join(dim_location.select("location_id", "country"), "location_id")
        .groupBy("country")
        .agg(F.sum("views").alias("views"))
    )
    return top_k(countries, "country", "views", k)


def top_referrers(
    views: DataFrame, dim_referrer_url: DataFrame, day: dt.date, k: int = 5
) -> DataFrame:
    """The k best keys are found first, and only they look up their address."""
    counts = view_counts(on_day(views, day), "referrer_url_id")
    leaders = top_k(counts, "referrer_url_id", "views", k)
    return (
        dim_referrer_url.join(F.broadcast(leaders), "referrer_url_id")
        .orderBy(F.desc("views"), F.asc("referrer_url_id"))
        .select("referrer_url", "views")
    )


def stores_by_ip_country(
    views: DataFrame, dim_location: DataFrame, country: str
) -> DataFrame:
    """Stores viewed from a country, most viewed first."""
    there = dim_location.where(F.col("country") == country).select("location_id")
    return (
        view_counts(views, "location_id", "store_id")
        .join(there, "location_id", "left_semi")
        .groupBy("store_id")
        .agg(F.sum("views").alias("views"))
        .orderBy(F.desc("views"), F.asc("store_id"))
    )


def top_labels(
    views: DataFrame, label: str, day: dt.date, k: int = 10, by: str | None = None
) -> DataFrame:
    """The k most viewed labels of the day, straight from events that carry them; equals come in
    order of `by`, else of the label."""
    keys = [label] if by is None else [by, label]
    return top_k(view_counts(on_day(views, day), *keys), keys[0], "views", k).select(label, "views")


def most_viewed_country(views: DataFrame, dim_location: DataFrame) -> str | None:
    """The country that most views come from, of those that are known."""
    known = dim_location.where(F.col("country") != "Unknown").select("location_id", "country")
    counts = view_counts(views, "location_id").join(known, "location_id")
    countries = counts.groupBy("country").agg(F.sum("views").alias("views"))
    top = top_k(countries, "country", "views", 1).first()
    return top["country"] if top else None


def stores_of_top_country(views: DataFrame) -> DataFrame:
    """Stores viewed from the country that most views come from, most viewed first; from events that
    carry the country. Views are counted once, and the country is one row beside the counts."""
    counts = views.groupBy("country", "store_id").agg(F.count("*").alias("views"))
    known = counts.where(F.col("country") != "Unknown").groupBy("country")
    top = top_k(known.agg(F.sum("views").alias("views")), "country", "views", 1).select("country")
    return (
        counts.join(F.broadcast(top), "country")
        .where(F.col("store_id").isNotNull())
        .select("store_id", "views")
        .orderBy(F.desc("views"), F.asc("store_id"))
    )


def hourly_devices(views: DataFrame, day: dt.date) -> DataFrame:
    """Views of the day by hour, browser and system, from events that carry these names."""
    counts = view_counts(on_day(views, day), "time_id", "browser", "os")
    return counts.select((F.col("time_id") % 100).cast("int").alias("hour"), "browser", "os", "views")


def stores_by_domain_country(views: DataFrame, country: str) -> DataFrame:
    """Stores viewed on a country's domain, most viewed first."""
    return view_counts(
        views.where(F.col("domain_country") == country), "store_id"
    ).orderBy(F.desc("views"), F.asc("store_id"))


def product_hourly(views: DataFrame, product_id: int, day: dt.date) -> DataFrame:
    """24 rows: views of a product in each hour of the day, 0 where there were none."""
    midnight = int(dt.datetime.combine(day, dt.time(), dt.timezone.utc).timestamp())
    spark = views.sparkSession
    spine = spark.range(_HOURS, numPartitions=1).select(
        F.col("id").cast("int").alias("hour"),
        hour_key(event_hour(F.lit(midnight) + F.col("id") * 3600)).alias("time_id"),
    )
    counts = view_counts(
        on_day(views, day).where(F.col("product_id") == product_id), "time_id"
    )
    return spine.join(counts, "time_id", "left").select(
        "hour", F.coalesce("views", F.lit(0)).alias("views")
    )


def _named_devices(counts: DataFrame, dim_browser: DataFrame, dim_os: DataFrame) -> DataFrame:
    return (
        counts.join(dim_browser, "browser_id")
        .join(dim_os, "os_id")
        .select((F.col("time_id") % 100).cast("int").alias("hour"), "browser", "os", "views")
    )


def hourly_browser_os(
    views: DataFrame, dim_browser: DataFrame, dim_os: DataFrame, day: dt.date
) -> DataFrame:
    """Views of the day by hour, browser and operating system."""
    counts = view_counts(on_day(views, day), "time_id", "browser_id", "os_id")
    return _named_devices(counts, dim_browser, dim_os)


def hourly_browser_os_sets(
    views: DataFrame, dim_browser: DataFrame, dim_os: DataFrame, day: dt.date
) -> DataFrame:
    """The same by pair, and by browser and by system alone."""
    return device_sets(hourly_browser_os(views, dim_browser, dim_os, day))


def device_sets(counts: DataFrame) -> DataFrame:
    """Hourly counts by pair, and by browser and by system alone; of events, the sets would triple
    the rows."""
    sets = [["hour", "browser"], ["hour", "os"], ["hour", "browser", "os"]]
    return counts.groupingSets(sets, "hour", "browser", "os").agg(
        F.sum("views").alias("views")
    )
