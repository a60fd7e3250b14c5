"""Parsed events to one wide row per event, from which every table is a projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.agent import browser_family, os_family
from ..functions.keys import effective_product_id, int_id, is_recommendation, store_name
from ..functions.time import event_date, event_hour
from ..functions.url import domain_country
from ..operators.geo import GeoTable, locate
from ..operators.rows import with_columns_of
from ..schema import EVENT


def enrich(events: DataFrame, geo: GeoTable | None = None) -> DataFrame:
    """Accepted events with the attributes the star needs.

    One pass: recommendations and other events differ in one expression, so the input is not
    split and read twice. Columns are plain expressions, and Catalyst drops those a table does
    not use. Places need a join, made once, and only if `geo` is given.
    """
    whole = with_columns_of(events, EVENT)
    located = whole if geo is None else locate(whole, geo)
    collection = F.col("collection")
    place = [] if geo is None else ["city", "region", "country"]
    return located.select(
        F.col("id").alias("event_id"),
        collection.alias("event_type"),
        "time_stamp",
        event_hour(F.col("time_stamp")).alias("hour_start"),
        event_date(F.col("time_stamp")).alias("event_date"),
        is_recommendation(collection).alias("is_recommendation"),
        effective_product_id(
            collection, F.col("product_id"), F.col("viewing_product_id")
        ).alias("product_id"),
        "current_url",
        domain_country(F.col("current_url")).alias("domain_country"),
        int_id(F.col("store_id")).alias("store_id"),
        store_name(F.col("store_id")).alias("store_name"),
        "referrer_url",
        browser_family(F.col("user_agent")).alias("browser"),
        os_family(F.col("user_agent")).alias("os"),
        *place,
    )
