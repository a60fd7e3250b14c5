"""Keys derived from event text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import RECOMMENDATION_PREFIX


def hash_key(*parts: Column) -> Column:
    """md5 of the parts written one after the other; null if any part is null."""
    return F.md5(F.concat(*parts))


def location_key(city: Column, region: Column, country: Column) -> Column:
    return hash_key(city, region, country)


def int_id(text: Column) -> Column:
    """An id sent as text; null when it is no integer."""
    return text.try_cast("int")


def is_recommendation(collection: Column) -> Column:
    """True, false, or null for an event without a type."""
    return collection.startswith(RECOMMENDATION_PREFIX)


def effective_product_id(
    collection: Column, product_id: Column, viewing_product_id: Column
) -> Column:
    """The product an event is about: the one on view for recommendations, if sent."""
    text = F.when(
        is_recommendation(collection), F.coalesce(viewing_product_id, product_id)
    ).otherwise(product_id)
    return int_id(text)


def store_name(store_id: Column) -> Column:
    """Built on the id as sent, before it becomes a number."""
    return F.concat(F.lit("store_"), store_id)
