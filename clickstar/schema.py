"""The event message and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The fields of an event message.
EVENT = _struct(
    _id=_S,
    id=_S,
    api_version=_S,
    collection=_S,
    current_url=_S,
    device_id=_S,
    email=_S,
    ip=_S,
    local_time=_S,
    option=T.ArrayType(_struct(option_id=_S, option_label=_S)),
    product_id=_S,
    viewing_product_id=_S,
    referrer_url=_S,
    store_id=_S,
    time_stamp=_L,
    user_agent=_S,
)

GEO_RANGE = _struct(ip_from=_L, ip_to=_L, country=_S, region=_S, city=_S)

CANARY_MESSAGE = _struct(message_id=_S, message=_S, timestamp=T.TimestampNTZType(), type=_S)

# The warehouse's tables and columns.
WAREHOUSE: dict[str, T.StructType] = {
    "dim_time": _struct(
        time_id=_L,
        timestamp=T.TimestampNTZType(),
        hour=_I,
        day_of_week=_I,
        is_weekend=T.BooleanType(),
        day_of_month=_I,
        day_of_year=_I,
        week_of_month=_I,
        week_of_year=_I,
        month_of_year=_I,
        quarter=_I,
        year=_I,
    ),
    "dim_product": _struct(product_id=_I, product_name=_S),
    "dim_location": _struct(location_id=_S, city=_S, region=_S, country=_S),
    "dim_store": _struct(store_id=_I, store_name=_S),
    "dim_referrer_url": _struct(referrer_url_id=_S, referrer_url=_S),
    "dim_browser": _struct(browser_id=_S, browser=_S),
    "dim_os": _struct(os_id=_S, os=_S),
    "fact_view_event": _struct(
        event_id=_S,
        event_type=_S,
        time_id=_L,
        product_id=_I,
        store_id=_I,
        location_id=_S,
        referrer_url_id=_S,
        browser_id=_S,
        os_id=_S,
    ),
}

DIMENSIONS = [name for name in WAREHOUSE if name.startswith("dim_")]
FACT = "fact_view_event"


def key_of(table: str) -> str:
    """Primary key: the event id for the fact, else the table name with _id for dim_."""
    return "event_id" if table == FACT else table.removeprefix("dim_") + "_id"


# The event types the warehouse takes in.
ALLOWED_COLLECTIONS = [
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
    "product_detail_recommendation_clicked",
]

# Fixed value: event types starting with this text are recommendations.
RECOMMENDATION_PREFIX = "product_detail_recommendation"
