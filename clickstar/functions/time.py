"""Attributes of the hour an event falls in.

Times are zone-less (TIMESTAMP_NTZ) and count from the UTC epoch, so no result depends on the
session's zone and no hour is ambiguous at a change to or from daylight saving time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch seconds of 0001-01-01T00:00:00 and 9999-12-31T23:59:59; outside, the time is null.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def event_hour(seconds: Column) -> Column:
    """Epoch seconds to the start of their hour."""
    hours = F.floor(seconds / F.lit(3600)).cast("int")
    start = F.timestamp_add("HOUR", hours, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return F.when(seconds.between(_FIRST_SECOND, _LAST_SECOND), start)


def event_date(seconds: Column) -> Column:
    """Epoch seconds to their UTC date."""
    days = F.floor(seconds / F.lit(86400)).cast("int")
    return F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND), F.date_add(F.lit("1970-01-01").cast("date"), days)
    )


def hour_key(hour_start: Column) -> Column:
    """yyyyMMddHH as a number."""
    day = F.year(hour_start) * 10000 + F.month(hour_start) * 100 + F.dayofmonth(hour_start)
    return day.cast("bigint") * 100 + F.hour(hour_start)


def date_of_hour_key(time_id: Column) -> Column:
    """The date part of an hour key."""
    day = F.floor(time_id / F.lit(100)).cast("int")
    return F.make_date(
        F.floor(day / F.lit(10000)).cast("int"),
        (F.floor(day / F.lit(100)) % 100).cast("int"),
        (day % 100).cast("int"),
    )


def hour_attributes(hour_start: Column) -> dict[str, Column]:
    """Every dim_time column, by name, in table order."""
    weekday = F.dayofweek(hour_start)  # Sunday is 1
    day = F.dayofmonth(hour_start)
    return {
        "time_id": hour_key(hour_start),
        "timestamp": hour_start,
        "hour": F.hour(hour_start),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(1, 7),
        "day_of_month": day,
        "day_of_year": F.dayofyear(hour_start),
        "week_of_month": F.ceil(day / F.lit(7)).cast("int"),
        "week_of_year": F.weekofyear(hour_start),
        "month_of_year": F.month(hour_start),
        "quarter": F.quarter(hour_start),
        "year": F.year(hour_start),
    }
