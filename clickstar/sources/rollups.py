"""Hourly counts beside the fact: views by hour and the keys that reports ask for.

Each epoch writes the counts of the rows it added to the fact, in a folder of its own, so counts of one
hour lie in as many rows as epochs brought views of it, late ones too; reports add them up. An epoch
run again replaces its folder. Merged folders hold one row for an hour and its keys.

The country of a page's domain is a key here that the fact does not have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import date_of_hour_key
from ..schema import FACT, WAREHOUSE
from .runs import EPOCH, FAN_IN, Run, merge_runs, read_runs, runs

ROLLUP = "rollup"

#: Keys of each rollup besides the hour.
ROLLUPS = {
    "product": ["product_id"],
    "place_store": ["location_id", "store_id"],
    "referrer": ["referrer_url_id"],
    "device": ["browser_id", "os_id"],
    "domain_store": ["domain_country", "store_id"],
}

_KEYS = list(dict.fromkeys(key for keys in ROLLUPS.values() for key in keys))
_KIND = {field.name: field.dataType for field in WAREHOUSE[FACT]} | {"domain_country": T.StringType()}
_HOUR = ["time_id", "event_date"]


def _schema() -> T.StructType:
    schema = T.StructType().add("time_id", _KIND["time_id"])
    for key in _KEYS:
        schema = schema.add(key, _KIND[key])
    schema = schema.add("views", T.LongType()).add(EPOCH, T.LongType())
    return schema.add(ROLLUP, T.StringType()).add("event_date", T.DateType())


def hourly_counts(views: DataFrame) -> DataFrame:
    """Every rollup of the rows, in one aggregation: fact columns and `domain_country`.

    Rows are counted in each task before the shuffle, so neither a busy hour nor a hot key is a task
    of its own. Keys that are null stay so; a rollup's other keys are null throughout.
    """
    dated = views.withColumn("event_date", date_of_hour_key(F.col("time_id")))
    sets = [[*_HOUR, *keys] for keys in ROLLUPS.values()]
    columns = [*_HOUR, *_KEYS]
    # A bit for each column that a set leaves out, the first column's the highest.
    left_out = {
        name: sum(1 << (len(columns) - 1 - at) for at, c in enumerate(columns) if c not in chosen)
        for name, chosen in zip(ROLLUPS, sets, strict=True)
    }
    which = reduce(
        lambda chain, name: chain.when(F.grouping_id() == left_out[name], F.lit(name)), left_out, F
    )
    return dated.groupingSets(sets, *columns).agg(
        F.count("*").alias("views"), which.alias(ROLLUP)
    )


def _write(counts: DataFrame, folder: str) -> None:
    columns = [c for c in _schema().fieldNames() if c != EPOCH]
    counts.select(*columns).hint("rebalance", ROLLUP, "event_date").write.mode("overwrite").partitionBy(
        ROLLUP, "event_date"
    ).parquet(folder)


def write_rollup_epoch(views: DataFrame, warehouse: str, epoch: int) -> None:
    """Counts of the rows that an epoch added, in place of what an earlier try may have left."""
    _write(hourly_counts(views), f"{warehouse}/{ROLLUP}/{EPOCH}={epoch}")


def merge_rollups(
    spark: SparkSession, warehouse: str, before: int, fan_in: int = FAN_IN
) -> list[Run]:
    """Merge epochs' counts below `before` where enough have come together, adding them up."""
    path = f"{warehouse}/{ROLLUP}"

    def merge(parts: list[Run], folder: str) -> None:
        counts = read_runs(spark, path, _schema(), parts)
        _write(counts.groupBy(*_HOUR, *_KEYS, ROLLUP).agg(F.sum("views").alias("views")), folder)

    return merge_runs(spark, path, before, merge, fan_in)


def read_rollup(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """`event_date, time_id`, the rollup's keys and `views`, several rows to be added up. Reading one
    date reads one folder of each epoch. Reports take it in place of the fact."""
    path = f"{warehouse}/{ROLLUP}"
    rows = read_runs(spark, path, _schema(), runs(spark, path))
    return rows.where(F.col(ROLLUP) == name).select("event_date", "time_id", *ROLLUPS[name], "views")
