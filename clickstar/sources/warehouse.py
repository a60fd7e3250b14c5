"""Warehouse tables as Parquet, one folder per write epoch, merged as they grow in number."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import date_of_hour_key
from ..runtime import scratch_path, stored
from ..schema import DIMENSIONS, FACT, WAREHOUSE, key_of
from .keyindex import KeyIndex
from .runs import EPOCH, FAN_IN, Run, merge_runs, path_exists, read_runs, remove_path, runs

__all__ = ["EPOCH", "path_exists", "remove_path"]

# Streams number their epochs from 0; a backfill comes before all of them.
BACKFILL_EPOCH = -1

# Most keys of a batch to send to the target: as md5 text, some 200 MB.
MAX_BROADCAST_KEYS = 2_000_000

# The fact lies in one folder per UTC date of its events, for day queries to read one day.
FACT_DATE = "event_date"


def conform(df: DataFrame, table: str) -> DataFrame:
    """`df` as the table's columns, in order; refuses missing columns and other types."""
    schema = WAREHOUSE[table]
    given = {field.name: field.dataType for field in df.schema.fields}
    wrong = [
        f"{field.name} {field.dataType.simpleString()}"
        for field in schema.fields
        if given.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError(f"{table} needs {', '.join(wrong)}; got {df.schema.simpleString()}")
    return df.select(*schema.fieldNames())


def _stored_schema(table: str) -> T.StructType:
    schema = T.StructType(list(WAREHOUSE[table].fields)).add(EPOCH, T.LongType())
    return schema.add(FACT_DATE, T.DateType()) if table == FACT else schema


def dims_then_fact(spark: SparkSession, write: Callable[[str], None]) -> None:
    """Write every table: the dimensions' jobs side by side, as most are small, then the fact."""
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), DIMENSIONS))
    write(FACT)


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The table with its epoch_id, and event_date for the fact; empty if never written."""
    path = f"{warehouse}/{table}"
    return read_runs(spark, path, _stored_schema(table), runs(spark, path))


def read_warehouse(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """Every table without its epoch; the fact keeps event_date for partition pruning."""
    return {
        table: read_table(spark, warehouse, table).drop(EPOCH) for table in WAREHOUSE
    }


def write_epoch(df: DataFrame, warehouse: str, table: str, epoch: int) -> None:
    """Write the rows of one epoch, in place of what an interrupted try may have left.

    The fact is rebalanced by date: AQE joins small partitions and splits a busy day over many
    tasks and files, which hash partitioning by date would not.
    """
    path = f"{warehouse}/{table}/{EPOCH}={epoch}"
    rows = conform(df, table)
    if table == FACT:
        rows = rows.withColumn(FACT_DATE, date_of_hour_key(F.col("time_id")))
    _write(rows, table, path)


def _write(rows: DataFrame, table: str, folder: str) -> None:
    if table == FACT:
        rows.hint("rebalance", FACT_DATE).write.mode("overwrite").partitionBy(FACT_DATE).parquet(
            folder
        )
    else:
        rows.write.mode("overwrite").parquet(folder)


def merge_table(
    spark: SparkSession, warehouse: str, table: str, before: int, fan_in: int = FAN_IN
) -> list[Run]:
    """Merge a table's epochs below `before` where enough have come together, beside the stream that
    writes later ones. Rows keep their epoch. Gives the folders it removed."""
    path, stored = f"{warehouse}/{table}", _stored_schema(table)

    def merge(parts: list[Run], folder: str) -> None:
        rows = read_runs(spark, path, stored, parts)
        _write(rows if table == FACT else rows.hint("rebalance"), table, folder)

    return merge_runs(spark, path, before, merge, fan_in)


def fact_index(warehouse: str) -> KeyIndex:
    """The index of the fact's ids. Dimensions need none: they stay small beside the fact, or hold
    nearly all keys of a batch already, which no filter makes cheaper to find."""
    return KeyIndex(f"{warehouse}/{FACT}", _stored_schema(FACT), key_of(FACT))


def merge_epochs(spark: SparkSession, warehouse: str, merged: str) -> None:
    """Copy a warehouse to a fresh path with all its epochs in one, in larger files.

    For a stopped stream, which then goes on with its checkpoint and the new path. An epoch it had
    not finished runs again there, and finds the rows it had written. A running stream merges its
    epochs by itself (`merge_table`).
    """
    tables = read_warehouse(spark, warehouse)
    dims_then_fact(
        spark,
        lambda table: write_epoch(
            tables[table].hint("rebalance"), merged, table, BACKFILL_EPOCH
        ),
    )


def absent_rows(
    rows: DataFrame,
    target: DataFrame,
    key: str,
    max_rows: int | None = None,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """`rows` whose key is not in `target`. Both have one row per key.

    `max_rows` is a known bound on `rows`. A small batch sends its keys to the target, which is
    read in place, key column only, and not shuffled; the few keys found come back. Without a
    bound, or above it, both sides shuffle on the key, which no row shares, so tasks stay even.
    """
    keys = target.select(key)
    if max_rows is not None and max_rows <= max_broadcast_keys:
        keys = keys.join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(keys, key, "left_anti")


def insert_if_absent(
    rows: DataFrame,
    warehouse: str,
    table: str,
    epoch: int,
    max_rows: int | None = None,
    within: Column | None = None,
    index: KeyIndex | None = None,
    also: Callable[[DataFrame], None] | None = None,
) -> None:
    """Add rows with new keys; a key once written keeps its first row.

    Only epochs before this one count as written, so an epoch run again writes the same rows.
    `rows` has at most one row per key; rows without a key are left out. With an `index` only files
    that may hold a key of the batch are read, else the key column of the table. `within` limits the
    stored rows that are looked through, for tables whose keys cannot lie outside it. `also` is
    called with the new rows once they are written, if there are any, and may run again as they may.
    """
    spark, key = rows.sparkSession, key_of(table)
    keyed = rows.where(F.col(key).isNotNull())
    if index is not None and within is None:
        fresh = index.absent(keyed, epoch)
    else:
        earlier = read_table(spark, warehouse, table).where(F.col(EPOCH) < epoch)
        if within is not None:
            earlier = earlier.where(within)
        fresh = absent_rows(keyed, earlier, key, max_rows)
    first = not runs(spark, f"{warehouse}/{table}")
    held = None
    if not first and fresh is not keyed:
        held = scratch_path(spark, "fresh")
        fresh = stored(fresh, held)
    try:
        # Most batches bring a dimension nothing new; no folder is written for those.
        if first or not fresh.isEmpty():
            write_epoch(fresh, warehouse, table, epoch)
            if also is not None:
                also(fresh)
    finally:
        if held is not None:
            remove_path(spark, held)
