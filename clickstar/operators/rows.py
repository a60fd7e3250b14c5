"""Dedup, union and column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_per_key(
    df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str] = ()
) -> DataFrame:
    """One row per non-null key: the least by `order`, nulls last, then by `payload`.

    An aggregate of one struct, not a ranking: each task first reduces its own rows to one per
    key, so a key on a third of all rows crosses the shuffle once per task. Ties are broken by
    the payload itself, so a task run again keeps the same row. A struct has no hash aggregate,
    so rows are sorted by key; `earliest_per_key` and `first_deliveries` come here with few of them.
    """
    ranked: list[Column] = []
    for name in order:
        ranked += [F.col(name).isNull().alias(f"_no_{name}"), F.col(name)]
    ranked += [F.col(name) for name in payload if name not in order]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(*ranked)).alias("_row"))
        .select(key, *[f"_row.{name}" for name in dict.fromkeys([*order, *payload])])
    )


def earliest_per_key(
    df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str] = ()
) -> DataFrame:
    """The same rows, for keys with many rows each.

    The least first value of each key, a number or a time, is found by a hash aggregate of just these
    two columns, in each task and then over all. Only rows that have it are compared in full. `df` is
    read twice: the first time without its payload.
    """
    lead = order[0]
    keyed = df.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, *order, *payload]))
    least = keyed.groupBy(F.col(key).alias("_key")).agg(F.min(lead).alias("_least"))
    here = (F.col(key) == F.col("_key")) & F.col(lead).eqNullSafe(F.col("_least"))
    return first_per_key(keyed.join(least, here, "left_semi"), key, order, payload)


def deliveries(
    df: DataFrame, key: str, order: str, payload: Sequence[str] = ()
) -> DataFrame:
    """Rows by key and payload, each once, with the least `order`: one row for each id whose
    deliveries agree, however often and when they came.

    Grouping by what rows hold needs no more than a number beside the group, so it is a hash
    aggregate, in each task before the shuffle: a key on a third of all rows is one row a task.
    """
    keyed = df.where(F.col(key).isNotNull())
    return keyed.groupBy(key, *payload).agg(F.min(order).alias(order))


def first_deliveries(
    delivered: DataFrame, key: str, order: str, payload: Sequence[str] = ()
) -> DataFrame:
    """One row per key of `deliveries`, which must be stored: those that all have one row are done.

    A job counts rows by key, on the key column only. Keys with several different rows, few or none,
    have these compared.
    """
    several = delivered.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key)
    columns = list(dict.fromkeys([key, order, *payload]))
    rows = delivered.select(*columns)
    if several.isEmpty():
        return rows
    compared = first_per_key(rows.join(several, key, "left_semi"), key, [order], payload)
    return rows.join(several, key, "left_anti").unionByName(compared.select(*columns))


def with_columns_of(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with typed null columns for those of the schema it lacks."""
    missing = [field for field in schema.fields if field.name not in df.columns]
    return df.withColumns(
        {field.name: F.lit(None).cast(field.dataType) for field in missing}
    )


def top_k(counts: DataFrame, key: str, measure: str, k: int) -> DataFrame:
    """The k rows with the highest measure, least key first among equals."""
    return counts.orderBy(F.desc(measure), F.asc(key)).limit(k)
