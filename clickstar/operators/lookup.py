"""Sizes and key counts of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 128 * 1024 * 1024
COUNT = "_n"

# What a row and a field cost in a hashed relation besides their text.
_ROW_BYTES = 32
_FIELD_BYTES = 8


def measured_bytes(df: DataFrame, copies: F.Column | None = None) -> int:
    """Size of a table in memory, measured by one aggregation; `copies` weighs each row."""
    size = F.lit(_ROW_BYTES + _FIELD_BYTES * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    if copies is not None:
        size = size * copies
    return df.agg(F.sum(size.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per non-null key, counted in each task before the shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(COUNT))
