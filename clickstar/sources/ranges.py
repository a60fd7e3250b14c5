"""Range tables for address lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schema import GEO_RANGE


def read_geo_ranges(
    spark: SparkSession,
    path: str,
    source_format: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """ip_from, ip_to, country, region, city from Parquet, CSV or any file format."""
    return (
        spark.read.format(source_format)
        .schema(GEO_RANGE)
        .options(**(options or {}))
        .load(path)
    )
