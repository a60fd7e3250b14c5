"""Completeness of a warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DIMENSIONS, FACT, WAREHOUSE, key_of
from ..sources.runs import runs
from ..sources.warehouse import read_warehouse


def missing_tables(spark: SparkSession, warehouse: str) -> list[str]:
    """Tables the warehouse should have and does not."""
    return [table for table in WAREHOUSE if not runs(spark, f"{warehouse}/{table}")]


def _key_checks(df: DataFrame, table: str) -> DataFrame:
    key = F.col(key_of(table))
    counts = df.agg(
        F.count("*").alias("n_rows"),
        F.count(key).alias("n_keys"),
        F.countDistinct(key).alias("n_distinct"),
    )
    checks = counts.select(
        F.lit(table).alias("table_name"),
        F.col("n_rows").alias("rows"),
        (F.col("n_rows") - F.col("n_keys")).alias("null_keys"),
        (F.col("n_keys") - F.col("n_distinct")).alias("duplicate_keys"),
    )
    return checks.unpivot("table_name", None, "check_name", "n")


def _fact_checks(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All checks of the fact in one pass: each row gives its own key and those to dimensions, which
    are counted before they meet the dimensions' keys."""
    own = key_of(FACT)
    keys = [own, *map(key_of, dims)]
    named = F.explode(
        F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).cast("string").alias("key")) for k in keys])
    )
    used = fact.select(named.alias("k")).groupBy("k.name", "k.key").agg(F.count("*").alias("n"))
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(
                F.lit(key_of(table)).alias("name"), F.col(key_of(table)).cast("string").alias("key")
            )
            for table, dim in dims.items()
        ],
    )
    found = used.join(known.distinct().withColumn("known", F.lit(True)), ["name", "key"], "left")
    keyed, lost = F.col("key").isNotNull(), F.col("known").isNull()

    def total(condition) -> F.Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    here = F.col("name") == own
    checks = {
        "rows": total(here),
        "null_keys": total(here & ~keyed),
        "duplicate_keys": total(here & keyed) - F.count(F.when(here & keyed, 1)),
        **{f"orphan_{key}": total((F.col("name") == key) & keyed & lost) for key in keys[1:]},
    }
    counted = found.agg(*[check.alias(name) for name, check in checks.items()])
    return counted.withColumn("table_name", F.lit(FACT)).unpivot(
        "table_name", None, "check_name", "n"
    )


def audit_star(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, null keys and duplicate keys of every table, and the fact's orphans per key."""
    dims = {table: tables[table] for table in DIMENSIONS}
    checks = [_key_checks(dim, table) for table, dim in dims.items()]
    return reduce(DataFrame.unionByName, [*checks, _fact_checks(tables[FACT], dims)])


def audit_warehouse(spark: SparkSession, warehouse: str) -> DataFrame:
    """The audit of a stored warehouse; one that lacks a table is refused by name."""
    missing = missing_tables(spark, warehouse)
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")
    return audit_star(read_warehouse(spark, warehouse))
