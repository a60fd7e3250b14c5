"""Place of an IPv4 address, by a join to a table of address ranges.

Ranges may leave gaps and must not overlap, which is checked when a table is measured. Both plans
cut ranges at multiples of 2^16 addresses and join on that bucket, so neither compares every address
with every range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.net import locatable_ip
from .lookup import COUNT, key_counts, measured_bytes

UNKNOWN = "Unknown"
MAX_BROADCAST_BYTES = 512 * 1024 * 1024

_BUCKET_BITS = 16
_PLACE = ["city", "region", "country"]


def _bucket(address):
    return F.shiftright(address, _BUCKET_BITS)


def _by_bucket(ranges: DataFrame) -> DataFrame:
    """One row per range and bucket it reaches into."""
    buckets = F.sequence(_bucket("ip_from"), _bucket("ip_to"))
    return ranges.select(
        F.explode(buckets).alias("_bucket"), "ip_from", "ip_to", *_PLACE
    )


def _named(place: str):
    return F.coalesce(F.nullif(F.col(place), F.lit("")), F.lit(UNKNOWN)).alias(place)


@dataclass(frozen=True)
class GeoTable:
    """A range table and whether it may be broadcast."""

    ranges: DataFrame
    small: bool


def geo_table(ranges: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> GeoTable:
    """Measure a range table, once for all the batches it serves. A range counts once per
    bucket it reaches into, as that is what would be broadcast. Overlapping ranges are refused: an
    address in two of them would have two places."""
    overlapping = overlaps(ranges).first()
    if overlapping:
        raise ValueError(f"ranges overlap: one from {overlapping['ip_from']} and an earlier one")
    spans = _bucket("ip_to") - _bucket("ip_from") + 1
    return GeoTable(ranges, measured_bytes(ranges, copies=spans) <= max_broadcast_bytes)


def overlaps(ranges: DataFrame) -> DataFrame:
    """Ranges that share an address with one that starts before or with them. Two such share a
    bucket, and there the furthest end so far tells."""
    so_far = (
        W.partitionBy("_bucket")
        .orderBy("ip_from", "ip_to")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    ended = _by_bucket(ranges).withColumn("_end", F.max("ip_to").over(so_far))
    return ended.where(F.col("_end") >= F.col("ip_from")).select("ip_from", "ip_to").limit(1)


def locate(events: DataFrame, geo: GeoTable, ip: str = "ip") -> DataFrame:
    """`events` with city, region and country; Unknown where the address has no place.

    A small range table is broadcast and events are not shuffled at all; with a large one the
    distinct addresses are looked up by shuffle.
    """
    addressed = events.withColumn("_ip", locatable_ip(F.col(ip)))
    if geo.small:
        located = _locate_by_broadcast(addressed, geo.ranges)
    else:
        located = _locate_by_shuffle(addressed, geo.ranges)
    return located.select(*events.columns, *[_named(place) for place in _PLACE])


def _locate_by_broadcast(addressed: DataFrame, ranges: DataFrame) -> DataFrame:
    cut = _by_bucket(ranges)
    here = (_bucket(addressed["_ip"]) == cut["_bucket"]) & addressed["_ip"].between(
        cut["ip_from"], cut["ip_to"]
    )
    return addressed.join(F.broadcast(cut), here, "left")


def _locate_by_shuffle(addressed: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each distinct address is looked up once, and its place goes back to the events by a join,
    whose partitions AQE splits where an address is hot."""
    ranged = _range_of(key_counts(addressed, "_ip"), ranges)
    places = ranged.select("_ip", *[f"_range.{place}" for place in _PLACE])
    return addressed.join(places, "_ip", "left")


def _range_of(counted: DataFrame, ranges: DataFrame) -> DataFrame:
    """Distinct addresses, with their counts, and the range each lies in, or null.

    The last range start at or before an address within its bucket is the only one that can hold
    it. A bucket has at most 65,536 addresses and as many starts, however many events share an
    address, so every window group is small.
    """
    starts = _by_bucket(ranges).select(
        "_bucket",
        F.greatest("ip_from", F.shiftleft("_bucket", _BUCKET_BITS)).alias("_at"),
        F.lit(None).cast("bigint").alias(COUNT),
        F.struct("ip_from", "ip_to", *_PLACE).alias("_range"),
    )
    probes = counted.select(
        _bucket("_ip").alias("_bucket"),
        F.col("_ip").alias("_at"),
        COUNT,
        F.lit(None).cast(starts.schema["_range"].dataType).alias("_range"),
    )
    # A range start has no count and so comes before an event at its very address.
    so_far = (
        W.partitionBy("_bucket")
        .orderBy("_at", F.asc_nulls_first(COUNT))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        starts.unionByName(probes)
        .withColumn("_range", F.last("_range", ignorenulls=True).over(so_far))
        .where(F.col(COUNT).isNotNull())
        .select(
            F.col("_at").alias("_ip"),
            COUNT,
            F.when(F.col("_at") <= F.col("_range.ip_to"), F.col("_range")).alias("_range"),
        )
    )


def views_per_range(events: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Each range with the number of events from it; addresses are counted before the lookup."""
    addresses = events.select(locatable_ip(F.col(ip)).alias("_ip"))
    per_range = (
        _range_of(key_counts(addresses, "_ip"), ranges)
        .where(F.col("_range").isNotNull())
        .groupBy("_range.ip_from")
        .agg(F.sum(COUNT).alias("views"))
    )
    return ranges.join(per_range, "ip_from", "left").withColumn(
        "views", F.coalesce("views", F.lit(0))
    )
