"""Place of an address of either kind, by tables of IPv4 and of IPv6 ranges.

IPv6 ranges run from single networks to whole registries, so no one width of bucket fits them. A range
is cut at multiples of 2^80, 2^96 or 2^112 addresses, the finest of these that cuts it into at most
`MOST_CUTS` parts. An address is looked up at each of the three widths, and one range at most holds
it, as ranges do not overlap. Addresses are 32 hexadecimal digits, and a bucket is their beginning.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.net import ipv6_hex, mapped_ipv4
from ..runtime import scratch_path, stored
from .geo import MAX_BROADCAST_BYTES, UNKNOWN, GeoTable, locate
from .lookup import COUNT, key_counts, measured_bytes

#: Digits that a bucket is named by, widest first, and most buckets that a range may reach into where
#: there is a wider one.
WIDTHS = (4, 8, 12)
MOST_CUTS = 1_024

_PLACE = ["city", "region", "country"]


def _number(digits: Column, width: int) -> Column:
    return F.conv(F.substring(digits, 1, width), 16, 10).cast("bigint")


def _cuts(width: int) -> Column:
    return _number(F.col("ip_to"), width) - _number(F.col("ip_from"), width) + 1


@dataclass(frozen=True)
class Geo6Table:
    """Ranges cut into buckets, the widths that occur, and whether the table may be broadcast."""

    cut: DataFrame
    widths: tuple[int, ...]
    small: bool


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """Written once to the shared folder, so that no plan reads addresses again and again."""
    return stored(df, scratch_path(df.sparkSession, purpose))


def _by_bucket(addressed: DataFrame) -> DataFrame:
    """One row per range and bucket it reaches into."""
    finest = reduce(
        lambda chain, width: chain.when(_cuts(width) <= MOST_CUTS, F.lit(width)),
        reversed(WIDTHS[1:]),
        F,
    ).otherwise(F.lit(WIDTHS[0]))
    at_width = addressed.withColumn("_width", finest)
    parts = [
        at_width.where(F.col("_width") == width).select(
            "_width",
            F.explode(
                F.sequence(_number(F.col("ip_from"), width), _number(F.col("ip_to"), width))
            ).alias("_part"),
            "ip_from",
            "ip_to",
            *_PLACE,
        )
        for width in WIDTHS
    ]
    cut = reduce(DataFrame.unionByName, parts)
    named = F.lower(F.lpad(F.hex("_part"), 12, "0"))
    bucket = F.substring(named, F.lit(13) - F.col("_width"), F.col("_width"))
    return cut.withColumn("_bucket", bucket).drop("_part")


def _overlaps(cut: DataFrame) -> DataFrame:
    """Ranges that share an address with another of any width: each is brought to the widest buckets,
    where the furthest end so far tells."""
    so_far = W.partitionBy("_wide").orderBy("ip_from", "ip_to").rowsBetween(W.unboundedPreceding, -1)
    wide = cut.select(F.substring("_bucket", 1, WIDTHS[0]).alias("_wide"), "ip_from", "ip_to").distinct()
    ended = wide.withColumn("_end", F.max("ip_to").over(so_far))
    return ended.where(F.col("_end") >= F.col("ip_from")).limit(1)


def geo6_table(ranges: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> Geo6Table:
    """Measure a table of IPv6 ranges, `ip_from` and `ip_to` as text; refuses those it cannot read,
    such that end before they start, and overlapping ones."""
    digits = [ipv6_hex(F.col(end)).alias(f"_{end}") for end in ("ip_from", "ip_to")]
    read = _stored(ranges.select("ip_from", "ip_to", *digits, *_PLACE), "ranges")
    unread = F.col("_ip_from").isNull() | F.col("_ip_to").isNull()
    wrong = read.where(unread | (F.col("_ip_from") > F.col("_ip_to"))).first()
    if wrong:
        raise ValueError(f"no range of addresses: {wrong['ip_from']} to {wrong['ip_to']}")
    addressed = read.select(
        F.col("_ip_from").alias("ip_from"), F.col("_ip_to").alias("ip_to"), *_PLACE
    )
    cut = _stored(_by_bucket(addressed), "ranges")
    overlapping = _overlaps(cut).first()
    if overlapping:
        raise ValueError(f"ranges overlap: one from {overlapping['ip_from']} and an earlier one")
    widths = tuple(sorted(row[0] for row in cut.select("_width").distinct().collect()))
    return Geo6Table(cut, widths, measured_bytes(cut) <= max_broadcast_bytes)


def locate_any(events: DataFrame, geo: GeoTable, geo6: Geo6Table, ip: str = "ip") -> DataFrame:
    """`events` with city, region and country; Unknown where the address has no place.

    IPv4 addresses are looked up as `locate` does, also where they are written as IPv6; others in
    the IPv6 table: broadcast and joined once a width, without a shuffle, or, with a large table,
    once for each distinct address. With a large table what was read is stored first.
    """
    digits = ipv6_hex(F.col(ip))
    addressed = events.withColumn("_digits", digits)
    v4 = mapped_ipv4(F.col("_digits"))
    dotted = F.concat_ws(
        ".", *[F.shiftright(v4, shift).bitwiseAND(255).cast("string") for shift in (24, 16, 8, 0)]
    )
    addressed = addressed.withColumns(
        {
            "_v4": F.when(v4.isNotNull(), dotted).otherwise(F.col(ip)),
            "_digits": F.when(v4.isNull(), F.col("_digits")),
        }
    )
    if not (geo.small and geo6.small):
        # A lookup by shuffle first asks which addresses there are. As a filter that would go down to
        # the events and hold the reading of the text anew for each mention of what was read.
        addressed = _stored(addressed, "addresses")
    by_four = locate(addressed, geo, "_v4")
    by_six = _by_broadcast(by_four, geo6) if geo6.small else _by_shuffle(by_four, geo6, addressed)
    named = [
        F.when(
            F.col("_digits").isNotNull(),
            F.coalesce(F.nullif(F.col(f"_six.{place}"), F.lit("")), F.lit(UNKNOWN)),
        )
        .otherwise(F.col(place))
        .alias(place)
        for place in _PLACE
    ]
    return by_six.select(*events.columns, *named)


def _by_broadcast(events: DataFrame, geo6: Geo6Table) -> DataFrame:
    found = []
    for width in geo6.widths:
        name = f"_six{width}"
        ranges = geo6.cut.where(F.col("_width") == width).select(
            F.col("_bucket").alias(f"_b{width}"),
            F.struct("ip_from", "ip_to", *_PLACE).alias(name),
        )
        here = (
            (F.substring("_digits", 1, width) == F.col(f"_b{width}"))
            & (F.col("_digits") >= F.col(f"{name}.ip_from"))
            & (F.col("_digits") <= F.col(f"{name}.ip_to"))
        )
        events = events.join(F.broadcast(ranges), here, "left")
        found.append(F.col(name))
    if not found:
        return events.withColumn("_six", F.lit(None).cast("struct<city:string,region:string,country:string>"))
    return events.withColumn("_six", F.coalesce(*found))


def _by_shuffle(events: DataFrame, geo6: Geo6Table, addressed: DataFrame) -> DataFrame:
    """Each distinct address at each width beside the range starts of its bucket, in order: the last
    start before it is the only range of that width that can hold it. Addresses without a place are
    left out; the others return by a join that AQE splits where one is hot. `addressed` has the same
    addresses before any join."""
    starts = geo6.cut.select(
        "_width",
        "_bucket",
        F.greatest(F.col("ip_from"), F.rpad("_bucket", 32, "0")).alias("_at"),
        F.lit(None).cast("bigint").alias(COUNT),
        F.struct("ip_to", *_PLACE).alias("_six"),
    )
    widths = F.explode(F.array(*[F.lit(width) for width in geo6.widths or WIDTHS]))
    probes = (
        key_counts(addressed, "_digits")
        .select(F.col("_digits").alias("_at"), COUNT, widths.alias("_width"))
        .select(
            "_width",
            F.substring("_at", F.lit(1), F.col("_width")).alias("_bucket"),
            "_at",
            COUNT,
            F.lit(None).cast(starts.schema["_six"].dataType).alias("_six"),
        )
    )
    so_far = (
        W.partitionBy("_width", "_bucket")
        .orderBy("_at", F.asc_nulls_first(COUNT))
        .rowsBetween(W.unboundedPreceding, 0)
    )
    places = (
        starts.unionByName(probes)
        .withColumn("_six", F.last("_six", ignorenulls=True).over(so_far))
        .where(F.col(COUNT).isNotNull() & (F.col("_at") <= F.col("_six.ip_to")))
        .select(F.col("_at").alias("_address"), "_six")
    )
    return events.join(places, F.col("_digits") == F.col("_address"), "left")
