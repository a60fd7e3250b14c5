"""Operators against brute force, with hot keys, null keys and both plans of each join."""

import ipaddress
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.operators.geo import geo_table, locate, overlaps, views_per_range
from clickstar.operators.lookup import measured_bytes
from clickstar.operators.rows import first_per_key, top_k, with_columns_of
from clickstar.sources.warehouse import absent_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_facts(spark):
    """A third of all rows on key 7, a third without a key; 13 is hot too and has no match."""
    keys = [7] * 300 + [None] * 300 + [13] * 60 + [n % 40 for n in range(240)]
    return spark.createDataFrame([(n, k) for n, k in enumerate(keys)], "n int, k int"), keys


def labels(spark):
    known = {k: f"label-{k}" for k in range(40) if k != 13}
    return spark.createDataFrame(list(known.items()), "k int, label string"), known


def test_aqe_splits_hot_and_null_keys_of_a_star_join(spark):
    """With the thresholds of a small table, a left join is split where a key is hot."""
    facts, keys = skewed_facts(spark)
    side, known = labels(spark)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        joined = facts.repartition(8).join(side, "k", "left").select("n", "k", *side.columns[1:])
        assert rows(joined) == {(n, k, known.get(k)) for n, k in enumerate(keys)}
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)


def test_measured_bytes_grows_with_rows_and_text(spark):
    short = spark.range(10).select("id", F.lit("ab").alias("t"))
    assert measured_bytes(short) < measured_bytes(short.union(short))
    assert measured_bytes(short) < measured_bytes(short.withColumn("t", F.lit("a" * 99)))
    assert measured_bytes(short.where("id < 0")) == 0


def random_ranges(rng):
    """Ranges without overlap, some adjacent, some across buckets, some within one address."""
    cuts = sorted(rng.sample(range(1 << 24, 1 << 25), 400) + [(1 << 24) + n for n in range(6)])
    found = [
        (low, high - 1, f"country{n % 7}", f"region{n % 11}", None if n % 9 == 0 else f"city{n}")
        for n, (low, high) in enumerate(zip(cuts, cuts[1:]))
        if n % 5 != 0 and high > low
    ]
    return found


def test_locate_by_both_plans_equals_brute_force(spark):
    rng = random.Random(11)
    ranges = random_ranges(rng)
    edges = [edge for low, high, *_ in ranges for edge in (low - 1, low, high, high + 1)]
    numbers = edges + [rng.randrange(1 << 24, 1 << 25) for _ in range(500)]
    numbers += [ranges[3][0]] * 400  # one address on many events
    texts = [str(ipaddress.IPv4Address(n)) for n in numbers]
    texts += ["", "unknown", "0.0.0.0", "999.1.2.3", "x", None, "::1"] * 5

    def place(text):
        try:
            number = int(ipaddress.IPv4Address(text))
        except ValueError:
            return ("Unknown",) * 3
        for low, high, country, region, city in ranges:
            if low <= number <= high:
                return city or "Unknown", region, country
        return ("Unknown",) * 3

    by_text = {text: place(text) for text in set(texts) if text is not None} | {
        None: ("Unknown",) * 3
    }
    want = {(n, text, *by_text[text]) for n, text in enumerate(texts)}
    events = spark.createDataFrame(list(enumerate(texts)), "n int, ip string")
    table = spark.createDataFrame(
        ranges, "ip_from bigint, ip_to bigint, country string, region string, city string"
    )
    small = geo_table(table)
    large = geo_table(table, max_broadcast_bytes=0)
    assert small.small and not large.small
    assert rows(locate(events, small)) == want
    assert rows(locate(events, large)) == want
    assert "NestedLoop" not in plan(locate(events, small))
    assert "NestedLoop" not in plan(locate(events, large))

    views = rows(views_per_range(events, table), "ip_from", "views")
    numbered = [int(ipaddress.IPv4Address(t)) for t in texts if t and t[0].isdigit() and t != "999.1.2.3"]
    assert views == {(r[0], sum(r[0] <= n <= r[1] for n in numbered)) for r in ranges}


def test_small_range_table_leaves_events_unshuffled(spark):
    events = spark.createDataFrame([(1, "1.2.3.4")], "n int, ip string")
    table = spark.createDataFrame(
        [(0, 9, "a", "b", "c")],
        "ip_from bigint, ip_to bigint, country string, region string, city string",
    )
    shown = plan(locate(events, geo_table(table)))
    assert "BroadcastHashJoin" in shown and "Exchange hashpartitioning" not in shown


def test_first_per_key(spark):
    data = [
        ("a", 2, "x"),
        ("a", 1, "y"),
        ("a", 1, "w"),
        ("a", None, "0"),
        ("b", None, "z"),
        (None, 1, "n"),
    ]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(first_per_key(df, "k", ["t"], ["v"])) == {("a", 1, "w"), ("b", None, "z")}
    # one partial result per task and key goes over the shuffle
    assert plan(first_per_key(df, "k", ["t"], ["v"])).count("Aggregate") == 2


def test_with_columns_of(spark):
    wanted = T.StructType().add("a", "string").add("b", "integer")
    df = spark.createDataFrame([("x",)], "a string")
    whole = with_columns_of(df, wanted)
    assert whole.schema["b"].dataType == T.IntegerType() and rows(whole) == {("x", None)}
    assert with_columns_of(whole, wanted).columns == ["a", "b"]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("c", 5), ("b", 5), ("a", 1), ("d", 9)], "k string, n int")
    assert [r[0] for r in top_k(df, "k", "n", 3).collect()] == ["d", "b", "c"]
    assert "TakeOrderedAndProject" in plan(top_k(df, "k", "n", 3))


def test_absent_rows_by_both_plans(spark):
    rows_in = spark.createDataFrame([(n, n * 2) for n in range(50)], "k int, v int")
    target = spark.range(0, 40, 2).select(F.col("id").cast("int").alias("k"))
    want = {(n, n * 2) for n in range(50) if n >= 40 or n % 2}
    assert rows(absent_rows(rows_in, target, "k")) == want
    assert rows(absent_rows(rows_in, target, "k", max_rows=50)) == want
    assert rows(absent_rows(rows_in, target, "k", max_rows=50, max_broadcast_keys=10)) == want


def test_overlapping_ranges_are_refused(spark):
    """Equal, nested, crossing and touching ranges, within a bucket and across several."""
    rng = random.Random(3)
    schema = "ip_from bigint, ip_to bigint, country string, region string, city string"
    base = 1 << 24
    for _ in range(25):
        ranges = []
        for _ in range(rng.randint(1, 5)):
            low = base + rng.randint(0, 300_000)
            ranges.append((low, low + rng.choice([0, 1, 500, 70_000, 200_000])))
        clash = any(
            a[0] <= b[1] and b[0] <= a[1] for i, a in enumerate(ranges) for b in ranges[:i]
        )
        table = spark.createDataFrame([(*r, "c", "r", "t") for r in ranges], schema)
        assert bool(overlaps(table).collect()) == clash, ranges
    nested = spark.createDataFrame([(0, 9, "a", "a", "a"), (3, 4, "b", "b", "b")], schema)
    with pytest.raises(ValueError, match="overlap"):
        geo_table(nested)
    touching = spark.createDataFrame([(0, 9, "a", "a", "a"), (10, 14, "b", "b", "b")], schema)
    assert geo_table(touching).small
