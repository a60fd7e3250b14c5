"""Stream health against counts worked out by hand or by a loop."""

import random

from conftest import rows
from pyspark.sql import functions as F

from clickstar.plans import health

START = 1704067200


def log(spark, entries):
    df = spark.createDataFrame(entries, "topic string, partition int, offset bigint, s bigint")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def samples(spark, entries):
    df = spark.createDataFrame(
        entries,
        "job string, instance string, metric string, labels map<string,string>, s bigint, "
        "sample_id bigint, value bigint",
    )
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def test_rates(spark):
    entries = [("t", n % 2, n, START + n * 10) for n in range(12)] + [("u", 0, 0, START + 65)]
    messages = log(spark, entries)
    assert rows(health.messages_per_second(messages)) == {
        ("t", START, 0.1),
        ("t", START + 60, 0.1),
        ("u", START + 60, 1 / 60),
    }
    per_minute = {(r[0], r[1]): r[2] for r in health.messages_per_minute(messages).collect()}
    assert per_minute[("t", START)] == 12 / 5
    assert per_minute[("t", START - 240)] == 6 / 5
    assert per_minute[("t", START + 60)] == 6 / 5
    assert len([k for k in per_minute if k[0] == "t"]) == 6
    assert rows(health.partitions_per_topic(messages)) == {("t", 2), ("u", 1)}


def test_lag_counts_only_partitions_a_group_reads(spark):
    messages = log(spark, [("t", p, n, START) for p in range(2) for n in range(10)])
    commits = spark.createDataFrame(
        [("g", "t", 0, 4, START), ("g", "t", 0, 7, START + 9), ("h", "t", 0, 10, START), ("h", "t", 1, 1, START)],
        "group_id string, topic string, partition int, committed_offset bigint, s bigint",
    ).withColumn("timestamp", F.timestamp_seconds("s"))
    assert rows(health.consumer_lag(messages, commits)) == {("g", "t", 3), ("h", "t", 9)}
    assert rows(health.consume_rate(commits)) == {("g", "t", START, 3 / 60), ("h", "t", START, 0.0)}


def test_consume_rates_add_up_to_what_was_committed(spark):
    rng = random.Random(4)
    entries, grown = [], {}
    for group in "gh":
        for partition in range(3):
            offset, second = rng.randint(0, 9), START + rng.randint(0, 50)
            first = offset
            for _ in range(40):
                entries.append((group, "t", partition, offset, second))
                grown[group, partition] = offset - first
                offset, second = offset + rng.randint(0, 9), second + rng.choice([1, 20, 130])
    rng.shuffle(entries)
    commits = spark.createDataFrame(
        entries, "group_id string, topic string, partition int, committed_offset bigint, s bigint"
    ).withColumn("timestamp", F.timestamp_seconds("s"))
    total = {"g": 0.0, "h": 0.0}
    for r in health.consume_rate(commits).collect():
        total[r["group_id"]] += r["per_second"] * 60
    for group in "gh":
        assert abs(total[group] - sum(grown[group, p] for p in range(3))) < 1e-6


def test_counter_rate_equals_a_loop_over_each_series(spark):
    rng = random.Random(5)
    entries, want = [], {}
    for instance in "ab":
        for area in ("heap", "nonheap"):
            value, last, second = 0, None, START + rng.randint(0, 50)
            for sample in range(150):
                value = rng.randint(0, 3) if rng.random() < 0.1 else value + rng.randint(0, 9)
                grown = 0 if last is None else value if value < last else value - last
                minute = second - second % 60
                want[(instance, minute)] = want.get((instance, minute), 0) + grown
                entries.append(("j", instance, "c", {"area": area}, second, sample, value))
                last, second = value, second + rng.choice([0, 15, 15, 100])
    rng.shuffle(entries)
    got = health.counter_rate(samples(spark, entries), "c")
    assert rows(got) == {("j", i, m, total / 60) for (i, m), total in want.items()}


def test_label_order_does_not_make_a_series(spark):
    entries = [
        ("j", "a", "g", {"x": "1", "y": "2"}, START, 1, 5),
        ("j", "a", "g", {"y": "2", "x": "1"}, START + 1, 2, 7),
        ("j", "b", "g", {"x": "1", "y": "2"}, START + 1, 3, 30),
    ]
    assert rows(health.gauge_sum(samples(spark, entries))) == {("j", "g", START, 37)}


def test_alerts(spark):
    entries = [
        ("high", "a", "used", {}, START, 1, 95),
        ("high", "a", "total", {}, START, 2, 100),
        ("low", "a", "used", {}, START, 3, 90),
        ("low", "a", "total", {}, START, 4, 100),
        ("none", "a", "used", {}, START, 5, 9),
        ("none", "a", "total", {}, START, 6, 0),
    ]
    assert rows(health.usage_alerts(samples(spark, entries), "used", "total")) == {("high", START, 0.95)}


def test_canary(spark):
    sent = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100), ("c", 101)], "message_id string, sent_sec bigint")
    received = spark.createDataFrame(
        [("a", 140), ("a", 110), ("b", 111), ("z", 100)], "message_id string, recv_sec bigint"
    )
    assert rows(health.canary_roundtrip(sent, received)) == {
        ("a", "OK", 10),
        ("b", "LATE", 11),
        ("c", "MISSING", None),
    }


def test_rates_run_on_a_stream(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, [("t", 0, n, START + n * 20) for n in range(6)]).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    for name, rate in [("sec", health.messages_per_second), ("min", health.messages_per_minute)]:
        query = (
            rate(stream).writeStream.format("memory").queryName(name).outputMode("complete")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert rows(spark.table(name)) == rows(rate(spark.read.parquet(path)))
