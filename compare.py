"""Native expressions and the bucketed range join beside the row-at-a-time way of doing the same.

python compare.py [copies]  — events of $BENCH_SF_DIR, each `copies` times under its own id,
written once to the shared folder; prints seconds and events per second.
"""

from __future__ import annotations

import bisect
import os
import re
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar import fixtures as fx
from clickstar.operators.geo import geo_table, locate
from clickstar.plans import kpi, star
from clickstar.plans.enrich import enrich
from clickstar.runtime import scratch_path, session
from clickstar.schema import FACT
from clickstar.sources.messages import accepted_events
from clickstar.sources.warehouse import read_warehouse

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def by_python_udfs(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Browser, system and place, one Python call per value."""
    table = sorted(tuple(row) for row in ranges.collect())
    starts = [row[0] for row in table]

    def place(field):
        @F.udf("string")
        def lookup(ip):
            if not ip or ip in ("unknown", "0.0.0.0"):
                return "Unknown"
            octets = ip.split(".")
            if len(octets) != 4 or not all(o.isdigit() and int(o) < 256 for o in octets):
                return "Unknown"
            number = sum(int(o) << shift for o, shift in zip(octets, (24, 16, 8, 0)))
            at = bisect.bisect_right(starts, number) - 1
            return table[at][field] if at >= 0 and number <= table[at][1] else "Unknown"

        return lookup

    browsers = [
        (re.compile(pattern), name)
        for pattern, name in [
            ("Edg(e|A|iOS)?/", "Edge"), ("Trident/|MSIE ", "IE"), ("Firefox/", "Firefox"),
            ("Chrome/.*Mobile", "Chrome Mobile"), ("Chrome/", "Chrome"),
            ("(iPhone|iPad|iPod).*Safari/", "Mobile Safari"), ("Safari/", "Safari"),
        ]
    ]
    systems = [
        (re.compile(pattern), name)
        for pattern, name in [
            ("Windows", "Windows"), ("iPhone|iPad|iPod", "iOS"), ("Android", "Android"),
            ("CrOS", "Chrome OS"), ("Mac OS X", "Mac OS X"), ("Linux", "Linux"),
        ]
    ]

    def family(rules):
        @F.udf("string")
        def match(text):
            return next((name for rule, name in rules if text and rule.search(text)), "Unknown")

        return match

    return events.select(
        "id",
        family(browsers)("user_agent").alias("browser"),
        family(systems)("user_agent").alias("os"),
        place(4)("ip").alias("city"),
        place(3)("ip").alias("region"),
        place(2)("ip").alias("country"),
    )


def natively(events: DataFrame, ranges: DataFrame) -> DataFrame:
    from clickstar.functions.agent import browser_family, os_family

    return locate(events, geo_table(ranges)).select(
        "id",
        browser_family(F.col("user_agent")).alias("browser"),
        os_family(F.col("user_agent")).alias("os"),
        "city",
        "region",
        "country",
    )


def by_nested_loop(events: DataFrame, ranges: DataFrame) -> DataFrame:
    from clickstar.functions.net import locatable_ip

    number = events.select("id", locatable_ip(F.col("ip")).alias("n"))
    return number.join(
        F.broadcast(ranges), F.col("n").between(F.col("ip_from"), F.col("ip_to")), "left"
    )


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 1
    spark = session(
        "compare",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": str(4 * int(CPUS)),
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = scratch_path(spark, "events")
    copied = fx.raw_events(spark, SF_DIR).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
    )
    copied.withColumn("id", F.concat_ws("-", "id", "copy")).drop("copy").repartition(
        2 * int(CPUS)
    ).write.parquet(path)
    events = spark.read.parquet(path)
    total = events.count()
    ranges_path = scratch_path(spark, "ranges")
    fx.geo_ranges(spark, SF_DIR).write.parquet(ranges_path)
    ranges = spark.read.parquet(ranges_path)
    warehouse = scratch_path(spark, "warehouse")

    def build() -> None:
        star.build_warehouse(
            spark, accepted_events(events), geo_table(ranges), warehouse,
            scratch_path(spark, "stage"), fx.BRAND_PREFIX,
        )

    large = geo_table(ranges, max_broadcast_bytes=0)
    work = {
        "scalars and place, native": lambda: drain(natively(events, ranges)),
        "scalars and place, Python UDFs": lambda: drain(by_python_udfs(events, ranges)),
        "place, bucketed broadcast": lambda: drain(locate(events, geo_table(ranges))),
        "place, bucketed shuffle": lambda: drain(locate(events, large)),
        "place, nested loop": lambda: drain(by_nested_loop(events, ranges)),
        "enrich": lambda: drain(enrich(accepted_events(events), geo_table(ranges))),
        "fact": lambda: drain(
            star.fact_view_event(enrich(accepted_events(events), geo_table(ranges)))
        ),
        "warehouse": build,
        "top products of a day, stored": lambda: drain(
            kpi.top_products(read_warehouse(spark, warehouse)[FACT], fx.AS_OF)
        ),
        "star join, stored": lambda: drain(star.star_join(read_warehouse(spark, warehouse))),
    }
    print(f"{total} events")
    for name, run in work.items():
        if name.endswith("nested loop") and copies > 5:
            continue
        run()
        start = time.perf_counter()
        run()
        spent = time.perf_counter() - start
        print(f"{name:34} {spent:8.2f} s {total / spent:12,.0f} events/s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
