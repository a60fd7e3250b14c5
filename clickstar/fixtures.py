"""Views that give the test tables the shape of the inputs: events, ranges, logs, samples.

The same views exist as SQL in `oracles.py`; both must give the same rows. Here numbering rows
within a group is done bucket by bucket, and derived keys meet small bounded sides, so the views
hold up on large tables too.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


BRAND_PREFIX = "brand-"
AS_OF = dt.date(2024, 1, 15)
DOMAIN_COUNTRY = "cl"

# Agents as browsers send them, and one that is none.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.1.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:11.0) like Gecko",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/14.1 Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36 Edg/91.0.864.59",
    "Mozilla/5.0 (Linux; Android 11; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.120 Mobile Safari/537.36",
    "invalid-user-agent",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.124 Safari/537.36 OPR/77.0.4054.172",
    "Mozilla/5.0 (Linux; Android 11; SM-G991B) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/14.2 Chrome/87.0.4280.141 Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) FxiOS/34.0 Mobile/15E148 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/91.0.4472.80 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Android 11; Mobile; rv:89.0) Gecko/89.0 Firefox/89.0",
    "Mozilla/5.0 (Linux; U; Android 10; en-US; RMX1825) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.3904.108 UCBrowser/13.4.0.1306 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.4430.212 YaBrowser/21.5.3 Yowser/2.5 Safari/537.36",
    "Opera/9.80 (Android; Opera Mini/36.2.2254/119.132; U; en) Presto/2.12.423 Version/12.16",
    "Mozilla/5.0 (Linux; U; Android 4.0.3; en-us; GT-P5100) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Safari/534.30",
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS;FBAV/323.0.0.43.119]",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 Instagram 192.0.0.37.119",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148",
    "Mozilla/5.0 (Linux; Android 11; Pixel 4; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/91.0.4472.120 Mobile Safari/537.36",
    "Mozilla/5.0 (X11; CrOS x86_64 13904.55.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.147 Safari/537.36",
    "Mozilla/5.0 (Mobile; Windows Phone 8.1; Android 4.0; ARM; Trident/7.0; Touch; rv:11.0; IEMobile/11.0; NOKIA; Lumia 520) like iPhone OS 7_0_3 Mac OS X AppleWebKit/537 (KHTML, like Gecko) Mobile Safari/537",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.4472.114 Safari/537.36 Vivaldi/4.0",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.0",
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/87.0.4280.66 QQBrowser/10.7 Safari/537.36",
    None,
]

# Agents whose versions, {v} and {w}, differ from event to event.
VERSIONED_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_{w}) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/{v}.{w}.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7; wv) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/{v}.{w}.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) CriOS/{v}.{w}.0 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/{v}.{w} Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) FxiOS/{v}.{w} Mobile/15E148 Safari/605.1.15",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) EdgiOS/{v}.{w}.0 Version/15.0 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) GSA/{v}.{w}.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 Instagram {v}.{w}.0.1",
    "Mozilla/5.0 (iPhone; CPU iPhone OS {v}_{w} like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Mobile/15E148 [FBAN/FBIOS;FBAV/{v}.{w}.0.1]",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_{w}) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/{v}.{w} Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64; rv:{v}.{w}) Gecko/20100101 Firefox/{v}.{w}",
    "Mozilla/5.0 (X11; Fedora; Linux x86_64; rv:{v}.{w}) Gecko/20100101 Firefox/{v}.{w}",
    "Mozilla/5.0 (Android 1{w}; Mobile; rv:{v}.{w}) Gecko/{v}.{w} Firefox/{v}.{w}",
    "Mozilla/5.0 (Windows NT 6.1; rv:52.9) Gecko/20100101 PaleMoon/{v}.{w}.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 Edg/{v}.{w}.864.59",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Mobile Safari/537.36 EdgA/{v}.{w}.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 OPR/{v}.{w}.4054.172",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Mobile Safari/537.36 OPR/{v}.{w}.1",
    "Opera/9.80 (Android; Opera Mini/{v}.{w}.2254/119.132; U; en) Presto/2.12.423 Version/12.16",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) SamsungBrowser/{v}.{w} Chrome/87.0.1.1 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.1.1 UCBrowser/{v}.{w}.0.1306 Mobile Safari/537.36",
    "Mozilla/5.0 (Linux; Android 1{w}; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) Version/4.0 Chrome/78.0.1.1 MiuiBrowser/{v}.{w}.1 Mobile Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 YaBrowser/{v}.{w}.3 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/90.0.1.1 Safari/537.36 Vivaldi/{v}.{w}",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/87.0.1.1 QQBrowser/{v}.{w} Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) HeadlessChrome/{v}.{w}.1.1 Safari/537.36",
    "Mozilla/5.0 (X11; CrOS x86_64 {v}.{w}.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/91.0.1.1 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:{v}.{w}) like Gecko",
    "Mozilla/4.0 (compatible; MSIE {v}.{w}; Windows NT 5.1)",
    "Mozilla/5.0 (Mobile; Windows Phone 8.{w}; Android 4.0; Trident/7.0; IEMobile/{v}.{w}) like iPhone Gecko",
    "Mozilla/5.0 (Linux; U; Android 4.{w}; en-us; GT-P5100) AppleWebKit/534.30 (KHTML, like Gecko) Version/4.0 Safari/534.30",
    "Mozilla/5.0 (Mobile; Nokia 8110; rv:48.0) Gecko/48.0 Firefox/{v}.{w} KAIOS/2.{w}",
    "Mozilla/5.0 (SMART-TV; LINUX; Tizen {v}.{w}) AppleWebKit/537.36 (KHTML, like Gecko) Version/{v}.{w} TV Safari/537.36",
    "Mozilla/5.0 (compatible; Googlebot/{v}.{w}; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (compatible; bingbot/{v}.{w}; +http://www.bing.com/bingbot.htm)",
    "Googlebot-Image/{v}.{w}",
    "curl/{v}.{w}.0",
    "python-requests/{v}.{w}.1",
    "device {v} of no kind",
]

# Fixed values of the views.
_RANGE_BLOCKS = 4096
_FILE_EVENTS = 100_000
LOG_START = 1704067200  # 2024-01-01T00:00:00Z
_LOG_SECOND_MICROS = 720_000_000  # 30 days told in an hour

# The columns the views use; a stated schema saves a job that would read it from the files.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "part": "p_partkey bigint, p_name string",
    "pages": "page_id bigint, url string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Microseconds since the epoch of a zone-less time, whatever the session's zone.
_MICROS = """
  (unix_date(CAST(ts AS DATE)) * 86400 + hour(ts) * 3600 + minute(ts) * 60) * 1000000L
  + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT)
"""

# Event fields from a row of events with p_name and url joined.
_EVENT_FIELDS = {
    "id": "concat('evt-', event_id)",
    "collection": """
      CASE event_type
        WHEN 'view' THEN 'view_product_detail'
        WHEN 'click' THEN if(event_id % 2 = 0, 'select_product_option', 'select_product_option_quality')
        WHEN 'purchase' THEN concat('product_detail_recommendation_',
          element_at(array('visible', 'noticed', 'clicked'), CAST(event_id % 3 + 1 AS INT)))
        WHEN 'signup' THEN 'checkout' END""",
    "time_stamp": "micros DIV 1000000",
    "product_id": """
      CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 77 = 0 THEN 'n/a'
        ELSE CAST(p_partkey AS STRING) END""",
    "viewing_product_id": """
      CASE WHEN event_type = 'purchase' AND event_id % 4 <> 0
        THEN CAST(event_id * 17 % products AS STRING) END""",
    "store_id": "CASE WHEN event_id % 97 <> 0 THEN CAST(user_id % 12 AS STRING) END",
    "ip": """
      CASE WHEN event_id % 101 = 0 THEN '0.0.0.0' WHEN event_id % 103 = 0 THEN 'unknown'
        WHEN event_id % 107 = 0 THEN '' WHEN event_id % 109 = 0 THEN '999.1.2.3'
        ELSE concat_ws('.', 1 + user_id * 37 % 223, user_id * 91 % 256, event_id % 256, 7) END""",
    "user_agent": "CASE WHEN event_id % 89 <> 0 THEN agent END",
    "referrer_url": "CASE WHEN event_id % 10 <> 0 THEN url END",
    "current_url": """
      concat('https://www.shop.',
        element_at(array('fr', 'de', 'es', 'co.uk', 'com', 'it', 'cl', 'com.au'),
          CAST(user_id % 8 + 1 AS INT)),
        CASE event_id % 5
          WHEN 0 THEN concat('/brand-', slug, '-sku', p_partkey, '.html?alloy=white-375')
          WHEN 1 THEN concat('/', slug, '.html')
          WHEN 2 THEN concat('/', slug)
          WHEN 3 THEN concat('/', slug, '/')
          ELSE concat('/ring-18k?stone2=diamond-', event_id % 7) END)""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _size(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table, as its files' footers tell."""
    return max(1, table(spark, sf_dir, name).count())


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in parsed shape, one in twenty delivered twice."""
    return _deliveries(spark, sf_dir).drop("delivery")


def _deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the number of the delivery.

    Products and referrers are dealt over all rows of their tables.
    """
    products = _size(spark, sf_dir, "part")
    referrers = _size(spark, sf_dir, "pages")
    slugs = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "replace(lower(p_name), ' ', '-') AS slug"
    )
    agents = F.array(*map(F.lit, USER_AGENTS))
    delivered = (
        table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            "user_id",
            "event_type",
            f"{_MICROS} AS micros",
            f"event_id * 31 % {products} AS p_partkey",
            f"event_id % {referrers} AS page_id",
            f"{products} AS products",
            "explode(if(event_id % 20 = 0, array(1, 2), array(1))) AS delivery",
        )
        .withColumn("agent", F.get(agents, F.col("user_id") % len(USER_AGENTS)))
    )
    return (
        delivered.join(slugs, "p_partkey")
        .join(table(spark, sf_dir, "pages"), "page_id", "left")
        .selectExpr(*[f"{field} AS {name}" for name, field in _EVENT_FIELDS.items()], "delivery")
    )


# Suffixes of hosts.
HOST_SUFFIXES = [
    "fr", "co.uk", "com", "eu", "io", "uk", "uk.com", "zz", "com.au", "de.com", "eu.int", "GB", "de", "notuk.com",
]


def shop_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of shops under many suffixes."""
    suffix = F.get(
        F.array(*map(F.lit, HOST_SUFFIXES)), (F.col("event_id") % len(HOST_SUFFIXES)).cast("int")
    )
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("https://shop"), F.col("user_id").cast("string"), F.lit("."), suffix, F.lit("/a.b/c.fr")).alias("url"),
    )


def geo6_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv6 ranges in 64 blocks below 2a00::, of sizes from a whole block to a 2^80 network, with gaps."""
    block, part = F.col("block"), F.col("part")
    kind = block % 4
    parts = F.element_at(F.array(F.lit(1), F.lit(16), F.lit(256), F.lit(1024)), (kind + 1).cast("int"))
    cut = spark.range(64, numPartitions=1).select(F.col("id").alias("block")).select(
        "block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")
    )
    present = (
        (kind == 0)
        | ((kind == 1) & (part % 5 != 4))
        | ((kind == 2) & (part % 7 != 6))
        | ((kind == 3) & (part % 4 != 3))
    )
    # The second and third group of the first address, and of the last.
    size = F.element_at(F.array(F.lit(65536), F.lit(4096), F.lit(256), F.lit(1)), (kind + 1).cast("int"))
    low = F.when(kind == 3, F.floor(part / 16)).otherwise(part * size)
    high = F.when(kind == 3, F.floor(part / 16)).otherwise(part * size + size - 1)
    third = F.when(kind == 3, part % 16)
    head = F.lower(F.hex(block + 0x2A00))
    start = F.concat_ws(":", head, F.lower(F.hex(low)), F.coalesce(F.lower(F.hex(third)), F.lit("0")))
    end = F.concat_ws(":", head, F.lower(F.hex(high)), F.coalesce(F.lower(F.hex(third)), F.lit("ffff")))
    nations = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        cut.where(present)
        .withColumn("number", block * 1024 + part)
        .join(F.broadcast(nations), F.col("n_nationkey") == F.col("number") % 25)
        .select(
            F.concat(start, F.lit("::")).alias("ip_from"),
            F.concat(end, F.lit(":ffff:ffff:ffff:ffff:ffff")).alias("ip_to"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.concat(F.lit("city6_"), F.col("number").cast("string")).alias("city"),
        )
    )


def mixed_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv4 and IPv6 addresses, the latter in all the ways they are written, and some that are none."""
    event, user = F.col("event_id"), F.col("user_id")
    head = F.lower(F.hex(user % 64 + 0x2A00))
    second = F.when(user % 4 == 3, user * 37 % 64).otherwise(user * 37 % 65536)
    hexed = [head, *[F.lower(F.hex(c)) for c in (second, event % 16)]]
    own = event % 65536
    short = F.concat(F.concat_ws(":", *hexed), F.lit("::"), F.lower(F.hex(own)))
    padded = [F.lpad(c, 4, "0") for c in hexed]
    whole = F.concat_ws(":", *padded, *[F.lit("0000")] * 4, F.lower(F.lpad(F.hex(own), 4, "0")))
    tail = F.concat(F.concat_ws(":", *hexed), F.lit("::1.2.3."), (event % 256).cast("string"))
    four = F.concat_ws(
        ".", *[c.cast("string") for c in (user * 37 % 223 + 1, user * 91 % 256, event % 256, F.lit(7))]
    )
    way = event % 10
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), event.cast("string")).alias("event_id"),
        F.when(event % 101 == 0, F.lit("2a00:1:2"))
        .when(event % 103 == 0, F.lit("2a00::1::2"))
        .when(way == 0, F.upper(short))
        .when(way == 1, whole)
        .when(way == 2, F.concat(short, F.lit("%eth0")))
        .when(way == 3, tail)
        .when(way == 4, short)
        .when(way == 5, F.concat(F.lit("::ffff:"), four))
        .otherwise(four)
        .alias("ip"),
    )


def versioned_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with some thousands of different agents, one event in 41 without."""
    agents = F.get(
        F.array(*map(F.lit, VERSIONED_AGENTS)), (F.col("event_id") % len(VERSIONED_AGENTS)).cast("int")
    )
    major = (F.col("user_id") % 60 + 40).cast("string")
    minor = (F.col("event_id") % 10).cast("string")
    agent = F.replace(F.replace(agents, F.lit("{v}"), major), F.lit("{w}"), minor)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(F.col("event_id") % 41 != 0, agent).alias("user_agent"),
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON text, as a topic would hold them."""
    return _delivered_messages(spark, sf_dir).select("value")


def _delivered_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.to_json(F.struct(*_EVENT_FIELDS)).alias("value")
    return _deliveries(spark, sf_dir).select(message, "delivery")


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a heartbeat for each signup in between, as a shared topic has them."""
    return _topic_deliveries(spark, sf_dir).select("value")


def _topic_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.timestamp_seconds("sent_sec").cast("string")
    beats = canary_sent(spark, sf_dir).select(
        F.to_json(
            F.struct(
                "message_id",
                F.lit("heartbeat").alias("message"),
                seconds.alias("timestamp"),
                F.lit("canary").alias("type"),
            )
        ).alias("value"),
        F.lit(1).alias("delivery"),
    )
    return _delivered_messages(spark, sf_dir).unionByName(beats)


def message_files(spark: SparkSession, sf_dir: str) -> int:
    """Files of some `_FILE_EVENTS` events that hold a quarter of them."""
    return -(-_size(spark, sf_dir, "events") // (4 * _FILE_EVENTS))


def dealt_messages(spark: SparkSession, sf_dir: str, files: int) -> DataFrame:
    """The topic's messages dealt to so many files, an event's deliveries apart. Dealt by hash, which
    sorts no messages and has as many tasks as files."""
    return _topic_deliveries(spark, sf_dir).repartition(files, "value", "delivery").select("value")


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges without overlap, with gaps within and between blocks."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation").join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    )
    blocks = spark.range(_RANGE_BLOCKS, numPartitions=1).where("id % 16 <> 0")
    return blocks.join(F.broadcast(nation), F.col("n_nationkey") == F.col("id") % 25).selectExpr(
        "id * 1048576 + (id % 7) * 1000 AS ip_from",
        "(id + 1) * 1048576 - 1 AS ip_to",
        "n_name AS country",
        "r_name AS region",
        "concat('city_', id % 101) AS city",
    )


def _numbered(events: DataFrame, group: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 within a group by (ts, event_id).

    Ranked within each hour, plus the rows of the hours before: the groups are few and large,
    and one task could not sort a whole one.
    """
    hour = [*group, "_hour"]
    hourly = events.withColumn("_hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    before = W.partitionBy(*group).orderBy("_hour").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        hourly.groupBy(*hour)
        .agg(F.count("*").alias("_n"))
        .select(*hour, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    rank = F.row_number().over(W.partitionBy(*hour).orderBy("ts", "event_id"))
    return (
        hourly.join(starts, hour)
        .withColumn(name, F.col("_start") + rank - 1)
        .drop("_hour", "_start")
    )


# Time of a log entry, in epoch seconds.
_LOG_SECOND = f"{LOG_START} + floor(({_MICROS} - {LOG_START}000000) / {_LOG_SECOND_MICROS})"


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, partition, offset and time of each message."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        "ts",
        "event_id",
    )
    return _numbered(events, ["topic", "partition"], "offset").select(
        "topic", "partition", "offset", F.expr(f"timestamp_seconds({_LOG_SECOND})").alias("timestamp")
    )


def group_commits(log: DataFrame) -> DataFrame:
    """Commits after every tenth message; g0 reads all partitions, g1 all but 2."""
    groups = F.when(F.col("partition") == 2, F.array(F.lit("g0"))).otherwise(
        F.array(F.lit("g0"), F.lit("g1"))
    )
    return log.where(F.col("offset") % 10 == 9).select(
        F.explode(groups).alias("group_id"),
        "topic",
        "partition",
        (F.col("offset") + 1).alias("committed_offset"),
        (F.col("timestamp") + F.expr("INTERVAL 5 SECONDS")).alias("timestamp"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter that resets and two gauges, per instance and memory area."""
    events = table(spark, sf_dir, "events").select(
        "event_id", (F.col("user_id") % 4).alias("_instance"), "ts", "value"
    )
    numbered = _numbered(events, ["_instance"], "_n")
    values = {
        "cpu_halfseconds_total": (F.col("_n") + 1) % 200,
        "memory_used": F.round(F.col("value") * 100).cast("bigint"),
        "memory_max": F.lit(30000).cast("bigint"),
    }
    metrics = F.array(
        *[F.struct(F.lit(name).alias("metric"), v.alias("value")) for name, v in values.items()]
    )
    return numbered.select(
        F.col("event_id").alias("sample_id"),
        F.lit("worker").alias("job"),
        F.col("_instance").cast("string").alias("instance"),
        F.expr("map('area', if(event_id % 2 = 0, 'heap', 'nonheap'))").alias("labels"),
        F.expr(f"timestamp_seconds({_LOG_SECOND})").alias("timestamp"),
        F.inline(metrics),
    )


def canary_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return events.selectExpr(
        "concat('m-', event_id) AS message_id", f"({_MICROS}) DIV 1000000 AS sent_sec"
    )


def canary_received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in thirteen lost, some late, some that are no heartbeats."""
    events = table(spark, sf_dir, "events").where(
        "event_type IN ('signup', 'error') AND event_id % 13 <> 0"
    )
    return events.selectExpr(
        "concat(if(event_type = 'signup', 'm-', 'x-'), event_id) AS message_id",
        f"({_MICROS}) DIV 1000000 + event_id % 15 AS recv_sec",
    )
