"""Column functions: known cases, empty and dirty input, and models in plain Python."""

import ipaddress
import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickstar.functions import agent, keys, net, time, url


def values(spark, column, inputs, kind="string"):
    """Results of a column expression over c, in input order."""
    data = spark.createDataFrame(list(enumerate(inputs)), f"n int, c {kind}")
    return [row[0] for row in data.orderBy("n").select(column).collect()]


# Documented cases.
PRODUCT_CASES = {
    "/brand-diamond-ring-sku123": "Diamond Ring",
    "/wedding-band.html": "Wedding Band",
    "/engagement-ring/": "Unknown",
    "invalid-url": "Invalid Url",
    "": "Unknown",
    None: "Unknown",
    "https://www.shop.fr": "Www.Shop.Fr",
    "https://www.shop.fr/": "Unknown",
    "https://www.shop.fr/ring?alloy=white-375": "Alloy=White 375",
    "/ring-18k": "Ring 18K",
    "/brand-.html": ".Html",
    "/a//b-sku1/c": "B",
    "/ring%20a.html": "Ring%20A",
    "/-sku9": " Sku9",
    "/écru-bague.html": "Écru Bague",
}


def test_product_name_cases(spark):
    got = values(spark, url.product_name(F.col("c"), "brand-"), PRODUCT_CASES)
    assert dict(zip(PRODUCT_CASES, got)) == PRODUCT_CASES


def test_product_name_of_random_addresses(spark):
    """Words with a capital first and no other, and none of the signs that end a name."""
    rng = random.Random(7)
    pieces = ["/", "?", "-", "brand-", "-sku", ".html", "ring", "18k", "é", "=", " ", "A", "x1y"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(3000)]
    got = values(spark, url.product_name(F.col("c"), "brand-"), texts)
    for text, name in zip(texts, got):
        assert name and not set(name) & set("/?-"), text
        assert "Sku" not in name.split("-")[0] or "sku" in text.lower()
        for word in re.findall(r"[^\W\d_]+", name):
            assert word[0] == word[0].upper() and word[1:] == word[1:].lower(), text


def test_product_name_without_brand(spark):
    assert values(spark, url.product_name(F.col("c")), ["/brand-ring.html"]) == ["Brand Ring"]


def test_domain(spark):
    cases = {
        "https://www.shop.cl/a?b=|c{": ("www.shop.cl", "cl", "cl"),
        "HTTPS://WWW.Shop.CO.UK:443/x": ("www.shop.co.uk", "uk", "uk"),
        "https://shop.com/": ("shop.com", "com", None),
        "http://user:pw@shop.de": ("shop.de", "de", "de"),
        "http://10.0.0.7/": ("10.0.0.7", "7", None),
        "/no-host": (None, None, None),
        "": (None, None, None),
        None: (None, None, None),
    }
    c = F.col("c")
    got = values(
        spark,
        F.struct(url.url_host(c), url.domain_label(c), url.domain_country(c)),
        cases,
    )
    assert dict(zip(cases, map(tuple, got))) == cases


WINDOWS_CHROME = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/91.0.4472.124 Safari/537.36"
)
AGENT_CASES = {
    WINDOWS_CHROME: ("Chrome", "Windows"),
    WINDOWS_CHROME + " Edg/91.0": ("Edge", "Windows"),
    WINDOWS_CHROME + " OPR/77.0": ("Opera", "Windows"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6) AppleWebKit/605.1.15 Safari/604.1": ("Mobile Safari", "iOS"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X)": ("Unknown", "iOS"),
    "Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:11.0) like Gecko": ("IE", "Windows"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) Version/14.1 Safari/605.1": ("Safari", "Mac OS X"),
    "Mozilla/5.0 (X11; Linux x86_64)": ("Unknown", "Linux"),
    "Mozilla/5.0 (X11; CrOS x86_64) Chrome/90.0 Safari/537.36": ("Chrome", "Chrome OS"),
    "Mozilla/5.0 (Linux; Android 11) Chrome/91.0 Mobile Safari/537.36": ("Chrome Mobile", "Android"),
    "Mozilla/5.0 (X11; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.0": ("Firefox", "Linux"),
    "invalid-user-agent": ("Unknown", "Unknown"),
    "": ("Unknown", "Unknown"),
    None: ("Unknown", "Unknown"),
}


def test_agent_cases(spark):
    c = F.col("c")
    got = values(spark, F.struct(agent.browser_family(c), agent.os_family(c)), AGENT_CASES)
    assert dict(zip(AGENT_CASES, map(tuple, got))) == AGENT_CASES


def test_ip_to_long(spark):
    rng = random.Random(3)
    good = [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(300)]
    good += ["0.0.0.0", "255.255.255.255"]
    bad = ["", "unknown", "1.2.3", "1.2.3.4.5", "256.1.1.1", "1.2.3.4 ", "1.2.3.4\n", "::1", "a.b.c.d", None]
    assert values(spark, net.ip_to_long(F.col("c")), good + bad) == [
        int(ipaddress.IPv4Address(ip)) for ip in good
    ] + [None] * len(bad)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_time_is_the_same_in_every_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = [1716883882, 0, -1, 1735516800, 1730613600, None, 10**15, 253402300799]
        parts = time.hour_attributes(F.col("h"))
        table = (
            spark.createDataFrame([(s,) for s in seconds], "s bigint")
            .select("s", time.event_hour(F.col("s")).alias("h"))
            .select("s", *[parts[n].alias(n) for n in parts if n != "timestamp"])
        )
        got = {row[0]: tuple(row)[1:] for row in table.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[1716883882] == (2024052808, 8, 3, False, 28, 149, 4, 22, 5, 2, 2024)
    assert got[0] == (1970010100, 0, 5, False, 1, 1, 1, 1, 1, 1, 1970)
    assert got[-1] == (1969123123, 23, 4, False, 31, 365, 5, 1, 12, 4, 1969)
    assert got[1735516800][7:9] == (1, 12)  # 2024-12-30 is in week 1
    assert got[1730613600][0] == 2024110306
    assert got[253402300799][0] == 9999123123
    assert got[None] == got[10**15] == (None,) * 11


def test_event_date_and_its_hour_key_agree(spark):
    seconds = [1716883882, -1, None, 1704067199, 1704067200]
    data = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    key = time.hour_key(time.event_hour(F.col("s")))
    same = data.select(time.date_of_hour_key(key).eqNullSafe(time.event_date(F.col("s"))))
    assert rows(same.distinct()) == {(True,)}


def test_keys(spark):
    assert values(spark, keys.int_id(F.col("c")), ["85", "085", "n/a", "", None, "99999999999", "1.5"]) == [
        85, 85, None, None, None, None, None,
    ]
    assert values(spark, keys.store_name(F.col("c")), ["085", None]) == ["store_085", None]
    recommended = values(
        spark,
        keys.is_recommendation(F.col("c")),
        ["product_detail_recommendation_clicked", "view_product_detail", None],
    )
    assert recommended == [True, False, None]
    assert values(spark, keys.hash_key(F.col("c"), F.lit("b")), ["a", None]) == [
        "187ef4436122d1cc2f40dc2b92f0eba0", None,
    ]


def test_effective_product(spark):
    shown = "product_detail_recommendation_visible"
    events = spark.createDataFrame(
        [
            (1, shown, "5", "7"),
            (2, shown, "5", None),
            (3, "view_product_detail", "5", "7"),
            (4, shown, None, "x"),
            (5, None, "5", "7"),
        ],
        "n int, collection string, product_id string, viewing_product_id string",
    )
    product = keys.effective_product_id(
        F.col("collection"), F.col("product_id"), F.col("viewing_product_id")
    )
    assert rows(events.select("n", product)) == {(1, 7), (2, 5), (3, 5), (4, None), (5, 5)}
