"""IPv6 addresses and ranges, countries of domains, devices of agents."""

import ipaddress
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickstar import fixtures as fx
from clickstar.functions import net, url
from clickstar.operators import devices
from clickstar.operators.geo import geo_table
from clickstar.operators.geo6 import geo6_table, locate_any

ODD = """:: ::1 1:: 2a00:1:2::3 2A00::FFFF%eth0 ::ffff:1.2.3.4 1:2:3:4:5:6:7:8 1:2:3:4:5:6:7:: ::2:3:4:5:6:7:8
1:2:3:4:5:6:1.2.3.4 64:ff9b::10.0.0.1 ::: 1::2::3 1:2:3 g::1 1:2:3:4:5:6:7:8:9 12345::1 1.2.3.4 : ::1.2.3
::1.2.3.256 1:2:3:4:5:6:7:8:: ::1:2:3:4:5:6:7:8 1:2:3:4:5:6:7:1.2.3.4 :1::2 1::2: 0:0::0:0""".split()


def digits(text):
    try:
        return f"{int(ipaddress.IPv6Address(text.split('%')[0])):032x}"
    except ValueError:
        return None


def test_ipv6_text(spark):
    rng = random.Random(6)
    texts = [*ODD, "", " ::1"]
    for _ in range(300):
        address = ipaddress.IPv6Address(rng.getrandbits(128) >> rng.choice([0, 16, 64, 100]))
        texts.append(rng.choice([str(address), address.exploded, str(address).upper()]))
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r[0]: r[1] for r in df.select("t", net.ipv6_hex(F.col("t"))).collect()}
    assert got == {None: None, **{t: digits(t) for t in texts}}
    mapped = df.where("t = '::ffff:1.2.3.4'").select(net.mapped_ipv4(net.ipv6_hex(F.col("t"))))
    assert mapped.first()[0] == 16909060


RANGES = [
    ("2a00::", "2a00:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "whole"),
    ("2a01::", "2a01:0fff:ffff:ffff:ffff:ffff:ffff:ffff", "sixteenth"),
    ("2a01:2000::", "2a01:20ff:ffff:ffff:ffff:ffff:ffff:ffff", "256 networks"),
    ("2a01:3000:5::", "2a01:3000:5:ffff:ffff:ffff:ffff:ffff", "network"),
    ("2a01:3000:6::10", "2a01:3000:6::1f", "sixteen"),
    ("2a01:3000:6::20", "2a01:3000:6::20", "one"),
    ("2a01:3000:7::", "2a01:3000:9::", "two and one"),
    ("ff00::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "last"),
    ("::2:0", "::2:ffff", ""),
]


@pytest.mark.parametrize("max_broadcast_bytes", [10**9, 0])
def test_places_of_ipv6_addresses(spark, max_broadcast_bytes):
    number = [(int(ipaddress.IPv6Address(a)), int(ipaddress.IPv6Address(b)), c) for a, b, c in RANGES]
    rng = random.Random(max_broadcast_bytes)
    asked = [n + d for a, b, _ in number for n in (a, b) for d in (-1, 0, 1) if 0 <= n + d < 2**128]
    asked += [rng.randint(a, b) for a, b, _ in number for _ in range(5)]
    asked = [n for n in asked if n >> 32 != 0xFFFF]
    want = {}
    for n in asked:
        city = next((c for a, b, c in number if a <= n <= b), "")
        want[str(ipaddress.IPv6Address(n))] = city or "Unknown"
    want |= {"1.2.3.4": "four", "::ffff:1.2.3.4": "four", "9.9.9.9": "Unknown", "": "Unknown", "x:y": "Unknown"}
    ranges = spark.createDataFrame([(*r, "r", "c") for r in RANGES], "ip_from string, ip_to string, city string, region string, country string")
    four = spark.createDataFrame([(16909060, 16909060, "c", "r", "four")], "ip_from long, ip_to long, country string, region string, city string")
    events = spark.createDataFrame([(t, 1) for t in [*want, None]], "ip string, n int")
    found = locate_any(
        events, geo_table(four, max_broadcast_bytes), geo6_table(ranges, max_broadcast_bytes)
    )
    assert found.columns == ["ip", "n", "city", "region", "country"]
    assert {r["ip"]: r["city"] for r in found.collect()} == {**want, None: "Unknown"}


def test_addresses_are_read_once_for_large_tables(spark, sf_dir):
    four = geo_table(fx.geo_ranges(spark, sf_dir), 0)
    found = locate_any(fx.mixed_addresses(spark, sf_dir), four, geo6_table(fx.geo6_ranges(spark, sf_dir), 0))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in plan and "split(" not in plan


def test_ranges_that_cannot_be_are_refused(spark):
    def table(*ends):
        return spark.createDataFrame([(a, b, "x", "x", "x") for a, b in ends], "ip_from string, ip_to string, city string, region string, country string")

    for ends in ([("1::", "x")], [("2::", "1::")]):
        with pytest.raises(ValueError, match="no range"):
            geo6_table(table(*ends))
    # One inside the other, at different widths; and side by side.
    with pytest.raises(ValueError, match="overlap"):
        geo6_table(table(("2a00::", "2a00:ffff::"), ("2a00:1:1::5", "2a00:1:1::6")))
    assert geo6_table(table(("2a00::", "2a00::5"), ("2a00::6", "2a00::7"))).widths == (12,)
    assert geo6_table(table()).widths == ()


def test_countries_of_suffixes(spark):
    cases = {
        "shop.co.uk": "uk", "uk": "uk", "a.uk.com": "uk", "uk.com": "uk", "notuk.com": None, "a.com": None,
        "x.eu": None, "x.io": "io", "x.zz": None, "x.GB.": "gb", "a.eu.int": None, "a.int": None, "x.de.com": "de",
        "10.0.0.7": None, "": None, "com.au": "au", "x.za.bz": "za", "x.bz": "bz", None: None,
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r[0]: r[1] for r in df.select("c", url.suffix_country(F.col("c"))).collect()}
    assert got == cases
    own = {"shop.co.uk": "c1", "b.uk": "c2", "a.de": "de"}
    hosts = spark.createDataFrame([(c,) for c in ["x.shop.co.uk", "a.b.uk", "z.uk", "a.de"]], "c string")
    got = [r[0] for r in hosts.select(url.suffix_country(F.col("c"), own)).collect()]
    assert got == ["c1", "c2", "uk", "de"]
    assert len(url.country_codes()) > 240 and url.country_codes()["fr"] == "France"


def test_the_host_is_looked_for_once(spark):
    pages = spark.createDataFrame([("https://x.fr/",)], "c string")
    plan = pages.select(url.domain_country(F.col("c")).alias("country"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 1


def test_devices_are_told_once_for_each_agent(spark):
    agents = {
        "Mozilla/5.0 (X11; Linux x86_64; rv:89.0) Gecko/20100101 Firefox/89.5": ("Firefox", "89.5", "Linux", None),
        "Googlebot/2.1": ("Googlebot", "2.1", "Unknown", None),
        "curl/8.1.2": ("curl", "8.1", "Unknown", None),
        "Mozilla/5.0 (Linux; Android 13; x) AppleWebKit/1 Chrome/9.8 Mobile Safari/1": ("Chrome Mobile", "9.8", "Android", "13"),
        "": ("Unknown", None, "Unknown", None),
        "?": ("Unknown", None, "Unknown", None),
    }
    events = spark.createDataFrame([(n, a) for n in range(3) for a in [*agents, None]], "n int, user_agent string")
    table = devices.device_table(events)
    assert table.count() == len(agents)
    for bound in (10**9, 0):
        got = devices.with_devices(events, table.persist(), bound)
        told = {r["user_agent"]: tuple(r)[2:] for r in got.collect()}
        assert got.count() == 21 and told == {**agents, None: ("Unknown", None, "Unknown", None)}
    # Rules of one's own, from a table.
    own = [devices.AgentRule(r"(\w+)bird/(\d+)", "$1", 2), devices.AgentRule("bird", "Bird")]
    read = devices.read_agent_rules(devices.rule_table(spark, own))
    assert read == own
    birds = spark.createDataFrame([("Blackbird/7",), ("a bird",)], "user_agent string")
    got = rows(devices.device_table(birds, read, []), "browser", "browser_version", "os")
    assert got == {("Black", "7", "Unknown"), ("Bird", None, "Unknown")}
