"""Browser and system of user agents, told once per distinct agent.

Rules are rows of a table: an order, what they tell, a pattern, a family and where its version is.
They run on the distinct agents of the events, a few thousand beside any number of events, and what
they tell goes back to the events by a join. So rules may be many and their patterns slow.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .lookup import MAX_BROADCAST_BYTES, measured_bytes

UNKNOWN = "Unknown"
#: Rules become one expression, so their number is bounded.
MOST_RULES = 2_000


@dataclass(frozen=True)
class AgentRule:
    """`pattern` names `family`, in which $1 is the pattern's first group; version numbers are in the
    groups from `version` on, the major one first."""

    pattern: str
    family: str
    version: int = 1


# Patterns of browsers, the first that matches tells.
_BOTS = r"(Googlebot|bingbot|YandexBot|DuckDuckBot|Applebot|AhrefsBot|facebookexternalhit|Twitterbot)"
BROWSERS = [
    AgentRule(rf"{_BOTS}(?:-[A-Za-z]+)?/(\d+)\.(\d+)", "$1", 2),
    AgentRule(r"(?:FBAV|FBSV)/(\d+)\.(\d+)", "Facebook"),
    AgentRule(r"FBAN/", "Facebook"),
    AgentRule(r"Instagram (\d+)\.(\d+)", "Instagram"),
    AgentRule(r"(Pinterest|Snapchat|LinkedInApp|TikTok)/(\d+)\.(\d+)", "$1", 2),
    AgentRule(r"(?:EdgA|EdgiOS)/(\d+)\.(\d+)", "Edge Mobile"),
    AgentRule(r"Edge?/(\d+)\.(\d+)", "Edge"),
    AgentRule(r"IEMobile[ /](\d+)\.(\d+)", "IE Mobile"),
    AgentRule(r"Trident/.*rv:(\d+)\.(\d+)", "IE"),
    AgentRule(r"MSIE (\d+)\.(\d+)", "IE"),
    AgentRule(r"Opera Mini/(\d+)\.(\d+)", "Opera Mini"),
    AgentRule(r"OPR/(\d+)\.(\d+).*Mobile|Mobile.*OPR/(\d+)\.(\d+)", "Opera Mobile"),
    AgentRule(r"OPR/(\d+)\.(\d+)", "Opera"),
    AgentRule(r"SamsungBrowser/(\d+)\.(\d+)", "Samsung Internet"),
    AgentRule(r"UC ?Browser/(\d+)\.(\d+)", "UC Browser"),
    AgentRule(r"YaBrowser/(\d+)\.(\d+)", "Yandex Browser"),
    AgentRule(r"(Vivaldi|Brave|Whale|Iron|Falkon|Epiphany|Silk|MiuiBrowser|HuaweiBrowser)/(\d+)\.(\d+)", "$1", 2),
    AgentRule(r"QQBrowser/(\d+)\.(\d+)", "QQ Browser"),
    AgentRule(r"DuckDuckGo/(\d+)\.?(\d+)?", "DuckDuckGo"),
    AgentRule(r"GSA/(\d+)\.(\d+)", "Google"),
    AgentRule(r"HeadlessChrome/(\d+)\.(\d+)", "HeadlessChrome"),
    AgentRule(r"FxiOS/(\d+)\.(\d+)", "Firefox iOS"),
    AgentRule(r"(?:Mobile|Tablet);.*Firefox/(\d+)\.(\d+)", "Firefox Mobile"),
    AgentRule(r"(SeaMonkey|PaleMoon|Waterfox)/(\d+)\.(\d+)", "$1", 2),
    AgentRule(r"Firefox/(\d+)\.(\d+)", "Firefox"),
    AgentRule(r"CriOS/(\d+)\.(\d+)", "Chrome Mobile iOS"),
    AgentRule(r"; wv\).*Chrome/(\d+)\.(\d+)", "Chrome Mobile WebView"),
    AgentRule(r"Chrome/(\d+)\.(\d+).*Mobile", "Chrome Mobile"),
    AgentRule(r"Chrome/(\d+)\.(\d+)", "Chrome"),
    AgentRule(r"Android (\d+)(?:\.(\d+))?.*Safari/", "Android"),
    AgentRule(r"(?:iPhone|iPad|iPod).*Version/(\d+)\.(\d+).*Safari/", "Mobile Safari"),
    AgentRule(r"(?:iPhone|iPad|iPod).*AppleWebKit/", "Mobile Safari UI/WKWebView"),
    AgentRule(r"Version/(\d+)\.(\d+).*Safari/", "Safari"),
    AgentRule(r"(curl|Wget|python-requests|okhttp|Go-http-client|PostmanRuntime)/(\d+)\.(\d+)", "$1", 2),
]

# Patterns of systems.
SYSTEMS = [
    AgentRule(r"Windows Phone(?: OS)? (\d+)\.(\d+)", "Windows Phone"),
    AgentRule(r"Windows NT (\d+)\.(\d+)", "Windows"),
    AgentRule(r"Windows", "Windows"),
    AgentRule(r"(?:iPhone|iPad|iPod).* OS (\d+)_(\d+)", "iOS"),
    AgentRule(r"(?:iPhone|iPad|iPod)", "iOS"),
    AgentRule(r"KAIOS/(\d+)\.(\d+)", "KaiOS"),
    AgentRule(r"HarmonyOS (\d+)\.(\d+)", "HarmonyOS"),
    AgentRule(r"Tizen (\d+)\.(\d+)", "Tizen"),
    AgentRule(r"Web0S", "webOS"),
    AgentRule(r"Android (\d+)(?:\.(\d+))?", "Android"),
    AgentRule(r"Android", "Android"),
    AgentRule(r"CrOS [^ ]+ (\d+)\.(\d+)", "Chrome OS"),
    AgentRule(r"Mac OS X (\d+)[_.](\d+)", "Mac OS X"),
    AgentRule(r"Mac OS X", "Mac OS X"),
    AgentRule(r"(Ubuntu|Fedora|FreeBSD|OpenBSD|Debian)", "$1", 2),
    AgentRule(r"Linux", "Linux"),
]


def read_agent_rules(rules: DataFrame) -> list[AgentRule]:
    """Rules from a table with `position, pattern, family, version`; at most `MOST_RULES`."""
    rows = rules.orderBy("position").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return [AgentRule(r["pattern"], r["family"], r["version"]) for r in rows]


def rule_table(spark: SparkSession, rules: Sequence[AgentRule]) -> DataFrame:
    """The other way: rules as a table, to be kept beside the warehouse and changed there."""
    rows = [(n, r.pattern, r.family, r.version) for n, r in enumerate(rules)]
    return spark.createDataFrame(rows, "position int, pattern string, family string, version int")


def _told(agent: Column, rules: Sequence[AgentRule]) -> Column:
    """`family, version` by the first rule that matches; the version as far as the agent has it."""
    chain = F
    for rule in rules:
        n = re.compile(rule.pattern).groups
        family = F.lit(rule.family)
        if "$1" in rule.family:
            family = F.replace(family, F.lit("$1"), F.regexp_extract(agent, rule.pattern, 1))
        numbers = [
            F.nullif(F.regexp_extract(agent, rule.pattern, g), F.lit(""))
            for g in range(rule.version, n + 1)
        ]
        version = F.nullif(F.concat_ws(".", *numbers), F.lit("")) if numbers else F.lit(None).cast("string")
        told = F.struct(family.alias("family"), version.alias("version"))
        chain = chain.when(agent.rlike(rule.pattern), told)
    unknown = F.struct(F.lit(UNKNOWN).alias("family"), F.lit(None).cast("string").alias("version"))
    return chain.otherwise(unknown) if rules else unknown


def device_table(
    agents: DataFrame,
    browsers: Sequence[AgentRule] = BROWSERS,
    systems: Sequence[AgentRule] = SYSTEMS,
) -> DataFrame:
    """`user_agent, browser, browser_version, os, os_version` of each distinct agent but null."""
    distinct = agents.where(F.col("user_agent").isNotNull()).select("user_agent").distinct()
    told = distinct.select(
        "user_agent",
        _told(F.col("user_agent"), browsers).alias("b"),
        _told(F.col("user_agent"), systems).alias("s"),
    )
    return told.select(
        "user_agent",
        F.col("b.family").alias("browser"),
        F.col("b.version").alias("browser_version"),
        F.col("s.family").alias("os"),
        F.col("s.version").alias("os_version"),
    )


def with_devices(
    events: DataFrame, devices: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """`events` with the device of their agent; Unknown without one.

    `devices` is a stored device table. It is measured: a small one is broadcast and events stay where
    they are; with a large one both sides meet by agent, and AQE splits the partitions of hot agents
    and of none.
    """
    table = devices.withColumnRenamed("user_agent", "_agent")
    if measured_bytes(table) <= max_broadcast_bytes:
        table = F.broadcast(table)
    joined = events.join(table, F.col("user_agent") == F.col("_agent"), "left")
    named = [F.coalesce(name, F.lit(UNKNOWN)).alias(name) for name in ("browser", "os")]
    return joined.select(
        *events.columns, named[0], "browser_version", named[1], "os_version"
    )
