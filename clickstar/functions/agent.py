"""Browser and operating system families from the user-agent text.

Each rule is a family and the texts that name it; the first rule that matches wins. A text is
found by a byte search inside generated code. A pair of texts must follow one another, and only
for those a regular expression runs, if no rule before has matched.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Sequence[str | tuple[str, str]]]

UNKNOWN = "Unknown"

# Browser families.
BROWSER_RULES: list[Rule] = [
    ("Googlebot", ["Googlebot"]),
    ("bingbot", ["bingbot", "Bingbot"]),
    ("Facebook", ["FBAN/", "FBAV/"]),
    ("Instagram", ["Instagram"]),
    ("Edge", ["Edg/", "Edge/", "EdgA/", "EdgiOS/"]),
    ("IE Mobile", ["IEMobile/"]),
    ("IE", ["Trident/", "MSIE "]),
    ("Opera Mini", ["Opera Mini/"]),
    ("Opera", ["OPR/", "Opera/"]),
    ("Samsung Internet", ["SamsungBrowser/"]),
    ("UC Browser", ["UCBrowser/"]),
    ("Yandex Browser", ["YaBrowser/"]),
    ("Vivaldi", ["Vivaldi/"]),
    ("QQ Browser", ["QQBrowser/"]),
    ("Firefox iOS", ["FxiOS/"]),
    ("Firefox Mobile", [("Mobile;", "Firefox/"), ("Tablet;", "Firefox/")]),
    ("Firefox", ["Firefox/"]),
    ("Chrome Mobile iOS", ["CriOS/"]),
    ("Chrome Mobile WebView", [("; wv)", "Chrome/")]),
    ("Chrome Mobile", [("Chrome/", "Mobile")]),
    ("Chrome", ["Chrome/"]),
    ("Android", [("Android", "Safari/")]),
    ("Mobile Safari", [("iPhone", "Safari/"), ("iPad", "Safari/"), ("iPod", "Safari/")]),
    (
        "Mobile Safari UI/WKWebView",
        [("iPhone", "AppleWebKit/"), ("iPad", "AppleWebKit/"), ("iPod", "AppleWebKit/")],
    ),
    ("Safari", ["Safari/"]),
]

# Operating system families.
OS_RULES: list[Rule] = [
    ("Windows Phone", ["Windows Phone"]),
    ("Windows", ["Windows"]),
    ("iOS", ["iPhone", "iPad", "iPod"]),
    ("Android", ["Android"]),
    ("Chrome OS", ["CrOS"]),
    ("Mac OS X", ["Mac OS X"]),
    ("Ubuntu", ["Ubuntu"]),
    ("Linux", ["Linux"]),
]


def _names(text: Column, sign: str | tuple[str, str]) -> Column:
    if isinstance(sign, str):
        return text.contains(sign)
    first, then = map(re.escape, sign)
    return text.rlike(f"(?s){first}.*{then}")


def first_match(text: Column, rules: Sequence[Rule], default: str = UNKNOWN) -> Column:
    """Label of the first rule with a matching text; the default for null and no match."""
    chain = F
    for label, signs in rules:
        hit = reduce(or_, [_names(text, sign) for sign in signs])
        chain = chain.when(hit, F.lit(label))
    return chain.otherwise(F.lit(default))


def browser_family(user_agent: Column, rules: Sequence[Rule] = BROWSER_RULES) -> Column:
    return first_match(user_agent, rules)


def os_family(user_agent: Column, rules: Sequence[Rule] = OS_RULES) -> Column:
    return first_match(user_agent, rules)
