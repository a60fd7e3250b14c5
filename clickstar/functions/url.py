"""What a page address says about product and country."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .let import let

UNKNOWN = "Unknown"

# The product part of a path, up to a SKU, an extension or the end of the address.
_PRODUCT_PART = r"([^/?]+?)(?:-sku|\.html|$)"

# (?d) lets $ stop at \n only. The first match of the part begins where a stretch between / and ?
# begins, if anywhere in it; to look there only spares a try at each character.
_AT_STRETCH_START = r"(?d)(?<![^/?])"

# Letters that have a case.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"

_SCHEME_AND_USER = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?"
_HOST = _SCHEME_AND_USER + r"([^/?#:]+)"


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _title_case(words: Column) -> Column:
    """Capital after every character without case, so 18k gives 18K.

    initcap goes by spaces, so for its time one follows each such character, marked by a slash,
    which the words of an address cannot hold. Every step reads its input once: a branch for
    plain words would have them extracted anew on each mention.
    """
    parted = F.regexp_replace(words, f"([^{_CASED} ])(?=[{_CASED}])", "$1/ ")
    return F.replace(F.initcap(parted), F.lit("/ "), F.lit(""))


def product_name(url: Column, brand_prefix: str = "") -> Column:
    """Product name from a page address, without the shop's brand prefix."""
    prefix = f"(?:{re.escape(brand_prefix)})?" if brand_prefix else ""
    part = F.regexp_extract(url, f"{_AT_STRETCH_START}{prefix}{_PRODUCT_PART}", 1)
    words = F.replace(part, F.lit("-"), F.lit(" "))
    return F.coalesce(_or_null(_title_case(words)), F.lit(UNKNOWN))


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute address, else null.

    A pattern, not parse_url: that follows a strict grammar and loses the many real addresses
    with characters such as | or { in the query.
    """
    return _or_null(F.lower(F.regexp_extract(url, _HOST, 1)))


def domain_label(url: Column) -> Column:
    """Last label of the host: fr, com, uk."""
    return F.substring_index(url_host(url), ".", -1)


# Suffixes of several labels under which registrars sell names for a country, and those
# under which they do so for none. Labels of countries and what is registered right below them need
# no entry: co.uk ends in uk.
SUFFIX_COUNTRIES: dict[str, str | None] = {
    "uk.com": "uk",
    "gb.com": "uk",
    "uk.net": "uk",
    "gb.net": "uk",
    "us.com": "us",
    "us.org": "us",
    "br.com": "br",
    "cn.com": "cn",
    "de.com": "de",
    "jp.net": "jp",
    "jpn.com": "jp",
    "mex.com": "mx",
    "ru.com": "ru",
    "sa.com": "sa",
    "se.net": "se",
    "za.com": "za",
    "za.bz": "za",
    "com.de": "de",
    "eu.int": None,
    "un.int": None,
}

# Labels of countries that differ from their ISO code.
_OTHER_LABELS = {"uk": "GB"}


@cache
def country_codes() -> dict[str, str]:
    """Labels of countries' domains and their English names, from the JVM's table of ISO 3166. The eu
    and the labels of no country are not in it."""
    locale = SparkSession.active()._jvm.java.util.Locale
    labels = {code.lower(): code for code in locale.getISOCountries()} | _OTHER_LABELS
    return {label: locale("", code).getDisplayCountry(locale.ENGLISH) for label, code in labels.items()}


def suffix_country(
    host: Column, suffixes: Mapping[str, str | None] = SUFFIX_COUNTRIES
) -> Column:
    """The country of a host's longest known suffix: one of `suffixes`, else its last label, if that is
    a country's. A suffix is whole labels: notuk.com does not end in uk.com. A host that is itself a
    suffix has its country too; a dot at its end does not count."""
    # All codes in one text, which is searched byte by byte; a map would be compared entry by entry.
    codes = F.lit("." + ".".join(country_codes()) + ".")

    def country(dotted: Column) -> Column:
        label = F.substring_index(dotted, ".", -1)
        is_code = (F.char_length(label) == 2) & codes.contains(F.concat(F.lit("."), label, F.lit(".")))
        chain = F
        for suffix in sorted(suffixes, key=lambda s: (-s.count("."), s)):
            chain = chain.when(dotted.endswith(f".{suffix}"), F.lit(suffixes[suffix]).cast("string"))
        return chain.when(is_code, label)

    # Every suffix asks for the host, which a pattern finds: it is worked out once.
    return let(F.concat(F.lit("."), F.lower(F.rtrim(host, F.lit(".")))), country)


def domain_country(
    url: Column, suffixes: Mapping[str, str | None] = SUFFIX_COUNTRIES
) -> Column:
    """Country code of an address's domain, null where it names no country, as com and eu do."""
    return suffix_country(url_host(url), suffixes)


# Names as reports show them, where these are wanted other than in `country_codes`.
COUNTRY_NAMES = {
    "ar": "Argentina",
    "at": "Austria",
    "au": "Australia",
    "be": "Belgium",
    "bg": "Bulgaria",
    "br": "Brazil",
    "ca": "Canada",
    "ch": "Switzerland",
    "cl": "Chile",
    "cn": "China",
    "co": "Colombia",
    "cz": "Czechia",
    "de": "Germany",
    "dk": "Denmark",
    "ee": "Estonia",
    "es": "Spain",
    "fi": "Finland",
    "fr": "France",
    "gr": "Greece",
    "hk": "Hong Kong",
    "hr": "Croatia",
    "hu": "Hungary",
    "ie": "Ireland",
    "il": "Israel",
    "in": "India",
    "is": "Iceland",
    "it": "Italy",
    "jp": "Japan",
    "kr": "South Korea",
    "lt": "Lithuania",
    "lu": "Luxembourg",
    "lv": "Latvia",
    "mt": "Malta",
    "mx": "Mexico",
    "my": "Malaysia",
    "nl": "Netherlands",
    "no": "Norway",
    "nz": "New Zealand",
    "pe": "Peru",
    "ph": "Philippines",
    "pl": "Poland",
    "pt": "Portugal",
    "ro": "Romania",
    "rs": "Serbia",
    "se": "Sweden",
    "sg": "Singapore",
    "si": "Slovenia",
    "sk": "Slovakia",
    "th": "Thailand",
    "tr": "Turkey",
    "tw": "Taiwan",
    "ua": "Ukraine",
    "uk": "United Kingdom",
    "us": "United States",
    "vn": "Vietnam",
    "za": "South Africa",
}


def country_name(code: Column, names: Mapping[str, str] = COUNTRY_NAMES) -> Column:
    """Name of a country code of a domain; one that no country has keeps its code."""
    every = {**country_codes(), **names}
    known = F.create_map(*[F.lit(x) for pair in every.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(code)), code)
