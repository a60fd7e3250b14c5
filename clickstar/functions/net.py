"""IPv4 and IPv6 addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .let import let

# Addresses that stand for "not known".
PLACEHOLDER_IPS = ["", "unknown", "0.0.0.0"]

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4 = rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text to its number; null for anything else."""

    def octet(position: int) -> Column:
        upto = F.substring_index(ip, ".", position)
        return F.substring_index(upto, ".", -1).try_cast("bigint")

    number = ((octet(1) * 256 + octet(2)) * 256 + octet(3)) * 256 + octet(4)
    return F.when(ip.rlike(_IPV4), number)


def locatable_ip(ip: Column) -> Column:
    """The number of an address a lookup can resolve; null for placeholders too."""
    return F.when(~ip.isin(PLACEHOLDER_IPS), ip_to_long(ip))


# What IPv4 addresses look like among IPv6 ones, as hexadecimal digits.
MAPPED = "0" * 20 + "ffff"
_GROUP = r"[0-9a-f]{1,4}"
_TAIL = rf"\A(.*:)({_OCTET}(?:\.{_OCTET}){{3}})\z"


def _filled(halves: Column) -> Column:
    """The groups before and after ::, and between them the zeros it stands for, one at least."""
    none = F.array().cast("array<string>")
    groups = F.transform(halves, lambda h: F.when(h == "", none).otherwise(F.split(h, ":")))
    return let(
        groups,
        lambda g: let(
            F.lit(8) - F.size(F.get(g, F.lit(0))) - F.size(F.get(g, F.lit(1))),
            lambda zeros: F.when(
                zeros > 0,
                F.concat(
                    F.get(g, F.lit(0)),
                    F.array_repeat(F.lit("0"), F.greatest(zeros, F.lit(0))),
                    F.get(g, F.lit(1)),
                ),
            ),
        ),
    )


def _digits(groups: Column) -> Column:
    """Eight groups of up to four digits as one text; null for any other."""
    sound = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike(rf"\A{_GROUP}\z"))
    return F.when(sound, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))


def _without_tail(text: Column) -> Column:
    """An IPv4 address at the end as the two groups it stands for."""
    return let(
        ip_to_long(F.regexp_extract(text, _TAIL, 2)),
        lambda tail: F.concat(
            F.regexp_extract(text, _TAIL, 1),
            F.lower(F.hex(F.shiftright(tail, 16))),
            F.lit(":"),
            F.lower(F.hex(tail.bitwiseAND(65535))),
        ),
    )


def ipv6_hex(ip: Column) -> Column:
    """IPv6 text as its 32 hexadecimal digits, which order as addresses do; null for anything else.

    Takes what addresses are written as: groups without their zeros, one run of zero groups as ::,
    the last two groups as an IPv4 address, a zone after %.
    """
    plain = let(
        F.lower(F.substring_index(ip, "%", 1)),
        lambda text: F.when(text.contains("."), _without_tail(text)).otherwise(text),
    )
    digits = let(
        F.split(plain, "::"),
        lambda halves: let(
            F.when(F.size(halves) == 1, F.split(F.get(halves, F.lit(0)), ":")).when(
                F.size(halves) == 2, _filled(halves)
            ),
            _digits,
        ),
    )
    return F.when(ip.contains(":"), digits)


def mapped_ipv4(digits: Column) -> Column:
    """The number of the IPv4 address that an IPv6 address stands for, if it does."""
    number = F.conv(F.substring(digits, 25, 8), 16, 10).cast("bigint")
    return F.when(digits.startswith(MAPPED), number)
