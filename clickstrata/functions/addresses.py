"""Addresses of both families as numbers.

An IPv4 address is its number. An IPv6 address is its first 64 bits, as a bigint of the same
order (the first bit is turned over); the rest names an interface, not a network.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}"
IPV4 = rf"^{_DOTTED}$"
#: An IPv4 address in IPv6 clothes.
MAPPED = rf"^(?i)::ffff:{_DOTTED}$"
_GROUP = "[0-9a-fA-F]{1,4}"
IPV6 = rf"^(({_GROUP}:){{7}}{_GROUP}|(({_GROUP}:)*{_GROUP})?::(({_GROUP}:)*{_GROUP})?)$"

#: Network keys of IPv6 begin around this number, above all of IPv4.
_IPV6_KEYS = 1 << 40


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _plain(address: Column) -> Column:
    """Without the clothes."""
    return F.when(address.rlike(MAPPED), F.substring_index(address, ":", -1)).otherwise(address)


def ipv4_number(address: Column) -> Column:
    """``a.b.c.d`` as a bigint; null for IPv6 and malformed text."""
    def number(parts: Column) -> Column:
        return sum(
            (F.try_element_at(parts, F.lit(i + 1)).try_cast("bigint") * 256 ** (3 - i)
             for i in range(4)),
            F.lit(0).cast("bigint"),
        )

    return _bound(F.when(address.rlike(IPV4), F.split(address, r"\.")), number)


def ipv6_number(address: Column) -> Column:
    """The first 64 bits, in order, as a bigint; null for IPv4 and malformed text."""
    def words(part: Column) -> Column:
        return F.filter(F.split(F.coalesce(part, F.lit("")), ":"), lambda g: g != "")

    def whole(ends: Column) -> Column:
        """All eight groups; null if there are not eight."""
        halves = F.struct(
            words(F.get(ends, 0)).alias("head"),
            words(F.get(ends, 1)).alias("tail"),
            (F.size(ends) == 2).alias("open"),
        )
        return _bound(halves, filled)

    def filled(halves: Column) -> Column:
        gap = 8 - F.size(halves["head"]) - F.size(halves["tail"])
        zeros = F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0)))
        fits = F.when(halves["open"], gap >= 1).otherwise(gap == 0)
        return F.when(fits, F.concat(halves["head"], zeros, halves["tail"]))

    def number(groups: Column) -> Column:
        values = [F.conv(F.get(groups, i), 16, 10).cast("bigint") for i in range(4)]
        values[0] = values[0] - 32768
        return sum(
            (F.shiftleft(v, 16 * (3 - i)) for i, v in enumerate(values)), F.lit(0).cast("bigint")
        )

    split = F.when(address.rlike(IPV6), F.split(address, "::"))
    return _bound(_bound(split, whole), number)


def family_and_number(address: Column) -> Column:
    """``family`` (4 or 6) and ``number``; null for malformed text."""
    def tagged(family: int):
        tag = F.lit(family).alias("family")
        return lambda n: F.when(n.isNotNull(), F.struct(tag, n.alias("number")))

    def both(plain: Column) -> Column:
        return F.coalesce(
            _bound(ipv4_number(plain), tagged(4)), _bound(ipv6_number(plain), tagged(6))
        )

    return _bound(_plain(address), both)


def network_key(family: Column, number: Column) -> Column:
    """One number for the networks (/16, /32) of both families, in their order; never negative."""
    return F.when(family == 4, F.shiftright(number, 16)).when(
        family == 6, F.shiftright(number, 32) + _IPV6_KEYS
    )


def network_range(network: Column) -> Column:
    """First and last number of a CIDR network of either family, with the family.

    IPv6 networks narrower than 64 bits count as the one of 64 bits that holds them. Malformed
    text gives null.
    """
    def ranged(parts: Column) -> Column:
        found = family_and_number(F.get(parts, 0))
        given = F.when(F.size(parts) == 1, 128).otherwise(F.get(parts, 1).try_cast("int"))
        return _bound(F.struct(found.alias("at"), given.alias("length")), limits)

    def limits(given: Column) -> Column:
        family, length = given["at"]["family"], given["length"]
        most = F.when(family == 4, 32).otherwise(128)
        length = F.when(F.size(F.split(network, "/")) == 1, most).otherwise(length)
        bits = F.when(family == 4, 32).otherwise(64)
        sound = given["at"].isNotNull() & length.between(0, most)
        low = F.when(sound, bits - F.least(length, bits)).cast("int")
        return _bound(F.struct(given["at"].alias("at"), low.alias("low")), _range)

    return _bound(F.split(network, "/"), ranged)


def _range(given: Column) -> Column:
    number, low = given["at"]["number"], given["low"]
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), low))
    first = F.call_function("shiftleft", F.call_function("shiftright", number, low), low)
    # a shift by all 64 bits would be none
    all_ipv6 = low == 64
    return F.when(
        low.isNotNull(),
        F.struct(
            given["at"]["family"].alias("family"),
            F.when(all_ipv6, -(1 << 63)).otherwise(first).alias("ip_from"),
            F.when(all_ipv6, (1 << 63) - 1).otherwise(first.bitwiseOR(below)).alias("ip_to"),
        ),
    )
