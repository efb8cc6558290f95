"""IP addresses and CIDR ranges as pairs of longs (built-in functions only).

An address is a 128-bit number in two halves, ``hi`` and ``lo``; IPv4 addresses take their place in
``::ffff:0:0/96``, so that one table of ranges serves both kinds. Text that is no address is NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BYTE = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_V4 = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_V6 = r"^(?!:[^:])(?!.*[^:]:$)(?!.*:::)(?!.*::.*::)[0-9a-f]{0,4}(?::[0-9a-f]{0,4}){2,8}$"
V4_LENGTH = 96


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _joined(parts: Column, start: int, bits: int, number: Callable[[Column], Column]) -> Column:
    return F.aggregate(parts, F.lit(start).cast("bigint"), lambda acc, p: F.shiftleft(acc, bits).bitwiseOR(number(p)))


def _v6(groups: Column) -> Column:
    def hex_number(g: Column) -> Column:
        return F.conv(g, 16, 10).cast("bigint")
    return F.struct(_joined(F.slice(groups, 1, 4), 0, 16, hex_number).alias("hi"),
                    _joined(F.slice(groups, 5, 4), 0, 16, hex_number).alias("lo"), F.lit(False).alias("v4"))


def _v6_address(text: Column) -> Column:
    """``::`` stands for the groups that are missing to make eight."""
    def groups(halves: Column) -> Column:
        given = [F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in (0, 1)]
        return F.struct(given[0].alias("a"), given[1].alias("b"), (F.size(halves) == 2).alias("gap"))

    def filled(g: Column) -> Column:
        missing = F.lit(8) - F.size(g["a"]) - F.size(g["b"])
        zeros = F.when(g["gap"], F.array_repeat(F.lit("0"), missing)).otherwise(F.array().cast("array<string>"))
        return F.when(g["gap"] == (missing > 0), F.concat(g["a"], zeros, g["b"]))

    return _let(_let(_let(F.split(text, "::"), groups), filled), lambda g: F.when(F.size(g) == 8, _v6(g)))


def ip_halves(text: Column) -> Column:
    """struct<hi, lo, v4> of an address's text; NULL where it is none."""
    def address(t: Column) -> Column:
        low = _joined(F.split(t, r"\."), 0xFFFF, 8, lambda b: b.cast("bigint"))
        v4 = F.struct(F.lit(0).cast("bigint").alias("hi"), low.alias("lo"), F.lit(True).alias("v4"))
        return F.when(t.rlike(_V4), v4).when(t.rlike(_V6), _v6_address(t))
    return _let(F.lower(F.trim(text)), address)


def masked(hi: Column, lo: Column, length: Column) -> tuple[Column, Column]:
    """The first ``length`` bits (0 to 128) of an address, the others cleared."""
    ones = F.lit(-1).cast("bigint")
    zero = F.lit(0).cast("bigint")
    high = F.when(length >= 64, hi).when(length <= 0, zero).otherwise(hi.bitwiseAND(F.call_function("shiftleft", ones, F.lit(64) - length)))
    low = F.when(length <= 64, zero).otherwise(lo.bitwiseAND(F.call_function("shiftleft", ones, F.lit(128) - length)))
    return high, low


def cidr_network(text: Column) -> Column:
    """struct<hi, lo, length> of a range such as ``10.1.0.0/16``, host bits cleared; an address alone
    is a range of one. NULL where it is none."""
    def read(parts: Column) -> Column:
        told = F.get(parts, F.lit(1))
        bits = F.when(told.rlike(r"^\d{1,3}$"), told.cast("int"))
        return F.struct(ip_halves(F.get(parts, F.lit(0))).alias("ip"), F.size(parts).alias("n"), bits.alias("bits"))

    def sized(r: Column) -> Column:
        whole = F.when(r["ip"]["v4"], 32).otherwise(128)
        bits = F.when(r["n"] == 1, whole).when((r["n"] == 2) & (r["bits"] <= whole), r["bits"])
        return F.struct(r["ip"]["hi"].alias("hi"), r["ip"]["lo"].alias("lo"),
                        (bits + F.when(r["ip"]["v4"], V4_LENGTH).otherwise(0)).alias("length"))

    def network(r: Column) -> Column:
        hi, lo = masked(r["hi"], r["lo"], r["length"])
        return F.when(r["hi"].isNotNull() & r["length"].isNotNull(), F.struct(hi.alias("hi"), lo.alias("lo"), r["length"].alias("length")))

    return _let(_let(_let(F.split(F.trim(text), "/"), read), sized), network)
