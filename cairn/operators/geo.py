"""Location by IP address: longest-prefix match against CIDR ranges.

A range join (``low <= ip AND ip <= high``) compares every address with every range. Here each
distinct address is cut to every prefix length the ranges use (at most 129 lengths) and joined by
equality on (length, network), and the longest hit wins. Rows then take their address's hit, so a
busy address is matched once. Both joins spread hot keys: a wide range that covers most addresses,
an address that sends most rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.functions.ip import cidr_network, ip_halves, masked, V4_LENGTH
from cairn.operators.lookups import lookup_join
from cairn.session import written


def networks(ranges: DataFrame, cidr: str = "cidr", value: str = "geodata") -> DataFrame:
    """length, hi, lo and value, one row per network. Ranges that do not parse are left out; of
    several values for one network the greatest is taken."""
    net = ranges.select(cidr_network(F.col(cidr)).alias("_n"), F.col(value).alias(value)).where("_n IS NOT NULL")
    return net.groupBy(F.col("_n.length").alias("length"), F.col("_n.hi").alias("hi"), F.col("_n.lo").alias("lo")).agg(
        F.max(value).alias(value))


def longest_prefix(addresses: DataFrame, nets: DataFrame, ip: str = "ip", value: str = "geodata") -> DataFrame:
    """ip, value and prefix_length of the longest network that holds each distinct address; addresses
    in no network, or that are none, are left out. ``nets`` is a table from ``networks``."""
    lengths = nets.select(F.collect_set("length")).scalar()
    known = addresses.select(F.col(ip).alias("_ip")).where(F.col(ip).isNotNull()).distinct()
    known = known.select("_ip", ip_halves(F.col("_ip")).alias("_a")).where("_a IS NOT NULL")
    cut = known.select("_ip", "_a.*", F.explode(lengths).alias("length"))
    hi, lo = masked(F.col("hi"), F.col("lo"), F.col("length"))
    tries = written(cut.where(~F.col("v4") | (F.col("length") >= V4_LENGTH))      # IPv4 in IPv4 ranges only
                    .select("_ip", "length", hi.alias("hi"), lo.alias("lo")), "ip-prefixes")
    hits = lookup_join(tries, nets, ["length", "hi", "lo"]).where(F.col(value).isNotNull())
    best = hits.groupBy("_ip").agg(F.max_by(value, "length").alias(value), F.max("length").alias("prefix_length"))
    return best.select(F.col("_ip").alias(ip), value, "prefix_length")


def locate(rows: DataFrame, ranges: DataFrame, *, ip: str = "ip", cidr: str = "cidr", value: str = "geodata",
           default: str = "{}") -> DataFrame:
    """``rows`` with ``value`` of the longest range holding their address and its ``prefix_length``
    (32 at most for IPv4). A miss, a NULL or an unreadable address yields ``default``. ``rows`` is
    read several times: pass a table or a projection of one."""
    nets = written(networks(ranges, cidr, value), "networks")
    found = written(longest_prefix(rows, nets, ip, value), "ip-hits")
    out = lookup_join(rows, found, [ip])
    bits = F.when(F.col(ip).contains(":"), F.col("prefix_length")).otherwise(F.col("prefix_length") - V4_LENGTH)
    return out.withColumns({value: F.coalesce(F.col(value), F.lit(default)), "prefix_length": bits.cast("int")})
