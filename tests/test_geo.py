"""Longest-prefix match and skew-safe lookups against brute force."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import ip as ipf
from cairn.operators import geo, lookups
from cairn.plans.joins import plan_text


def parsed(text):
    try:
        a = ipaddress.ip_address(text.strip()) if text is not None else None
    except ValueError:
        return None
    return None if a is None else int(a) if a.version == 6 else int(a) | 0xFFFF << 32


TEXTS = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "01.2.3.4", "", " 10.0.0.1 ", "x", None,
         "::", "::1", "1::", "2001:db8::8a2e:370:7334", "2001:DB8::1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
         "1:2:3:4:5:6:7::8", "1:2:3:4:5:6::8", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "1::2::3", ":::", "12345::", "g::", "1.2.3.4/8",
         "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "::ffff:a00:1", "fe80::", "::1:2:3:4:5:6:7"]


def test_addresses_parse_like_the_standard_library(spark):
    rng = random.Random(5)
    texts = TEXTS + [str(ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ipf.ip_halves(F.col("t")).alias("a"))
    for r in df.collect():
        got = None if r.a is None else (r.a.hi & (1 << 64) - 1) << 64 | r.a.lo & (1 << 64) - 1
        assert got == parsed(r.t), r.t


def test_networks_parse_like_the_standard_library(spark):
    texts = ["10.1.2.3/8", "10.1.2.3/0", "10.1.2.3", "10.1.2.3/32", "10.1.2.3/33", "10.1.2.3/x", "10.1.2.3/8/9", "2001:db8:1:2:3::/64",
             "2001:db8:ffff::1/65", "::/0", "2001:db8::1", "f::/129", None, "/8", *(f"ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff/{n}" for n in range(0, 129, 7))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ipf.cidr_network(F.col("t")).alias("n"))
    for r in df.collect():
        try:
            net = ipaddress.ip_network(r.t, strict=False) if r.t else None
        except ValueError:
            net = None
        if net is None:
            assert r.n is None, r.t
            continue
        v4 = net.version == 4
        want = (int(net.network_address) | (0xFFFF << 32 if v4 else 0), net.prefixlen + (96 if v4 else 0))
        if v4 and net.prefixlen < 32:
            want = (int(net.network_address) | 0xFFFF << 32, want[1])
        assert ((r.n.hi & (1 << 64) - 1) << 64 | r.n.lo & (1 << 64) - 1, r.n.length) == want, r.t


def brute(ip, ranges):
    best = None
    for cidr, value in ranges:
        try:
            a, n = ipaddress.ip_address(ip), ipaddress.ip_network(cidr, strict=False)
        except ValueError:
            continue
        if a in n:
            best = max(best or (-1, ""), (n.prefixlen, value))
    return best


@pytest.mark.parametrize("most", [1000, 3])
def test_longest_prefix_of_overlapping_ranges(spark, monkeypatch, most):
    monkeypatch.setattr(lookups.lookup_join, "__defaults__", (most,))
    rng = random.Random(most)
    ranges = [(f"10.{rng.randint(0, 3)}.{rng.randint(0, 3)}.{rng.randint(0, 9)}/{rng.choice([0, 8, 13, 16, 22, 24, 30, 32])}", f"v{i:03}") for i in range(60)]
    ranges += [("broken/8", "no"), (None, "no"), ("2001:db8::/32", "six"), ("2001:db8:1::/48", "six longer"), ("::/0", "all six")]
    ips = [f"10.{rng.randint(0, 4)}.{rng.randint(0, 4)}.{rng.randint(0, 12)}" for _ in range(300)] + ["10.0.0.1"] * 400
    ips += ["2001:db8:1::5", "2001:db8:2::5", "fe80::1", "broken", "", None, None]
    rows = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id long, ip string").repartition(4)
    out = geo.locate(rows, spark.createDataFrame(ranges, "cidr string, geodata string")).collect()
    assert len(out) == len(ips)
    usable = [(c, v) for c, v in ranges if c]
    for r in out:
        want = brute(r.ip, usable) if r.ip else None
        assert (r.geodata, r.prefix_length) == ((want[1], want[0]) if want else ("{}", None)), r.ip


def test_no_range_or_cross_join(spark):
    ranges = spark.createDataFrame([("10.0.0.0/8", "a")], "cidr string, geodata string")
    nets = geo.networks(ranges)
    txt = plan_text(geo.longest_prefix(spark.createDataFrame([("10.0.0.1",)], "ip string"), nets))
    assert "NestedLoop" not in txt and "Cartesian" not in txt


def test_empty_sides(spark):
    ranges = spark.createDataFrame([], "cidr string, geodata string")
    rows = spark.createDataFrame([("10.0.0.1",)], "ip string")
    assert [tuple(r) for r in geo.locate(rows, ranges).collect()] == [("10.0.0.1", "{}", None)]
    assert geo.locate(rows.limit(0), ranges).count() == 0


def test_lookup_join_broadcasts_hot_keys_only(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"), "id")
    lookup = spark.range(-1, 15_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert [r.k for r in lookups.hot_keys(rows, ["k"], 10).collect()] == [-1]
    out = lookups.lookup_join(rows, lookup, ["k"], 10)
    want = rows.join(lookup, "k", "left").select("k", "id", "v")
    assert out.count() == 20_000 and out.exceptAll(want).isEmpty()
