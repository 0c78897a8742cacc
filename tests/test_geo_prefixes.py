"""Keys of addresses, the longest prefix of both families, and nested ranges by blocks."""

from __future__ import annotations

import ipaddress
import random
import time

import pytest
from pyspark.sql import functions as F

from clicklake.functions.numbers import ip_to_long, with_ip_key
from clicklake.operators import geo

GEO = "geo struct<name:string>"


def key(text):
    """(family, number) as Python's own module reads it."""
    try:
        found = ipaddress.ip_address(text)
    except ValueError:
        return None
    if found.version == 6 and found.ipv4_mapped:
        found = found.ipv4_mapped
    return found.version, int(found)


ODD = [
    None, "", ":", "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7", "1::2::3", ":::", "1:::2", ":1::2", "1::2:",
    "2001:DB8::A:0", "::ffff:1.2.3.4", "::FFFF:0102:0304", "0:0:0:0:0:ffff:1.2.3.4", "::ffff:1.2.3.256", "1.2.3.4", "1.2.3", "64:ff9b::1.2.3.4",
    "12345::", "g::1", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff",
    "8000::", "::8000:0:0:0", "1.2.3.4::", " ::1", "::1\n",
]


def test_keys_are_those_of_the_standard_library(spark):
    rng = random.Random(3)
    some = [str(ipaddress.ip_address(rng.getrandbits(128))) for _ in range(100)]
    some += [ipaddress.ip_address(rng.getrandbits(128) & ~(0xFFFFFFFFFFFF << rng.randrange(80))).exploded.upper() for _ in range(50)]
    some += [str(ipaddress.IPv6Address(rng.getrandbits(64) << rng.randrange(65))) for _ in range(50)]
    df = spark.createDataFrame([(a,) for a in ODD + some], "ip string")
    got = {r.ip: r.k for r in with_ip_key(df, "ip", "k").collect()}
    number = lambda k: (k.family, (k.high % 2**64 << 64 | k.low % 2**64) if k.family == 6 else k.low)
    assert {a: k and number(k) for a, k in got.items()} == {a: key(a) if a else None for a in ODD + some}


def test_octets_without_an_array(spark):
    rows = ["0.0.0.0", "255.255.255.255", "1.2.3.4", "01.2.3.4", "1.2.3", "1.2.3.4.5", "a.2.3.4", "1..3.4", None, "256.1.1.1"]
    df = spark.createDataFrame([(r,) for r in rows], "ip string")
    assert [r[0] for r in df.select(ip_to_long(F.col("ip"))).collect()] == [0, 2**32 - 1, 16909060, 16909060, *[None] * 6]


def test_longest_prefix_of_both_families(spark):
    rng = random.Random(5)
    networks = ["0.0.0.0/0", "::/0", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.3/32", "::ffff:10.9.0.0/112", "2001:db8::/32", "2001:db8:0:ff::/64",
                "2001:db8::1/128", "2001:db8:8000::/33", "ffff::/16", "10.1.0.99/16"]
    networks += [f"2001:db8:{rng.randrange(4):x}::/{rng.choice([48, 49, 50, 63, 64, 65, 127])}" for _ in range(12)]
    bad = [("10.0.0.0/33",), ("::/129",), ("x/8",), ("10.0.0.0",), (None,), ("10.0.0.0/x",), ("::ffff:1.2.3.4/95",)]
    table = spark.createDataFrame([(n,) for n in networks] + bad, "network string").withColumn("geo", F.struct(F.col("network").alias("name")))
    asked = ["10.1.2.3", "10.1.2.4", "10.9.1.1", "::ffff:10.1.2.3", "9.9.9.9", "2001:db8::1", "2001:db8:8000::", "fffe::", None, "x", "10.1.2.3"]
    asked += [f"2001:db8:{rng.randrange(5):x}:{rng.randrange(3):x}::{rng.randrange(9):x}" for _ in range(60)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(asked)], "i int, ip string")
    got = geo.prefix_lookup(df, "ip", geo.prefix_table(table))
    assert got.columns == ["i", "ip", "geo"] and got.count() == len(asked)

    def v4(n):
        return ipaddress.ip_network(f"{n.network_address.ipv4_mapped}/{n.prefixlen - 96}") if n.version == 6 and n.network_address.ipv4_mapped else n
    known = [v4(ipaddress.ip_network(n, strict=False)) for n in networks]
    for r in got.collect():
        address = r.ip and key(r.ip) and ipaddress.ip_address(r.ip)
        if address and address.version == 6 and address.ipv4_mapped:
            address = address.ipv4_mapped
        longest = max([n.prefixlen for n in known if address and n.version == address.version and address in n], default=None)
        found = r.geo and v4(ipaddress.ip_network(r.geo["name"], strict=False))
        assert (found and found.prefixlen) == longest and (found is None or address in found)


def test_no_prefixes_and_no_rows(spark):
    none = geo.prefix_table(spark.createDataFrame([], f"network string, {GEO}"))
    df = spark.createDataFrame([("1.1.1.1",)], "ip string")
    assert [r.geo for r in geo.prefix_lookup(df, "ip", none).collect()] == [None]
    assert geo.prefix_lookup(df.limit(0), "ip", none).count() == 0


@pytest.mark.parametrize("way", [200_000, 0])
def test_nested_ranges_as_found_one_by_one(spark, way):
    rng = random.Random(11)
    ranges = []
    for _ in range(60):
        start = rng.choice([0, 65_000, 131_071]) + rng.randrange(300)
        ranges.append((start, start + rng.choice([0, 1, 7, 63, 200, 70_000, 140_000])))
    table = spark.createDataFrame([(a, b, (f"{a}-{b}",)) for a, b in ranges], f"start bigint, end bigint, {GEO}")
    points = sorted({p for a, b in ranges for p in (a - 1, a, b, b + 1) if p >= 0})
    df = spark.createDataFrame([(p, f"0.{p >> 16}.{p >> 8 & 255}.{p & 255}") for p in points], "p bigint, ip string")
    got = {r.p: r.geo and r.geo["name"] for r in geo.range_lookup(df, "ip", table, max_broadcast_rows=way).collect()}
    for p, name in got.items():
        inside = [(b - a, a, b) for a, b in ranges if a <= p <= b]
        if inside:
            width = min(inside)[0]
            assert name in {f"{a}-{b}" for w, a, b in inside if w == width}
        else:
            assert name is None


def test_a_block_with_all_its_hosts_is_cut_in_linear_rows(spark):
    """A range around 65,536 ranges of one address each."""
    hosts = spark.range(65_536).select(F.col("id").alias("start"), F.col("id").alias("end"), F.struct(F.col("id").cast("string").alias("name")).alias("geo"))
    around = spark.createDataFrame([(0, 70_000, ("around",))], f"start bigint, end bigint, {GEO}")
    df = spark.createDataFrame([("0.0.0.0",), ("0.0.255.255",), ("0.1.0.9",)], "ip string")
    began = time.time()
    got = geo.range_lookup(df, "ip", hosts.union(around))
    assert sorted(r.geo["name"] for r in got.collect()) == ["0", "65535", "around"]
    assert time.time() - began < 60
