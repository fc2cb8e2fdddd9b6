"""IPv6 text and the join of both families, against the standard library and brute force."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from tillscope.functions.address6 import cidr6_prefix, ip6_parts, ip6_text, last6, network6
from tillscope.operators.geojoin6 import cidr6_join, mixed_join


def _signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def _parts(text):
    try:
        if "%" in text:
            return None, None
        n = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None, None
    return _signed(n >> 64), _signed(n & ((1 << 64) - 1))


def test_texts(spark):
    rng = random.Random(1)
    texts = [
        "::", "::1", "1::", "1:2:3:4:5:6:7:8", "2001:DB8::ff00:42:8329", "::ffff:1.2.3.4", "64:ff9b::192.0.2.33",
        "1:2:3:4:5:6:1.2.3.4", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "8000::", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
        "", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "1:2:3:4:5:6:7:8::", "::1:2:3:4:5:6:7:8",
        "1.2.3.4", "::1.2.3", "::1.2.3.256", "fe80::1%eth0", "1:", ":1", "1:2:3:4:5:6:7:1.2.3.4",
    ]
    for _ in range(300):
        n = rng.getrandbits(128) & rng.choice([-1, ~(0xFFFFFFFF << rng.randrange(96)), (1 << rng.randrange(1, 128)) - 1])
        texts += [str(ipaddress.IPv6Address(n)), ipaddress.IPv6Address(n).exploded]
    high, low = ip6_parts("t")
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").select("t", high.alias("h"), low.alias("l"))
    rows = rows.withColumn("back", ip6_text("h", "l"))
    for r in rows.collect():
        assert (r.h, r.l) == (_parts(r.t) if r.t is not None else (None, None)), r.t
        if r.h is not None:
            assert len(r.back) == 39 and ipaddress.IPv6Address(r.back) == ipaddress.IPv6Address(r.t)


def test_bounds_of_every_length(spark):
    n = int(ipaddress.IPv6Address("9234:5678:9abc:def0:f234:5678:9abc:def1"))
    rows = spark.range(129).select(F.format_string("9234:5678:9abc:def0:f234:5678:9abc:def1/%d", "id").alias("c"), F.col("id").cast("int").alias("p"))
    high, low = ip6_parts("substring_index(c, '/', 1)")
    rows = rows.withColumns({"h": high, "l": low, "n": cidr6_prefix("c")})
    first, last = network6("h", "l", "n"), last6("h", "l", "n")
    for r in rows.select("p", *[c.alias(f"c{i}") for i, c in enumerate((*first, *last))]).collect():
        net = ipaddress.ip_network((n, r.p), strict=False)
        ends = [x for end in (net[0], net[-1]) for x in (_signed(int(end) >> 64), _signed(int(end) & ((1 << 64) - 1)))]
        assert list(r[1:]) == ends
    odd = spark.createDataFrame([("::/129",), ("::/",), ("::",), ("::/x",), ("::/007",), (None,)], "c string")
    assert {r[0] for r in odd.select(cidr6_prefix("c")).collect()} == {None}


def _tables(seed):
    rng = random.Random(seed)
    blocks = [("::/0", 1), ("8000::/1", 2), ("2001:db8::/32", 3), ("2001:db8::/32", 4), ("0.0.0.0/0", 5), ("10.0.0.0/8", 6), ("2000::/9", 7)]
    corner = int(ipaddress.IPv6Address("2001:db8::"))
    for i in range(50):
        p = rng.choice([11, 12, 13, 16, 17, 33, 48, 63, 64, 65, 90, 126, 127, 128])
        n = corner + (rng.randrange(1 << 18) << rng.choice([0, 60, 78]))
        blocks.append((str(ipaddress.ip_network((n, p), strict=False)), 10 + i))
    blocks += [(str(ipaddress.ip_network(((10 << 24) + rng.randrange(1 << 16), rng.choice([16, 24, 30, 31, 32])), strict=False)), 100 + i) for i in range(15)]
    addresses = {"::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "::ffff:10.0.0.1", "10.0.0.1", "255.255.255.255"}
    for text, _ in blocks:
        net = ipaddress.ip_network(text)
        top = (1 << net.max_prefixlen) - 1
        for n in (int(net[0]), int(net[-1]), max(int(net[0]) - 1, 0), min(int(net[-1]) + 1, top), rng.randint(int(net[0]), int(net[-1]))):
            addresses.add(str((ipaddress.IPv6Address if net.version == 6 else ipaddress.IPv4Address)(n)))
    return blocks, sorted(addresses)


def _expected(blocks, addresses, bounds, match):
    nets = [(ipaddress.ip_network(t), t, g) for t, g in blocks]
    rows = []
    for text in addresses:
        a = ipaddress.ip_address(text)
        found = []
        for net, t, g in nets:
            if a.version == net.version and a in net and (bounds == "inclusive" or a not in (net[0], net[-1])):
                found.append((-net.prefixlen, t, g))
        rows += [(text, t, g) for _, t, g in ([min(found)] if found and match == "longest" else found)]
    return sorted(rows)


@pytest.mark.parametrize("bounds", ["inclusive", "strict"])
@pytest.mark.parametrize("match", ["all", "longest"])
def test_mixed_tables_equal_brute_force(spark, bounds, match):
    blocks, addresses = _tables(3)
    odd = [("no block", 1), (None, 2), ("::/129", 3), ("1.2.3.4/40", 4), ("12345::/8", 5), ("::", 6)]
    rows = spark.createDataFrame([(a,) for a in addresses] * 2 + [(None,), ("text",), ("::x",)], "ip string")
    got = mixed_join(rows, spark.createDataFrame(blocks + odd, "network string, g long"), bounds=bounds, match=match)
    assert sorted(tuple(r) for r in got.collect()) == sorted(_expected(blocks, addresses, bounds, match) * 2)


@pytest.mark.parametrize("match", ["all", "longest"])
def test_large_blocks_are_shuffled(spark, match):
    blocks, addresses = _tables(4)
    six = [a for a in addresses if ":" in a]
    high, low = ip6_parts("ip")
    rows = spark.createDataFrame([(a,) for a in six], "ip string").withColumns({"ip_high": high, "ip_low": low})
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = cidr6_join(rows, spark.createDataFrame(blocks, "network string, g long"), match=match, broadcast_bytes=0)
        plan = got._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert sorted((r.ip, r.network, r.g) for r in got.collect()) == _expected(blocks, six, "inclusive", match)
    finally:
        spark.conf.set(key, before)


def test_longest_match_meets_a_network_once(spark, monkeypatch):
    from tillscope.operators import geojoin6

    entered = []
    whole = geojoin6._entries
    monkeypatch.setattr(geojoin6, "_entries", lambda ranges: entered.append(ranges) or whole(ranges))
    rows = [("2001:db8::/40", i) for i in (7, 3, 5, None)] + [("2001:db8:0::/40", 4), ("2001:db8::/33", 1), ("2001:db8:1::1/128", 9)]
    blocks = spark.createDataFrame(rows, "network string, n int")
    addresses = spark.createDataFrame([("2001:db8:1::1",), ("2001:db8:ff::",), ("2001:db8:1::1",), ("2001:db8:100::",)], "ip string")
    found = {b: sorted(tuple(r) for r in mixed_join(addresses, blocks, match="longest", bounds=b).collect()) for b in ("inclusive", "strict")}
    of_40, of_33 = ("2001:db8:0::/40", 4), ("2001:db8::/33", 1)
    inner, other, outer = "2001:db8:1::1", "2001:db8:ff::", "2001:db8:100::"
    assert found["inclusive"] == sorted([(inner, "2001:db8:1::1/128", 9)] * 2 + [(other, *of_40), (outer, *of_33)])
    assert found["strict"] == sorted([(inner, *of_40)] * 2 + [(other, *of_40), (outer, *of_33)])
    assert [r.count() for r in entered] == [3, 3]


def test_texts_of_groups_are_read_above_the_grouping(spark):
    from tillscope.operators.computed import as_computed

    sums = spark.range(9).selectExpr("CAST(id AS STRING) AS ip", "id AS sump").groupBy("ip").sum("sump").withColumn("long", F.length("ip"))
    out = as_computed(sums).filter("long = 1 AND ip <> '4'")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Aggregate") and "Filter" not in plan[plan.index("Aggregate") :]
    assert out.count() == 8 and out.columns == sums.columns
