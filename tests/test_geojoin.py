"""The cell join against brute force over all pairs, in plain Python."""

import ipaddress
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillscope.operators import block_index, cidr_join, segments

BAD_BLOCKS = [("1.2.3.4", 90), (None, 91), ("2001:db8::/32", 92), ("1.2.3.4/40", 93)]


def _random_blocks(rng):
    blocks = [("0.0.0.0/0", 1), ("128.0.0.0/1", 2), ("10.0.0.0/8", 3), ("10.0.0.0/8", 4)]
    for i in range(60):
        prefix = rng.choice([3, 7, 11, 12, 13, 15, 16, 17, 20, 24, 30, 31, 32])
        # Two crowded corners make blocks nest.
        corner = rng.choice([10 << 24, 200 << 24])
        address = corner + rng.randrange(1 << 17)
        network = ipaddress.ip_network((address, prefix), strict=False)
        blocks.append((str(network), 10 + i))
    return blocks


def _random_addresses(rng, blocks):
    addresses = {0, 4294967295}
    for network, _ in blocks:
        net = ipaddress.ip_network(network)
        first, last = int(net[0]), int(net[-1])
        addresses |= {first, last, max(first - 1, 0), min(last + 1, 4294967295)}
        addresses.add(rng.randint(first, last))
    return sorted(addresses)


def _expected(addresses, blocks, bounds, match):
    rows = []
    for address in addresses:
        found = []
        for network, geoname_id in blocks:
            net = ipaddress.ip_network(network)
            first, last = int(net[0]), int(net[-1])
            inside = first <= address <= last if bounds == "inclusive" else first < address < last
            if inside:
                found.append((net.prefixlen, network, geoname_id))
        if match == "longest" and found:
            longest = max(f[0] for f in found)
            found = [min(f for f in found if f[0] == longest)]
        rows += [(address, network, geoname_id) for _, network, geoname_id in found]
    return sorted(rows)


@pytest.fixture(params=["broadcast", "shuffle", "few"])
def join_mode(request, spark):
    """Both ways the blocks may reach the probes."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param == "shuffle":
        spark.conf.set(key, "-1")
    yield request.param
    spark.conf.set(key, before)


@pytest.mark.parametrize("bounds", ["inclusive", "strict"])
@pytest.mark.parametrize("match", ["all", "longest"])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, join_mode, bounds, match, seed):
    rng = random.Random(seed)
    blocks = _random_blocks(rng)
    addresses = _random_addresses(rng, blocks)
    index = block_index(
        spark.createDataFrame(blocks + BAD_BLOCKS, "network STRING, geoname_id LONG"),
        broadcast_bytes=10**30 if join_mode == "broadcast" else 0,
    )
    rows = spark.createDataFrame([(a,) for a in addresses] + [(None,)], "ip_long LONG")
    at_most = 1000 if join_mode == "few" else None
    if join_mode == "few":
        rows = rows.limit(at_most)  # what the plan proves; rows alone prove no number
    joined = cidr_join(rows, index, bounds=bounds, match=match, at_most=at_most)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("SortMergeJoin" in plan) == (join_mode == "shuffle")
    got = sorted(tuple(r) for r in joined.collect())
    assert got == _expected(addresses, blocks, bounds, match)


@pytest.mark.parametrize("match", ["all", "longest"])
def test_repeated_addresses_are_kept(spark, join_mode, match):
    """A third of all rows shares one address; every row comes out as often as it went in."""
    blocks = [("10.0.0.0/8", 1), ("10.1.0.0/16", 2), ("20.0.0.0/6", 3)]
    index = block_index(
        spark.createDataFrame(blocks, "network STRING, geoname_id LONG"),
        broadcast_bytes=10**30 if join_mode == "broadcast" else 0,
    )
    hot = int(ipaddress.ip_address("10.1.2.3"))
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(hot))
        .otherwise(F.lit(int(ipaddress.ip_address("20.0.0.0"))) + F.col("id"))
        .alias("ip_long"),
    )
    if join_mode == "few":
        rows = rows.limit(3000)
    counts = {
        r.geoname_id: r.cnt
        for r in cidr_join(rows, index, match=match, at_most=3000 if join_mode == "few" else None)
        .groupBy("geoname_id")
        .agg(F.count("id").alias("cnt"))
        .collect()
    }
    expected = {1: 1000, 2: 1000, 3: 2000} if match == "all" else {2: 1000, 3: 2000}
    assert counts == expected


def test_a_promise_that_the_plan_does_not_prove_is_not_believed(spark):
    """Addresses that only the caller calls few are not broadcast, and all are joined."""
    index = block_index(spark.createDataFrame([("10.0.0.0/8", 1)], "network STRING, g LONG"), broadcast_bytes=0)
    rows = spark.createDataFrame([(167772160 + i,) for i in range(2000)], "ip_long LONG")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        joined = cidr_join(rows, index, at_most=10)
        assert "SortMergeJoin" in joined._jdf.queryExecution().toString()
        assert joined.count() == 2000
        proven = cidr_join(rows.limit(10), index, at_most=10)
        assert "SortMergeJoin" not in proven._jdf.queryExecution().toString()
    finally:
        spark.conf.set(key, before)


def test_hot_address_is_split_in_the_shuffle(spark):
    """A third of all rows on one join key: Spark cuts its partition into several tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    index = block_index(
        spark.range(200).select(
            F.format_string("%d.0.0.0/8", "id").alias("network"), F.col("id").alias("g")
        ),
        broadcast_bytes=0,
    )
    rows = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.expr("IF(id % 3 = 0, 167772161L, pmod(xxhash64(id), 200L * 16777216))").alias("ip_long"),
    )
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        joined = cidr_join(rows, index)
        assert joined.where("g = 10").count() > 20_000
        assert joined.agg(F.count("id")).first()[0] == 60_000
        counted = joined.groupBy("g").agg(F.count("id"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_no_join_key_stands_for_a_large_part_of_the_space(spark):
    index = block_index(
        spark.createDataFrame([("0.0.0.0/0", 1), ("64.0.0.0/10", 2)], "network STRING, g LONG")
    )
    assert index.entries.where("_len = 0").count() == 4096
    assert index.entries.where("_len = 10").count() == 4
    assert index.entries.select("_key").distinct().count() == 4100


def test_presence_is_bounded_by_the_space(spark):
    copies = spark.range(500).select(F.lit("0.0.0.0/0").alias("network"), F.col("id").alias("g"))
    index = block_index(copies)
    assert index.presence.count() == 65536
    assert index.presence.agg(F.max(F.size("_lens"))).first()[0] == 1


@pytest.mark.parametrize("bounds", ["inclusive", "strict"])
def test_longest_match_in_crowded_areas(spark, join_mode, bounds):
    """A /16 of thousands of blocks, one of as many as CROWDED, and blocks that span areas."""
    rng = random.Random(7)
    blocks = [("10.0.0.0/7", 1), ("10.1.0.0/16", 2), ("10.0.0.0/15", 3)]
    for i in range(3000):
        blocks.append((str(ipaddress.ip_network(((10 << 24) + (1 << 16) + rng.randrange(1 << 16), rng.randrange(20, 33)), strict=False)), 10 + i))
    blocks += [(f"11.7.{i}.0/24", 5000 + i) for i in range(0, 2 * segments.CROWDED, 2)]
    numbered = sorted(set(blocks))
    addresses = sorted({(10 << 24) + (1 << 16) + rng.randrange(-300, (1 << 16) + 300) for _ in range(4000)} | {(11 << 24) + (7 << 16) + i * 100 for i in range(500)})
    index = block_index(
        spark.createDataFrame(numbered, "network STRING, geoname_id LONG"),
        broadcast_bytes=10**30 if join_mode == "broadcast" else 0,
    )
    rows = spark.createDataFrame([(a,) for a in addresses], "ip_long LONG")
    if join_mode == "few":
        rows = rows.limit(10_000)
    joined = cidr_join(rows, index, bounds=bounds, match="longest", at_most=10_000 if join_mode == "few" else None)
    held = [(int(n[0]), int(n[-1]), n.prefixlen, text, g) for text, g in numbered for n in [ipaddress.ip_network(text)]]
    edge = bounds == "strict"
    expected = []
    for a in addresses:
        found = [(-p, text, g) for first, last, p, text, g in held if first + edge <= a <= last - edge]
        expected += [(a, *min(found)[1:])] if found else []
    assert sorted(tuple(r) for r in joined.collect()) == expected
    most = index.segments(bounds).groupBy("_key").count().agg(F.max("count")).first()[0]
    assert most <= 256


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1023), st.integers(0, 10)), max_size=30))
def test_sweep_gives_each_address_its_most_specific_block(drawn):
    """On a space of ten bits, in cells of seven."""
    blocks = {(n, x >> (10 - n) << (10 - n)) for x, n in drawn}
    entries = []
    for n, first in blocks:
        last = first + (1 << (10 - n)) - 1
        for cell in range(first >> 7, (last >> 7) + 1):
            entries.append((cell, max(first, cell << 7), n, min(last, (cell << 7) + 127), (n, first)))
    got = {}
    for lo, hi, row in segments.swept((c, lo, hi, row) for c, lo, _, hi, row in sorted(entries)):
        for x in range(lo, hi + 1):
            assert x not in got
            got[x] = row
    covers = {x: [b for b in blocks if x >> (10 - b[0]) << (10 - b[0]) == b[1]] for x in range(1024)}
    assert got == {x: max(found) for x, found in covers.items() if found}


def test_longest_match_reads_the_blocks_once_and_joins_once(spark, tmp_path):
    spark.createDataFrame([("10.0.0.0/8", 1)], "network STRING, geoname_id LONG").write.parquet(str(tmp_path / "b"))
    rows = spark.range(100).select((F.col("id") + (10 << 24)).alias("ip_long"))
    joined = cidr_join(rows, block_index(spark.read.parquet(str(tmp_path / "b"))), match="longest")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("HashJoin") + plan.count("SortMergeJoin") == 1


def test_wrong_arguments(spark):
    index = block_index(spark.createDataFrame([("1.0.0.0/8", 1)], "network STRING, g LONG"))
    rows = spark.createDataFrame([(1, 2)], "ip_long LONG, g LONG")
    with pytest.raises(ValueError, match="both sides"):
        cidr_join(rows, index)
    with pytest.raises(ValueError, match="bounds"):
        cidr_join(rows.drop("g"), index, bounds="open")
    with pytest.raises(ValueError, match="match"):
        cidr_join(rows.drop("g"), index, match="any")
