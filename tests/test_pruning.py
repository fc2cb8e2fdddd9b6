"""Top-k sums that drop keys before the shuffle, against plain sums."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillscope.operators import in_reach_of_top, top_sums
from tillscope.plans import reports
from tillscope.registered import QUERIES


def _plain(rows, k):
    sums = defaultdict(lambda: None)
    for key, amount in rows:
        sums[key] = sums[key] if amount is None else (sums[key] or 0) + amount
    order = sorted(sums.items(), key=lambda x: (x[1] is None, -(x[1] or 0), x[0] is not None, x[0] or ""))
    return order[:k]


def _rows(kind):
    rng = random.Random(kind)
    light = [(f"l{i}", rng.randrange(0, 4)) for i in range(3000) for _ in range(2)]
    heavy = [(f"h{i}", rng.randrange(50, 90)) for i in range(12) for _ in range(40)]
    return {
        "heavy": light + heavy,
        "alike": light,
        "ties": [(f"t{i}", 5) for i in range(40)] + [(f"u{i}", 1) for i in range(500)],
        "negative": light + heavy + [("h3", -5000), ("l7", -1)],
        "one key": [("x", 3)] * 900 + [("y", 2)],
        "few": [("a", 1), ("b", None), ("c", 0)],
        "nulls": light + [(None, 60)] * 20 + [("n", None)] * 5 + heavy[:80] + [("v", None)],
        "only nulls": [("a", None), (None, None)],
        "empty": [],
    }[kind]


@pytest.mark.parametrize("kind", ["heavy", "alike", "ties", "negative", "one key", "few", "nulls", "only nulls", "empty"])
@pytest.mark.parametrize("buckets", [1, 64, 4096])
def test_equals_plain_sums(spark, kind, buckets):
    rows = _rows(kind)
    # `bucket` and `total` are the caller's own here.
    df = spark.createDataFrame([(*r, "b", 1) for r in rows], "key STRING, amount BIGINT, bucket STRING, total INT").repartition(5)
    got = top_sums(df, "key", F.col("amount"), k=7, name="sum", buckets=buckets).collect()
    assert [(r["key"], r["sum"]) for r in got] == _plain(rows, 7)


def test_most_keys_end_at_the_scan(spark):
    rows = _rows("heavy")
    df = spark.createDataFrame(rows, "key STRING, amount BIGINT")
    left = {r["key"] for r in in_reach_of_top(df, "key", F.col("amount"), 7, 4096).select("key").distinct().collect()}
    assert {key for key, _ in _plain(rows, 7)} <= left and len(left) < 60
    plan = top_sums(df, "key", F.col("amount"), k=7)._jdf.queryExecution().executedPlan().toString()
    for node in ("NestedLoopJoin", "CartesianProduct", "SinglePartition, REPARTITION"):
        assert node not in plan
    assert "LeftSemi" in plan
    # With a negative amount a sum of a bucket bounds nothing.
    negative = df.union(spark.createDataFrame([("l0", -1)], "key STRING, amount BIGINT"))
    assert in_reach_of_top(negative, "key", F.col("amount"), 7, 4096).count() == len(rows) + 1


def test_report_equals_the_plain_one(spark, sf_dir):
    from tillscope.sources import startables

    assert QUERIES["top_ips_pruned"](spark, sf_dir).collect() == QUERIES["top_ips"](spark, sf_dir).collect()
    purchases = startables.purchases(spark, sf_dir)
    for k, buckets in ((1, 1 << 12), (100, 1 << 16)):
        assert reports.top_ips_pruned(purchases, k, buckets).collect() == reports.top_ips(purchases, k).collect()
    with pytest.raises(ValueError):
        reports.top_ips_pruned(purchases, 10, 0)
