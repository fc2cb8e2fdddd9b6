"""Counts and sums. All combine before the shuffle, so a key that holds a large part of
the rows reaches the final step as one row per input partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import exact_money, ip_to_long, money_of

SALTS = 32


def count_by(purchases: DataFrame, *keys: str, name: str = "cnt") -> DataFrame:
    """Number of rows for each combination of keys."""
    return purchases.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_category_total(counts: DataFrame) -> DataFrame:
    """Add category_cnt to counts by (name, category); rows without a category drop out.

    The totals are sums of the counts, so the purchases are scanned and shuffled once: both
    join inputs read the same exchange. Categories are few and some are large, so each total
    is repeated SALTS times and the counts are spread over the copies by their name.
    """
    salts = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)]))
    totals = counts.groupBy("category").agg(F.sum("cnt").alias("category_cnt"))
    salted = counts.withColumn("_salt", F.xxhash64("name").bitwiseAND(F.lit(SALTS - 1).cast("long")))
    return salted.join(totals.withColumn("_salt", salts), ["category", "_salt"]).select(
        "name", "category", "cnt", "category_cnt"
    )


def exact_by_ip(purchases: DataFrame) -> DataFrame:
    """ip, ip_long and the money spent. The integer form is derived after the grouping."""
    return (
        purchases.groupBy("ip")
        .agg(F.sum(exact_money("price")).alias("spent"))
        .withColumn("ip_long", ip_to_long("ip"))
    )


def spend_by_ip(purchases: DataFrame) -> DataFrame:
    """Money spent per address text: ip, ip_long, sump."""
    return exact_by_ip(purchases).select("ip", "ip_long", money_of("spent").alias("sump"))


def spend_by_ip_long(purchases: DataFrame) -> DataFrame:
    """Money spent per address, whatever way it is written: ip_long, sump."""
    return (
        purchases.select(ip_to_long("ip").alias("ip_long"), exact_money("price").alias("spent"))
        .groupBy("ip_long")
        .agg(F.sum("spent").alias("spent"))
        .select("ip_long", money_of("spent").alias("sump"))
    )
