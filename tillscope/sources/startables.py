"""The three tables as views over the star-schema test tables.

Every line item is a purchase; its order stands for the address it came from. Customers
and suppliers own address blocks, their nations are the countries. All three are plain
projections of one or two narrow scans, apart from the blocks' duplicate removal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import long_to_ip, network_of
from tillscope.functions.address import long_to_ip_sql

# Spreads keys over the address space. Odd, so keys below 2^32 stay distinct; below 2^31,
# so the product of a key and the factor fits a BIGINT.
SPREAD = 1640531527
SPACE = 4294967296

# 203.0.113.7, of a range reserved for examples.
SHARED_ADDRESS = 3405803783


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(key: str, offset: int = 0) -> str:
    """SQL expression of an address for a key."""
    return f"((({key} % {SPACE}L) * {SPREAD}L + {offset}L) % {SPACE}L)"


def order_address(key: str) -> str:
    """SQL expression of the address an order came from.

    A quarter of the orders share one address, and of the others every eleventh lies on the
    first and every eleventh on the last address of a /16.
    """
    address = spread(key)
    edge = f"shiftleft(shiftright({address}, 16), 16)"
    return (
        f"(CASE WHEN {key} % 4 = 3 THEN {SHARED_ADDRESS}L WHEN {key} % 11 = 0 THEN {edge}"
        f" WHEN {key} % 11 = 1 THEN {edge} + 65535L ELSE {address} END)"
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, price, ts, category (sometimes NULL), ip."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.withColumn("address", F.expr(order_address("l_orderkey"))).select(
        F.expr("concat('product', l_partkey)").alias("name"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("ts"),
        F.expr(
            "CASE WHEN l_partkey % 97 <> 13 THEN concat('category', l_suppkey % 25) END"
        ).alias("category"),
        long_to_ip("address").alias("ip"),
    )


def events_as_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as purchases: name, price, ts, category, ip."""
    return table(spark, sf_dir, "events").select(
        F.expr("concat('user_', user_id)").alias("name"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_type").alias("category"),
        F.expr(long_to_ip_sql(spread("user_id"))).alias("ip"),
    )


def _below_224(address: str) -> str:
    """The address, or for one from 224.0.0.0 up its distance from there, in SQL."""
    return f"({address}) % 3758096384L"


def block_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per owner: address, prefix_len, geoname_id.

    Customers' blocks never overlap each other, as the length (8 to 16) depends on the
    first octet alone. Suppliers' blocks (9 to 13) overlap them. All lie below
    224.0.0.0.
    """
    customers = table(spark, sf_dir, "customer").select(
        F.expr(_below_224(spread("c_custkey"))).alias("address"),
        F.col("c_nationkey").cast("long").alias("geoname_id"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.expr(_below_224(spread("s_suppkey", offset=123456789))).alias("address"),
        F.expr("CAST(9 + s_suppkey % 5 AS INT)").alias("prefix_len"),
        F.col("s_nationkey").cast("long").alias("geoname_id"),
    )
    lengths = F.expr("CAST(8 + shiftright(address, 24) % 9 AS INT)")
    return customers.withColumn("prefix_len", lengths).unionByName(suppliers)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address blocks, one row per network."""
    return (
        block_owners(spark, sf_dir)
        .withColumn("first", network_of("address", "prefix_len"))
        .groupBy("first", "prefix_len")
        .agg(F.min("geoname_id").alias("geoname_id"))
        .select(
            F.concat(long_to_ip("first"), F.lit("/"), "prefix_len").alias("network"),
            "geoname_id",
            F.col("geoname_id").alias("registered_country_geoname_id"),
            F.expr("IF(geoname_id % 7 = 0, geoname_id, NULL)").alias(
                "represented_country_geoname_id"
            ),
            (F.col("geoname_id") % 5 == 0).alias("is_anonymous_proxy"),
            (F.col("prefix_len") == 9).alias("is_satellite_provider"),
        )
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country names, one row per nation."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("long").alias("geoname_id"),
        F.lit("en").alias("locale_code"),
        F.substring("r_name", 1, 2).alias("continent_code"),
        F.col("r_name").alias("continent_name"),
        F.expr("IF(n_nationkey % 10 = 9, NULL, concat('N', n_nationkey))").alias(
            "country_iso_code"
        ),
        F.col("n_name").alias("country_name"),
        (F.col("n_regionkey") == 3).alias("is_in_e"),
    )
