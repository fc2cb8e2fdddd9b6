"""Temporary views for SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import (
    cidr_first,
    cidr_last,
    day_text,
    epoch_ms,
    ip_to_long,
    register_functions,
)
from tillscope.plans.reports import top_ips


def product_view(purchases: DataFrame) -> DataFrame:
    """Purchases under their SQL names, with the derived columns."""
    return purchases.select(
        "name",
        "price",
        F.col("price").cast("float").alias("priceAsFloat"),
        F.col("ts").alias("dt1"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("date"),
        epoch_ms("ts").alias("dateAsLong"),
        "category",
        F.col("ip").alias("IP"),
        ip_to_long("ip").alias("IPAsLong"),
        day_text("ts").alias("dt"),
    )


def country_name_view(countries: DataFrame) -> DataFrame:
    """Country names under both spellings of their columns."""
    return countries.withColumns(
        {"geonameId": F.col("geoname_id"), "countryName": F.col("country_name")}
    )


def country_ip_view(blocks: DataFrame) -> DataFrame:
    """Blocks under both spellings of their columns, with their bounds."""
    return blocks.withColumns(
        {
            "geonameId": F.col("geoname_id"),
            "startIPAsLong": cidr_first("network"),
            "endIPAsLong": cidr_last("network"),
        }
    )


def top_ip_view(purchases: DataFrame, k: int = 10) -> DataFrame:
    """Top addresses with their integer form: ip, iip, sump."""
    return top_ips(purchases, k).select("ip", ip_to_long("ip").alias("iip"), "sump")


def block_bounds_view(blocks: DataFrame) -> DataFrame:
    """Bounds of the blocks: geoname_id, startip, endip."""
    return blocks.select(
        "geoname_id", cidr_first("network").alias("startip"), cidr_last("network").alias("endip")
    )


def register_views(
    spark: SparkSession, purchases: DataFrame, countries: DataFrame, blocks: DataFrame
) -> None:
    """Create product, countryname, countryip, vproduct and vcountryip, and the functions."""
    register_functions(spark)
    views = {
        "product": product_view(purchases),
        "countryname": country_name_view(countries),
        "countryip": country_ip_view(blocks),
        "vproduct": top_ip_view(purchases),
        "vcountryip": block_bounds_view(blocks),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
