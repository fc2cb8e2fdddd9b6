"""The ranking reports. Purchases have name, price, category and ip; blocks have network
and geoname_id; countries have geoname_id and country_name.

Every report is an aggregate of the purchases and a ranking of that aggregate. The `rank_*`
functions take the aggregate, so that several reports can share one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions import exact_money, ip_to_long, money_of
from tillscope.operators import (
    BlockIndex,
    block_index,
    cidr_join,
    count_by,
    top_k,
    top_k_per_group,
    top_sums,
)
from tillscope.operators.aggregates import exact_by_ip
from tillscope.operators.pruning import BUCKETS


def rank_categories(counts: DataFrame, k: int | None = 10) -> DataFrame:
    return top_k(counts.select("category", "cnt"), "cnt", "category", k=k)


def rank_products(counts: DataFrame, k: int | None = 10) -> DataFrame:
    """Of counts by (name, category). Joining them to the list of categories has only one
    effect, to drop those without a category, so a filter takes its place."""
    known = counts.where(F.col("category").isNotNull())
    return top_k(known.select("name", "category", "cnt"), "cnt", "name", "category", k=k)


def rank_products_per_category(counts: DataFrame, k: int = 10) -> DataFrame:
    known = counts.where(F.col("category").isNotNull())
    return top_k_per_group(known.select("category", "name", "cnt"), "category", "cnt", "name", k=k)


def rank_ips(spent: DataFrame, k: int | None = 10) -> DataFrame:
    return top_k(spent, "spent", "ip", k=k).select("ip", money_of("spent").alias("sump"))


def top_categories(purchases: DataFrame, k: int | None = 10) -> DataFrame:
    """Categories with the most purchases: category, cnt."""
    return rank_categories(count_by(purchases, "category"), k)


def top_products(purchases: DataFrame, k: int | None = 10) -> DataFrame:
    """Products with the most purchases, with their category: name, category, cnt."""
    return rank_products(count_by(purchases, "name", "category"), k)


def top_products_per_category(purchases: DataFrame, k: int = 10) -> DataFrame:
    """The k most purchased products of each category: category, name, cnt, rank."""
    return rank_products_per_category(count_by(purchases, "name", "category"), k)


def top_ips(purchases: DataFrame, k: int | None = 10) -> DataFrame:
    """Addresses that spend most: ip, sump."""
    return rank_ips(exact_by_ip(purchases), k)


def top_ips_pruned(purchases: DataFrame, k: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """`top_ips` in which addresses out of reach of the first k are not shuffled.

    For many addresses of which few spend much; the purchases are read three times.
    """
    spent = top_sums(purchases, "ip", exact_money("price"), k=k, name="spent", buckets=buckets)
    return rank_ips(spent, k)


def geo_blocks(blocks: DataFrame) -> BlockIndex:
    """Index over just the block columns that the reports use."""
    return block_index(blocks.select("network", "geoname_id"))


def _index(blocks: DataFrame | BlockIndex) -> BlockIndex:
    return blocks if isinstance(blocks, BlockIndex) else geo_blocks(blocks)


def place_ips(
    spenders: DataFrame,
    blocks: DataFrame | BlockIndex,
    countries: DataFrame,
    *,
    at_most: int | None,
    k: int | None = 10,
    bounds: str = "inclusive",
    match: str = "all",
) -> DataFrame:
    """Top addresses (ip, sump; no more than `at_most`) with their country."""
    # The text is parsed for the addresses that are left. Two texts may mean one address,
    # so the addresses are not unique.
    addresses = spenders.withColumn("ip_long", ip_to_long("ip"))
    placed = cidr_join(
        addresses, _index(blocks), bounds=bounds, match=match, at_most=at_most
    ).join(countries.select("geoname_id", "country_name"), "geoname_id")
    return top_k(
        placed.select("sump", "ip", "geoname_id", "country_name", "network"),
        "sump",
        "ip",
        "network",
        "geoname_id",
        k=k,
    )


def top_ip_countries(
    purchases: DataFrame,
    blocks: DataFrame | BlockIndex,
    countries: DataFrame,
    *,
    pre_k: int | None = 100,
    k: int | None = 10,
    bounds: str = "inclusive",
    match: str = "all",
) -> DataFrame:
    """Top spenders with their country: sump, ip, geoname_id, country_name, network.

    Only the `pre_k` addresses that spend most are looked up, and those in no block of a
    known country drop out before the final k are taken.
    """
    spenders = top_ips(purchases, pre_k)
    return place_ips(
        spenders, blocks, countries, at_most=pre_k, k=k, bounds=bounds, match=match
    )


def rank_countries(placed: DataFrame, countries: DataFrame, k: int | None = 10) -> DataFrame:
    """Of rows (geoname_id, spent), however many for a country."""
    # Summed by id first, so that the names meet one row per country.
    spend = placed.groupBy("geoname_id").agg(F.sum("spent").alias("spent"))
    by_name = (
        spend.join(countries.select("geoname_id", "country_name"), "geoname_id")
        .groupBy("country_name")
        .agg(money_of(F.sum("spent")).alias("sump"))
    )
    return top_k(by_name, "sump", "country_name", k=k)


def top_countries(
    purchases: DataFrame,
    blocks: DataFrame | BlockIndex,
    countries: DataFrame,
    *,
    k: int | None = 10,
    bounds: str = "inclusive",
    match: str = "longest",
) -> DataFrame:
    """Countries that spend most, over all addresses: country_name, sump.

    A purchase counts once, for the most specific block that holds its address; with
    match='all' it counts for every such block. With small blocks every purchase is looked up where it is read, and what is
    shuffled is one row per country and task. Else the purchases are first summed by address,
    so that the join shuffles each address once.
    """
    index = _index(blocks)
    spend = purchases.select(ip_to_long("ip").alias("ip_long"), exact_money("price").alias("spent"))
    if match != "all" or not index.small:
        spend = spend.groupBy("ip_long").agg(F.sum("spent").alias("spent"))
    placed = cidr_join(spend, index, bounds=bounds, match=match)
    return rank_countries(placed, countries, k)


@dataclass(frozen=True)
class ReportSet:
    """All reports over two shared aggregates. Call `release` when they have been used."""

    frames: dict[str, DataFrame]
    shared: tuple[DataFrame, ...]

    def release(self) -> None:
        for aggregate in self.shared:
            aggregate.unpersist()


def all_reports(
    purchases: DataFrame,
    blocks: DataFrame | BlockIndex,
    countries: DataFrame,
    *,
    k: int = 10,
    pre_k: int = 100,
    bounds: str = "inclusive",
    match: str | None = None,
) -> ReportSet:
    """Every report, from two passes over the purchases in place of one for each.

    `match` is for both lookups; by default an address has every block that holds it, and a
    country's total counts a purchase once.

    The counts by (name, category) and the sums by address are kept on the executors,
    spilling to disk; they are what all six reports are ranked from.
    """
    index = _index(blocks)
    counts = count_by(purchases, "name", "category").persist(StorageLevel.MEMORY_AND_DISK)
    spent = exact_by_ip(purchases).persist(StorageLevel.MEMORY_AND_DISK)
    by_category = counts.groupBy("category").agg(F.sum("cnt").alias("cnt"))
    # Texts that mean one address are brought together, as a lookup per text would do.
    by_address = spent.groupBy("ip_long").agg(F.sum("spent").alias("spent"))
    placed = cidr_join(
        by_address, index, bounds=bounds, match=match or "longest"
    )
    frames = {
        "top_categories": rank_categories(by_category, k),
        "top_products": rank_products(counts, k),
        "top_products_per_category": rank_products_per_category(counts, k),
        "top_ips": rank_ips(spent, k),
        "top_ip_countries": place_ips(
            rank_ips(spent, pre_k),
            index,
            countries,
            at_most=pre_k,
            k=k,
            bounds=bounds,
            match=match or "all",
        ),
        "top_countries": rank_countries(placed, countries, k),
    }
    return ReportSet(frames, (counts, spent))
