"""Random purchases as a distributed job.

Each row draws from a digest of the seed and its own id, so the rows depend neither on
the partitioning nor on task retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import long_to_ip

# Days and price distribution of the generated purchases.
FIRST_DAY = "2010-10-15"
DAYS = 7
PRICE_MEAN = 500
PRICE_SD = 10
DAY_MS = 86400000

_DRAWS = 8


def _draws(row_id: str, seed: int) -> list[str]:
    """Eight 32-bit integers: the two digests of a row, cut into four pieces each."""
    return [
        f"CAST(conv(substr(md5(concat('{seed}:{half}:', {row_id})), {1 + 8 * piece}, 8), 16, 10)"
        " AS BIGINT)"
        for half in range(2)
        for piece in range(_DRAWS // 2)
    ]


def _gauss(u: str, v: str) -> str:
    """Standard normal from two 32-bit draws; the shift by half keeps ln away from 0."""
    return f"(sqrt(-2 * ln(({u} + 0.5D) / 4294967296D)) * cos(2 * pi() * {v} / 4294967296D))"


def add_purchases(
    ids: DataFrame, row_id: str = "id", *, products: int = 20, categories: int = 20, seed: int = 42
) -> DataFrame:
    """One purchase per row of `ids`: the id, then name, price, ts, category, ip.

    Product, category and the four octets are uniform; the price is normal to one decimal;
    the time is a uniform day plus a normal offset of one day's deviation, so some purchases
    fall outside the days.
    """
    draws = {f"u{i}": F.expr(d) for i, d in enumerate(_draws(row_id, seed))}
    drawn = ids.select(F.col(row_id), *[c.alias(n) for n, c in draws.items()])
    offset = f"CAST({_gauss('u6', 'u7')} * {DAY_MS} AS BIGINT)"
    day = f"shiftright(u5 * {DAYS}L, 32)"
    return drawn.select(
        row_id,
        F.expr(f"concat('product', shiftright(u0 * {products}L, 32))").alias("name"),
        F.expr(f"round({_gauss('u3', 'u4')} * {PRICE_SD} + {PRICE_MEAN}, 1)").alias("price"),
        F.expr(
            f"timestampadd(MILLISECOND, {day} * {DAY_MS}L + {offset},"
            f" TIMESTAMP_NTZ'{FIRST_DAY} 00:00:00')"
        ).alias("ts"),
        F.expr(f"concat('category', shiftright(u1 * {categories}L, 32))").alias("category"),
        long_to_ip("u2").alias("ip"),
    )


def synthetic_purchases(
    spark: SparkSession, rows: int, *, products: int = 20, categories: int = 20, seed: int = 42
) -> DataFrame:
    """`rows` random purchases: name, price, ts, category, ip."""
    return add_purchases(
        spark.range(rows), products=products, categories=categories, seed=seed
    ).drop("id")
