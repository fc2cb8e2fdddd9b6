"""Sorting and top-k with a total order, so that ties never make a result vary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(by: str, ties: tuple[str, ...]) -> list:
    return [F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in ties]]


def sort_desc(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """All rows, largest `by` first: a range-partitioned sort."""
    return df.orderBy(*_order(by, ties))


def top_k(df: DataFrame, by: str, *ties: str, k: int | None = 10) -> DataFrame:
    """The k rows with the largest `by`; all rows in order if k is None.

    With a limit each task keeps k rows, so nothing is sorted or shuffled as a whole.
    """
    ordered = sort_desc(df, by, *ties)
    return ordered if k is None else ordered.limit(k)


def top_k_per_group(
    df: DataFrame, group: str, by: str, *ties: str, k: int = 10, rank: str = "rank"
) -> DataFrame:
    """The k rows with the largest `by` in each group, numbered from 1 in column `rank`.

    Tasks cut every group to k rows before the shuffle, so a group that holds most rows
    reaches its task as k rows per input partition.
    """
    within = Window.partitionBy(group).orderBy(*_order(by, ties))
    return df.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= k)
