"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is costly to compute and used in filters.

    A filter on a projected column is moved below the projection with the expression put in
    place of the column, once for each mention. The output of a generator cannot be replaced
    like that, so the filter stays above and reads the value. The value is computed whether
    or not the column is used.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def as_computed(df: DataFrame) -> DataFrame:
    """The rows, behind which no filter is moved.

    A filter on a grouping key, or on what is computed from it, is moved below the grouping and
    evaluated for every row that is grouped, text functions included. Above this it reads each group
    once; and uses with different filters still share one plan of what is below.
    """
    return compute_once(df, "_whole", F.struct(*[F.col(f"`{c}`") for c in df.columns])).select("_whole.*")
