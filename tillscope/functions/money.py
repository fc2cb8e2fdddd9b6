"""Money is summed exactly, as decimals of six places.

A decimal sum does not depend on the order of the rows, and sub-cent prices count. A price that
is no number or too large for the type fails the query instead of giving a wrong sum; the reader
rejects such prices.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Least price that is too large, in SQL.
PRICE_LIMIT = "1e12D"


def exact_money(price: str) -> Column:
    """Price as a decimal, as it is written; beyond six places it is rounded."""
    return F.col(price).cast("decimal(18,6)")


def money_of(exact: str | Column) -> Column:
    """An exact sum as a double."""
    return (F.col(exact) if isinstance(exact, str) else exact).cast("double")
