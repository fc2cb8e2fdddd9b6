"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the smallest one around that node."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a").join(least, "a").filter("b != m")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (a > b in `links`)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    near = links.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links` (a BIGINT, b BIGINT, any direction, repeats allowed).

    The root is the smallest node of the component. A link from a node to itself and a link
    with a NULL end are ignored; without links the result is empty. Each round halves the
    depth of the trees or so and is written, so no lineage grows; only a count and a checksum
    come to the driver.
    """
    links = links.select("a", "b").filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = saved(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        links = saved(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if before == state:
            break
    rooted = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rooted.union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
