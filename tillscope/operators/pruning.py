"""Top-k sums with most keys dropped before the shuffle.

A plain top-k of sums shuffles every key once for each task. Here keys are first summed by hash
bucket, which shuffles at most as many rows for each task as there are buckets. With amounts that
are not negative, the sum of a bucket is an upper bound for each of its keys, and the k-th largest
sum among the keys of a few large buckets is a lower bound for the k-th largest of all. Buckets
below it hold no key of the result, so their rows end at the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.operators.ranking import top_k

#: Buckets; the list of those that are left is broadcast, so this bounds its rows (about 32 MB).
BUCKETS = 1 << 20


def in_reach_of_top(rows: DataFrame, key: str, amount: Column, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The rows of all keys that may be among the k with the largest sum of `amount`.

    Exact whatever the amounts: with a negative one, or if the large buckets have fewer than k
    keys with a sum, every row stays. One lazy plan that reads `key` and the columns of `amount`
    three times. It pays where few keys hold much of the total; where all are alike nothing is
    dropped and the earlier passes are lost.
    """
    if not 0 < buckets <= BUCKETS:
        raise ValueError(f"buckets must be from 1 to {BUCKETS}")
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets).cast("long"))
    own = rows.select(F.col(f"`{key}`").alias("key"), amount.alias("amount"), bucket.alias("bucket"))
    sums = own.groupBy("bucket").agg(F.sum("amount").alias("most"), F.min("amount").alias("least"))
    large = sums.orderBy(F.desc_nulls_last("most"), "bucket").limit(k).select("bucket")
    known = own.join(F.broadcast(large), "bucket").groupBy("key").agg(F.sum("amount").alias("total"))
    kth = known.orderBy(F.desc_nulls_last("total")).limit(k).agg(
        F.when(F.count("total") == k, F.min("total")).alias("bound")
    )
    negative = sums.orderBy(F.asc_nulls_last("least")).limit(1).select(F.col("least") < 0)
    bound = kth.scalar()
    left = sums.where(F.coalesce(negative.scalar(), F.lit(False)) | bound.isNull() | (F.col("most") >= bound)).select(F.col("bucket").alias("_bucket"))
    return rows.join(F.broadcast(left), bucket == F.col("_bucket"), "left_semi")


def top_sums(rows: DataFrame, key: str, amount: Column, *, k: int, name: str = "total", buckets: int = BUCKETS) -> DataFrame:
    """(key, name): the k keys with the largest sums, ties by key."""
    reach = in_reach_of_top(rows, key, amount, k, buckets)
    return top_k(reach.groupBy(key).agg(F.sum(amount).alias(name)), name, key, k=k)
