"""Shards of bounded size by extendible hashing.

A shard is the set of rows whose hash begins with certain bits. All rows are one shard at first;
a shard over the limit splits on its next bit, others never do, so the directory is deep only
where rows are many. Levels are computed STRIDE bits at a time, from sums by prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import saved, whole_text

#: Bytes of a shard at most, and bytes that a row takes besides its text.
LIMIT, ROW = 1 << 20, 32
#: Bits of a hash, and levels of the directory that one round computes.
BITS, STRIDE = 60, 12


def row_hash(id_col: str, text_col: str) -> Column:
    """60 bits of an MD5 of id and text, so rows that repeat an id still fall apart."""
    text = F.md5(F.encode(whole_text(f"`{text_col}`"), "UTF-8"))
    whole = F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), text))
    return F.conv(F.substring(whole, 1, BITS // 4), 16, 10).cast("long")


def shifted(value, bits) -> Column:
    return F.call_function("shiftright", F.col(value), F.lit(bits) if isinstance(bits, int) else bits)


def prefix(h: str, depth) -> Column:
    """The first `depth` bits of a hash."""
    return shifted(h, BITS - depth)


def directory(keys: DataFrame, limit: int) -> DataFrame:
    """(depth, prefix, bytes, n, whole) of every shard, from `keys` (h, bytes, n), each h once.

    `whole` is false for a shard over the limit that cannot split: all its rows are alike.
    """
    found = None
    live, depth = keys, 0
    while True:
        step = min(STRIDE, BITS - depth)
        lowest = live.groupBy(prefix("h", depth + step).alias("p")).agg(
            F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        lowest = saved(lowest, "prefixes")
        levels = lowest.select("*", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("up"))
        nodes = levels.groupBy(
            (depth + step - F.col("up")).alias("depth"), shifted("p", F.col("up")).alias("prefix")
        ).agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        nodes = nodes.withColumn("open", (F.col("bytes") > limit) & (F.col("lo") < F.col("hi")))
        parents = nodes.filter("open").select(
            (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
        )
        leaves = nodes.filter("NOT open").join(parents, ["depth", "prefix"], "left_semi")
        if depth == 0:
            leaves = leaves.union(nodes.filter("NOT open AND depth = 0").select(*leaves.columns))
        leaves = leaves.select("depth", "prefix", "bytes", "n", (F.col("bytes") <= limit).alias("whole"))
        found = leaves if found is None else found.union(leaves)
        depth += step
        over = saved(
            nodes.filter(F.col("open") & (F.col("depth") == depth)).select("prefix"), "oversized"
        )
        if depth >= BITS or not over.take(1):
            return saved(found, "directory")
        live = live.withColumn("prefix", prefix("h", depth)).join(over, "prefix", "left_semi").drop("prefix")


def sharded(docs: DataFrame, limit: int = LIMIT, columns: list[str] | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows, in the named columns (all by default), with shard, depth and n_bytes.

    shard is the bits that the hashes of its rows begin with; n_bytes is the size of the row,
    its text in UTF-8 and ROW. Rows alike in id and text that together exceed the limit are
    dealt out to shards numbered after a dash, as many to each as fit; a row that exceeds the
    limit alone has such a shard for itself. NULL texts count as empty, NULL ids as one id.
    An empty table gives an empty result.
    """
    columns = docs.columns if columns is None else columns
    size = (F.octet_length(whole_text(f"`{text_col}`")) + ROW).cast("long")
    rows = docs.withColumn("_h", row_hash(id_col, text_col)).withColumn("_b", size)
    rows = saved(rows.select(*[f"`{c}`" for c in columns], "_h", "_b", F.spark_partition_id().alias("_slot")), "rows")
    keys = rows.groupBy(F.col("_h").alias("h")).agg(F.sum("_b").alias("bytes"), F.count(F.lit(1)).alias("n"))
    keys = saved(keys, "keys")
    shards = directory(keys, limit)
    depths = sorted(r["depth"] for r in shards.select("depth").distinct().collect())  # at most 61
    placed = keys.select("h", F.explode(F.array(*map(F.lit, depths)) if depths else F.array().cast("array<int>")).alias("depth"))
    placed = placed.withColumn("prefix", prefix("h", F.col("depth")))
    bits = F.right(F.lpad(F.bin("prefix"), BITS, "0"), F.col("depth"))
    placed = placed.join(shards, ["depth", "prefix"]).select(
        F.col("h").alias("_h"), "depth", bits.alias("shard"), "whole"
    )
    rows = rows.join(placed, "_h")
    names = [f"`{c}`" for c in columns]
    single = rows.filter("whole").select(*names, "shard", "depth", F.col("_b").alias("n_bytes"))
    alike = rows.filter("NOT whole")
    # Numbers within a hot hash: counts of the slots before, then places within a slot.
    before = Window.partitionBy("_h").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = alike.groupBy("_h", "_slot").count().withColumn("_from", F.coalesce(F.sum("count").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_h", "_slot").orderBy("_b")) - 1
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_b")))
    part = F.floor((F.col("_from") + F.col("_at")) / each)
    dealt = alike.withColumn("_at", within).join(slots.select("_h", "_slot", "_from"), ["_h", "_slot"])
    dealt = dealt.withColumn("shard", F.concat("shard", F.lit("-"), part.cast("string")))
    return single.union(dealt.select(*names, "shard", "depth", F.col("_b").alias("n_bytes")))


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """Each shard of the documents as one file below `path`/shard=BITS."""
    sharded(docs, limit).drop("depth", "n_bytes").repartition("shard").write.partitionBy("shard").parquet(path)
