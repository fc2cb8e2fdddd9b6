"""Near copies by SimHash, candidates by the pigeonring principle.

A fingerprint of 64 bits is cut into three segments in a ring. If two fingerprints differ in
at most two bits, some segment starts a chain whose first link differs in no bit, whose first
two links differ in at most one bit (2 * 2/3 rounded down) and whose three links differ in at
most two. So such a pair agrees on one whole segment and on the next but for one bit: 42 or
43 of 64 bits, which makes an exact key. One key for each start and each bit left out finds
every pair, and a chance meeting needs 42 equal bits, also among 10^10 documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import only, saved, sent_if_small, unused
from tillscope.llm.components import connected

SEGMENTS = ((0, 22), (22, 43), (43, 64))
BITS = 2
#: Keys with up to so many different fingerprints are paired; above, two-bit masks link them.
PAIRED = 32
#: Shingles that are counted at a time, which bounds the memory for a long text.
CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """SimHash of a UTF-8 text: bit i is set if it is set in over half of the shingle hashes."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    reach = min(words, len(parts)) - 1
    first, last = starts[: len(parts) - reach].tolist(), ends[reach:].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK], last[at : at + CHUNK])
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, h, fp BIGINT) of every row; NULL and blank texts have 0. h is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py() or b"", words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["doc_id", "h", "fp"]
            )

    rows = only(docs, doc_id=id_col, text=text_col).select("doc_id", F.xxhash64("text").alias("h"), "text")
    longs = [T.StructField(c, T.LongType()) for c in ("h", "fp")]
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *longs]))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def ring_masks() -> list[int]:
    """For each start in the ring and each bit of the next segment: the bits that must agree."""
    masks = []
    for i, (lo, hi) in enumerate(SEGMENTS):
        after = SEGMENTS[(i + 1) % len(SEGMENTS)]
        chain = sum(1 << b for b in range(lo, hi)) | sum(1 << b for b in range(*after))
        masks += [_signed(chain & ~(1 << b)) for b in range(*after)]
    return masks


def pair_masks() -> list[int]:
    """All bits but two, for each two."""
    every = (1 << 64) - 1
    return [_signed(every & ~(1 << i) & ~(1 << j)) for i in range(64) for j in range(i)]


def _keys(fps: DataFrame, masks: list[int]) -> DataFrame:
    every = fps.select("fp", F.posexplode(F.array(*map(F.lit, masks))).alias("slot", "mask"))
    return every.select("fp", "slot", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def near_links(fps: DataFrame) -> DataFrame:
    """(a, b) links that connect exactly the fingerprints that a chain of steps of at most two
    bits connects. `fps` has each fingerprint once.

    Pairs are written out only for keys of at most PAIRED fingerprints. A key of more (a cluster
    of very many near copies) sends its members through the masks that leave out two bits:
    all that agree under one are within two bits of each other and are linked to the smallest.
    """
    keys = _keys(fps, ring_masks())
    groups = saved(
        keys.groupBy("slot", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"),
        "ring",
    )
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS
    twos = groups.filter("n = 2").select("a", "b").distinct().filter(close)
    more = saved(
        keys.join(groups.filter("n > 2").select("slot", "key", "n"), ["slot", "key"]), "ring-more"
    )
    few = more.filter(F.col("n") <= PAIRED)
    left = few.select("slot", "key", F.col("fp").alias("a"))
    right = few.select("slot", "key", F.col("fp").alias("b"))
    pairs = left.join(right, ["slot", "key"]).filter("a < b").filter(close).select("a", "b").distinct()
    many = more.filter(F.col("n") > PAIRED).select("fp").distinct()
    cut = _keys(many, pair_masks())
    least = cut.groupBy("slot", "key").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n"))
    stars = (
        cut.join(least.filter("n > 1"), ["slot", "key"]).filter("fp != b")
        .select(F.col("fp").alias("a"), "b").distinct()
    )
    return twos.union(pairs).union(stars)


def placed(rows: DataFrame) -> DataFrame:
    """(fp, root, least): every fingerprint of `rows` with the root of its component and its
    first row, by id (a missing one last) and text."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("least")
    once = rows.groupBy("fp").agg(first)
    found = connected(near_links(once.select("fp")))
    return once.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )


def near_copies(docs: DataFrame, words: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id that a chain of
    links of at most two differing bits reaches, the row's own included; NULL if none of them
    has an id. Rows with NULL or blank text have the fingerprint zero and are linked like any
    other. A repeated row is repeated in the result. Empty input gives an empty result.
    """
    rows = saved(fingerprints(docs, words, id_col, text_col), "fingerprints")
    every = placed(rows)
    roots = every.groupBy("root").agg(F.min("least")["doc_id"].alias("component_id"))
    named = every.join(roots, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 3, id_col="doc_id", text_col="text") -> DataFrame:
    """The documents without near copies: of each component one row of its smallest doc_id.

    A component without any id keeps one row too. Rows that repeat the id and the text of the
    kept one are copies as well.
    """
    rows = saved(fingerprints(docs, words, id_col, text_col), "fingerprints")
    kept = placed(rows).groupBy("root").agg(F.min("least").alias("m"))
    kept = saved(kept.select(F.struct("m.doc_id", "m.h").alias("_kept")), "kept")
    kept = sent_if_small(kept, F.lit(16))
    key = F.struct(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("h"))
    stay = docs.join(kept, key == kept["_kept"], "left_semi")
    twice = rows.groupBy("doc_id", "h").count().filter("count > 1")
    if not twice.take(1):
        return stay
    # Some rows repeat an id with its text: of these, one each. Copies meet in the tasks first.
    twice = saved(twice.select(F.struct("doc_id", "h").alias("_twice")), "twice")
    twice = sent_if_small(twice, F.lit(16))
    alone = stay.join(twice, key == twice["_twice"], "left_anti")
    name = unused("_key", docs.columns)
    again = stay.join(twice, key == twice["_twice"], "left_semi").withColumn(name, key)
    return alone.union(again.dropDuplicates([name]).drop(name))
