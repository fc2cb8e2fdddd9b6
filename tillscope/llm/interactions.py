"""How filters overlap: what each removes at each place of every order they may be applied in.

Every filter has sorted posting lists, the ids of the documents of a part that fail it, cut at
the same ids into blocks. The lists of a block are merged once, and the merge gallops: a run of
ids that only one list has is found by steps that double and is counted as a whole. It yields
the size of every region, that is of the ids that exactly these lists have. A union or a
difference of any of the lists is a sum of regions, and so is all that the report holds.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import joined_to_groups, only, saved, whole_text

#: The filters, by letter; the lists of documents labelled good and toxic follow them.
FILTERS, GOOD, TOXIC = "ABCDE", 5, 6
FEWEST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Ids of a block, as bits: the rows of one list of one block are at most 2^BLOCK.
BLOCK = 16
#: What stands for the number of all documents among the regions.
ALL = -1

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failures(raw: bytes, points: int) -> int:
    """The filters A to D that a text in UTF-8 of so many code points fails, as bits."""
    words = raw.split()  # of bytes: at blanks and \x09 to \x0D, and at nothing else
    upper = len(raw) - len(raw.translate(None, _UPPER))
    return (
        (len(words) < FEWEST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > UPPER_PERCENT * points) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


def _examined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, doc_id, part, text = batch.columns
        points = pc.utf8_length(text).to_pylist()
        fails, digests = [], []
        for raw, n in zip(text.cast(pa.binary()), points):
            raw = raw.as_py()
            fails.append(failures(raw, n))
            digests.append(hashlib.sha256(raw).digest())
        made = [key, doc_id, part, pa.array(fails, pa.int32()), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays(made, names=["key", "doc_id", "part", "fails", "digest"])


def examined(docs: DataFrame, part_col="lang", id_col="doc_id", text_col="text") -> DataFrame:
    """(key, doc_id, part, fails, digest) of every row, written: `key` tells the rows apart."""
    rows = only(docs, doc_id=id_col, part=part_col, text=text_col)
    rows = rows.select(
        F.monotonically_increasing_id().alias("key"),
        "doc_id",
        F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        whole_text("text").alias("text"),
    )
    kind = dict(rows.dtypes)["doc_id"]
    made = rows.mapInArrow(_examined, f"key long, doc_id {kind}, part string, fails int, digest binary")
    return saved(made, "examined")


def later_copies(rows: DataFrame) -> DataFrame:
    """(part, key) of the rows whose text a row with a smaller doc_id has too, in any part."""
    groups = rows.groupBy("digest").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    groups = saved(groups.filter("first < last").drop("last"), "copied")
    copied = joined_to_groups(rows.select("digest", "doc_id", "part", "key"), groups, "digest", rows.count())
    return copied.filter("doc_id > first").select("part", "key")


def posting_lists(rows: DataFrame, labels: DataFrame, id_col="doc_id", quality_col="quality", toxic_col="toxic") -> DataFrame:
    """(part, block, list, ids) with sorted ids, written; empty lists have no row.

    `rows` are those of `examined`. Lists 0 to 4 are the filters', GOOD and TOXIC the labels'.
    """
    marks = only(labels, doc_id=id_col, quality=quality_col, toxic=toxic_col).groupBy("doc_id")
    found = [F.when(F.max(F.col(c) == 1), n) for c, n in (("quality", GOOD), ("toxic", TOXIC))]
    marks = marks.agg(F.array_compact(F.array(*found)).alias("lists"))
    bits = [F.when(F.col("fails").bitwiseAND(1 << n) != 0, n) for n in range(FILTERS.index("E"))]
    postings = (
        rows.select("part", "key", F.explode(F.array_compact(F.array(*bits))).alias("list"))
        .unionByName(later_copies(rows).withColumn("list", F.lit(FILTERS.index("E"))))
        .unionByName(rows.join(marks.filter(F.size("lists") > 0), "doc_id").select("part", "key", F.explode("lists").alias("list")))
    )
    postings = postings.withColumn("block", F.call_function("shiftright", F.col("key"), F.lit(BLOCK)))
    lists = postings.groupBy("part", "block", "list").agg(F.sort_array(F.collect_list("key")).alias("ids"))
    return saved(lists, "postings")


def gallop(ids: list[int], x: int, at: int) -> int:
    """The first place from `at` on whose id is not below x: steps that double, then halves."""
    step, end = 1, at
    while end < len(ids) and ids[end] < x:
        at = end + 1
        end += step
        step *= 2
    return bisect_left(ids, x, at, min(end, len(ids)))


def regions(lists: dict[int, list[int]]) -> Counter:
    """Numbers of ids by the lists that have them (as bits), from sorted lists without repeats."""
    sizes: Counter = Counter()
    at = {n: 0 for n, ids in lists.items() if ids}
    while at:
        fronts = sorted((lists[n][i], n) for n, i in at.items())
        least = fronts[0][0]
        having = [n for x, n in fronts if x == least]
        run = 1
        if len(having) == 1:
            # Up to the front of the next list, only this one has ids.
            n = having[0]
            end = gallop(lists[n], fronts[1][0], at[n]) if len(fronts) > 1 else len(lists[n])
            run = end - at[n]
        sizes[sum(1 << n for n in having)] += run
        for n in having:
            at[n] += run
            if at[n] == len(lists[n]):
                del at[n]
    return sizes


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    lists = dict(zip(table["list"].to_pylist(), table["ids"].to_pylist()))
    sizes = regions(lists)
    return pa.table(
        {
            "part": pa.array([key[0].as_py()] * len(sizes), pa.string()),
            "members": pa.array(sizes.keys(), pa.int32()),
            "n": pa.array(sizes.values(), pa.int64()),
        }
    )


def region_sizes(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """(part, members, n): documents of a part that exactly these lists have; ALL of them."""
    merged = lists.groupBy("part", "block").applyInArrow(_merged, "part string, members int, n long")
    merged = merged.groupBy("part", "members").agg(F.sum("n").alias("n"))
    whole = rows.groupBy("part").agg(F.lit(ALL).alias("members"), F.count(F.lit(1)).alias("n"))
    return merged.unionByName(whole)


def report(sizes: dict[int, int], filters: str = FILTERS) -> list[tuple]:
    """(filter_order, step, counts) of every order of the filters and every step of it."""
    total = sizes.pop(ALL, 0)
    everyone, good, toxic = (1 << len(filters)) - 1, 1 << GOOD, 1 << TOXIC

    def having(test) -> int:
        return sum(n for members, n in sizes.items() if test(members))

    fails = [having(lambda m: m >> i & 1) for i in range(len(filters))]
    alone = [having(lambda m: m & everyone == 1 << i) for i in range(len(filters))]
    union = [having(lambda m: m & before) for before in range(everyone + 1)]
    new = {}  # of a filter after those before it: removed, good lost, toxic lost
    shapley = [0] * len(filters)
    for before in range(everyone + 1):
        for i in range(len(filters)):
            if not before >> i & 1:
                lost = lambda m: m >> i & 1 and not m & before  # noqa: B023, E731
                new[before, i] = having(lost), having(lambda m: lost(m) and m & good), having(lambda m: lost(m) and m & toxic)
                done = before.bit_count()
                shapley[i] += new[before, i][0] * factorial(done) * factorial(len(filters) - done - 1)
    rows = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, i in enumerate(order, 1):
            removed, good_lost, toxic_lost = new[before, i]
            kept = total - union[before | 1 << i]
            counts = kept, removed, fails[i] - removed, alone[i], good_lost, toxic_lost, shapley[i]
            rows.append(("".join(filters[f] for f in order), step, *counts))
            before |= 1 << i
    return rows


def _reported(sizes: pd.DataFrame) -> pd.DataFrame:
    rows = report(dict(zip(sizes["members"].tolist(), sizes["n"].tolist())))
    made = pd.DataFrame(rows, columns=["filter_order", "step", *_COUNTS])
    made.insert(0, "part", sizes["part"].iloc[0])
    return made


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley) of every part, order of the five filters and step.

    NULL texts count as empty, NULL languages as the part ''. Every row is a document, repeated
    rows too. A row without an id has no smaller id and no labels; of rows alike in id and text
    none comes before the other. A document has a label if any row of `labels` gives it. An
    empty table gives an empty result. What a task holds is bounded: one document, the lists of
    a block, or the 128 regions of a part.
    """
    rows = examined(docs)
    sizes = region_sizes(rows, posting_lists(rows, labels))
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return sizes.groupBy("part").applyInPandas(_reported, f"part string, filter_order string, step int, {kinds}")
