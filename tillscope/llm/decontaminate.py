"""Benchmark passages in documents, by a positional inverted index.

The index holds postings (document, position) of the test terms that are needed: for every
window of a benchmark item its two terms that are rarest in the corpus. A posting of the term
at place p of an item, found at position q, proposes the alignment q - p of that item in that
document; a window is a candidate where both of its terms propose the same alignment. The other
words of a candidate are then compared with the document. `proximity` lets the two alignments differ
and some words be others, so that passages with words put in or replaced are found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import alnum_words, let, only, saved, sent_if_small

#: Words of a window; a shorter item is one window.
WINDOW = 10
#: In a proximity match, how far the alignments of the two rare terms may be apart, and the least share
#: of the window's different words that lie in its place, widened by as many words on both sides.
SLACK, SHARE = 3, 0.8


def keyed(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(k, text): k tells rows apart by id and text, so two texts of one id stay two documents.

    Structs with NULL inside are equal to each other, so rows without an id are joined too.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    return rows.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("k"), "text")


def benchmark_items(items: DataFrame, id_col="item_id", text_col="text") -> DataFrame:
    """(item, item_id, words, n, long): one row for each different (id, words) with a word."""
    rows = only(items, item_id=id_col, text=text_col)
    rows = rows.select("item_id", alnum_words("text").alias("words")).filter(F.size("words") > 0)
    return rows.distinct().select(
        F.xxhash64("item_id", "words").alias("item"), "item_id", "words",
        F.size("words").alias("n"), F.least(F.lit(WINDOW), F.size("words")).alias("long"),
    )


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, cf): how often each of `terms` occurs in all documents; absent ones are left out."""
    words = docs.select(F.explode(alnum_words("text")).alias("term"))
    small = sent_if_small(terms, F.octet_length("term") + 16)
    return words.join(small, "term").groupBy("term").agg(F.count(F.lit(1)).alias("cf"))


def rare_pairs(items: DataFrame, counts: DataFrame, lacking: bool = False) -> DataFrame:
    """(item, s, a, b): windows of an item by start, and the places of their two rarest terms.

    A window with a term that no document has is left out; with `lacking`, only that term is. A
    window of one word has a = b.
    """
    places = items.select("item", "n", "long", F.posexplode("words").alias("p", "term"))
    ranked = (
        places.join(counts, "term", "left")
        .groupBy("item", "n", "long")
        .agg(F.sort_array(F.collect_list(F.struct("p", F.coalesce("cf", F.lit(0)).alias("cf")))).alias("t"))
        .select("item", "long", "t", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("long"))).alias("s"))
    )
    by_count = F.sort_array(
        F.transform(F.slice("t", F.col("s") + 1, F.col("long")), lambda x: F.struct(x["cf"], x["p"]))
    )
    if lacking:
        by_count = F.filter(by_count, lambda x: x["cf"] > 0)
    rows = ranked.select("item", "s", by_count.alias("c")).filter((F.size("c") > 0) & (F.get("c", F.lit(0))["cf"] > 0))
    return rows.select(
        "item", "s", F.col("c")[0]["p"].alias("a"), F.coalesce(F.get("c", F.lit(1))["p"], F.col("c")[0]["p"]).alias("b")
    )


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(k, n_hit, item_ids): documents that have a window of an item, from `keyed` documents.

    n_hit counts the words inside any occurrence of a window, item_ids are the items with an
    occurring window (an item without an id hits, but is not in the list).
    """
    items = saved(benchmark_items(items), "items")
    places = items.select("item", F.posexplode("words").alias("p", "term"))
    terms = saved(places.select("term").distinct(), "terms")
    counts = saved(term_counts(docs, terms), "counts")
    windows = saved(rare_pairs(items, counts), "windows")

    anchors = windows.select("item", F.explode(F.array("a", "b")).alias("p")).distinct()
    anchors = saved(anchors.join(places, ["item", "p"]), "anchors")
    rare = saved(anchors.select("term").distinct(), "rare")
    rare = sent_if_small(rare, F.octet_length("term") + 16)
    found = docs.select("k", F.posexplode(alnum_words("text")).alias("q", "term"))
    postings = saved(found.join(rare, "term"), "postings")

    anchors = sent_if_small(anchors, F.octet_length("term") + 32)
    aligned = (
        postings.join(anchors, "term")
        .groupBy("k", "item", (F.col("q") - F.col("p")).alias("shift"))
        .agg(F.collect_set("p").alias("found"))
    )
    by_item = windows.groupBy("item").agg(F.collect_list(F.struct("s", "a", "b")).alias("w"))
    both = F.filter(
        "w", lambda x: F.array_contains("found", x["a"]) & F.array_contains("found", x["b"])
    )
    candidates = (
        aligned.join(by_item, "item")
        .select("k", "item", "shift", F.transform(both, lambda x: x["s"]).alias("starts"))
        .filter(F.size("starts") > 0)
        .groupBy("k").agg(F.collect_list(F.struct("item", "shift", "starts")).alias("c"))
    )
    candidates = saved(candidates, "candidates")
    weight = F.aggregate("c", F.lit(64).cast("long"), lambda n, x: n + 24 + 4 * F.size(x["starts"]))
    texts = docs.join(sent_if_small(candidates, weight), "k")
    pairs = (
        texts.select("k", alnum_words("text").alias("has"), "c")
        .select("k", "has", F.explode("c").alias("c"))
        .select("k", "has", "c.*")
        .join(items, "item")
    )

    def same(s: Column) -> Column:
        at = F.col("shift") + s
        return (at >= 0) & (
            F.slice("has", F.greatest(at, F.lit(0)) + 1, F.col("long")) == F.slice("words", s + 1, F.col("long"))
        )

    spans = F.transform(
        F.filter("starts", same),
        lambda s: F.sequence(F.col("shift") + s, F.col("shift") + s + F.col("long") - 1),
    )
    exact = pairs.select("k", "item_id", F.array_distinct(F.flatten(spans)).alias("at")).filter(F.size("at") > 0)
    return exact.groupBy("k").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("n_hit"),
        F.collect_set("item_id").alias("item_ids"),
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, contaminated) of every row.

    NULL and empty texts have no words and are never contaminated; nor is anything with an empty
    benchmark. A repeated row is repeated in the result. item_ids is sorted as strings.
    """
    rows = keyed(docs)
    found = hits(rows, items)
    own = rows.select("k", F.size(alnum_words("text")).cast("long").alias("n_words"))
    ids = F.sort_array(F.transform(F.coalesce("item_ids", F.array()), lambda i: i.cast("string")))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return own.join(found, "k", "left").select(
        F.col("k.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a benchmark window, with their own columns."""
    found = saved(hits(keyed(docs), items).select(F.col("k").alias("_hit")), "contaminated")
    found = sent_if_small(found, F.lit(32))
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("h"))
    return docs.join(found, key == found["_hit"], "left_anti")


def proximity(docs: DataFrame, items: DataFrame, slack: int = SLACK, share: float = SHARE) -> DataFrame:
    """(doc_id, item_id, n_windows, first_word, most): documents near a benchmark item.

    A window of WINDOW words is near a document at an alignment of the rarer of its two rarest terms (of
    those that documents have; of equals the first) if the other one has an alignment at most `slack` away, and at least `share` of
    the window's different words lie in the words that the window covers there, or at most
    `slack` before or behind. n_windows counts an item's near windows, first_word is their first place (not below 0),
    most the largest share. Items of fewer words have no such window. Rows of equal id and text
    are one document; NULL and empty texts and items are near nothing.
    """
    docs = keyed(docs)
    items = saved(benchmark_items(items).filter(F.col("n") >= WINDOW), "items")
    places = items.select("item", F.posexplode("words").alias("p", "term"))
    terms = saved(places.select("term").distinct(), "terms")
    windows = saved(rare_pairs(items, saved(term_counts(docs, terms), "counts"), lacking=True), "windows")

    anchors = windows.select("item", F.explode(F.array("a", "b")).alias("p")).distinct()
    anchors = saved(anchors.join(places, ["item", "p"]), "anchors")
    found = docs.select("k", F.posexplode(alnum_words("text")).alias("q", "term"))
    found = found.join(sent_if_small(anchors, F.octet_length("term") + 32), "term")
    found = saved(found.select("k", "item", "p", (F.col("q") - F.col("p")).alias("shift")).distinct(), "aligned")

    # Alignments at most `slack` apart lie in the same cell of slack + 1 or in neighbours, so no key
    # has more than slack + 1 of them.
    pairs = sent_if_small(windows, F.lit(32))
    cell = F.floor(F.col("shift") / (slack + 1))
    one = found.join(pairs.withColumnRenamed("a", "p"), ["item", "p"])
    one = one.select("k", "item", "s", "shift", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    other = found.join(pairs.withColumnRenamed("b", "p"), ["item", "p"])
    other = other.select("k", "item", "s", F.col("shift").alias("apart"), cell.alias("cell"))
    close = one.join(other, ["k", "item", "s", "cell"]).filter(F.abs(F.col("shift") - F.col("apart")) <= slack)
    close = close.select("k", "item", "s", "shift").distinct().join(items, "item")
    window = F.slice("words", F.col("s") + 1, F.lit(WINDOW))
    found_in = saved(close.groupBy("k").agg(F.collect_list(
        F.struct("item_id", "item", "s", (F.col("shift") + F.col("s")).alias("at"), F.array_distinct(window).alias("w"))
    ).alias("c")), "near")

    def held(has: Column, x: Column) -> Column:
        first = F.greatest(x["at"] - slack, F.lit(0))
        around = F.slice(has, first + 1, F.greatest(x["at"] + WINDOW + slack - first, F.lit(0)))
        return F.struct(
            x["item_id"].alias("item_id"), x["item"].alias("item"), x["s"].alias("s"),
            F.greatest(x["at"], F.lit(0)).alias("at"),
            (F.size(F.array_intersect(x["w"], around)) / F.size(x["w"])).alias("share"),
        )

    texts = docs.join(found_in, "k")
    rows = texts.select("k", F.explode(let(alnum_words("text"), lambda has: F.transform("c", lambda x: held(has, x)))).alias("m"))
    rows = rows.select("k", "m.*").filter(F.col("share") >= share - 1e-9)
    return rows.groupBy("k", "item_id").agg(
        F.countDistinct("item", "s").alias("n_windows"), F.min("at").cast("long").alias("first_word"), F.max("share").alias("most"),
    ).select(F.col("k.doc_id").alias("doc_id"), "item_id", "n_windows", "first_word", "most")
