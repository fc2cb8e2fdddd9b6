"""How sources of a language differ in their terms, from a frequent-pattern tree of term rows.

The divergence of two sources is a sum over all kept terms of the language, of which most are in
few sources. A term row holds a term's nonzero counts only, source by source in one order for the
language, the most frequent source first, so rows begin alike and a tree of them shares paths. A
node is a source with a probability, and its multiplicity the number of terms whose row passes it.

With f(p, q) for a pair of probabilities and zeros for those of a term that a source lacks, the
sum over all terms is
    V f(0, 0)
  + for every term that one of the two has   f(p, 0) - f(0, 0), or f(0, q) - f(0, 0)
  + for every term that both have            f(p, q) - f(p, 0) - f(0, q) + f(0, 0).
The first two lines need the sources' probabilities with their numbers of terms. The last, the
correction, is taken once for each node and ancestor of the tree, times the node's multiplicity.

Rows are sorted and dealt by path, so each batch of them is a part of the tree, worked on as
arrays: its nodes are the runs of rows with equal beginnings.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillscope.llm.common import SENT, only, saved, whole_text

#: Documents of a language that a term is in at least; the unit of probabilities; ranks of terms.
LEAST_DOCS, UNIT, RANKS = 3, 1_000_000_000, 200
#: Different terms that a task counts before it hands them on, and entries of rows in a batch.
HELD, ENTRIES = 400_000, 1 << 18
#: Parts into which the probabilities of a language are cut if sources are too many to be sent.
SALTS = 64

#: Letters and every character from U+0080 on, in UTF-8.
TERM = rb"[A-Za-z\x80-\xff]+"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = re.compile(TERM).findall
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            if counts:
                n = len(counts)
                columns = [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                    pa.array(counts.values(), pa.int64()),
                    pa.array([docs[t] for t in counts], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    held = 0
    for batch in batches:
        lang, source, text = batch.columns
        for key, raw in zip(zip(lang.to_pylist(), source.to_pylist()), text.cast(pa.binary())):
            words = find(raw.as_py().lower())  # of bytes: A to Z only
            counts, docs = groups.setdefault(key, (Counter(), Counter()))
            held -= len(counts)
            counts.update(words)
            docs.update(set(words))
            held += len(counts)
            if held > HELD:
                yield from handed_on()
                held = 0
    yield from handed_on()


def term_rows(docs: DataFrame) -> DataFrame:
    """(row, lang, term, total, counts) of every kept term, written: counts are (source, n)."""
    counted = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"),
        F.sum("n").alias("total"),
        F.collect_list(F.struct("source", "n")).alias("counts"),
    )
    rows = rows.filter(F.col("docs") >= LEAST_DOCS).drop("docs")
    return saved(rows.withColumn("row", F.monotonically_increasing_id()), "terms")


def probability(n, of) -> Column:
    """1 + floor(UNIT (n + 1) / of), exactly, for counts of any size; NULL without terms."""
    wide = (F.col(n) if isinstance(n, str) else n).cast("decimal(27,0)") + 1
    share = F.call_function("div", wide * F.lit(UNIT).cast("decimal(10,0)"), F.nullif(F.col(of), F.lit(0)).cast("decimal(20,0)"))
    return share + 1


def f(p: str, q: str) -> Column:
    """floor((p - q)^2 / q): below 2^63, as probabilities are at most UNIT + 1."""
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def sources_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(lang, source, at, v, mass, zero, lang_mass) of every occurring source, written.

    `at` is its place in the order of the language, `mass` what its probabilities divide by,
    `zero` that of a term it lacks.
    """
    having = rows.select("lang", F.inline("counts")).groupBy("lang", "source")
    having = having.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms"))
    whole = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    found = docs.select("lang", "source").distinct().join(having, ["lang", "source"], "left").join(whole, "lang", "left")
    found = found.fillna(0, ["n", "terms", "v", "lang_n"])
    first = Window.partitionBy("lang").orderBy(F.col("terms").desc(), "source")
    found = found.withColumn("at", F.row_number().over(first)).withColumn("mass", F.col("n") + F.col("v"))
    found = found.withColumn("zero", probability(F.lit(0), "mass"))
    return saved(found.select("lang", "source", "at", "v", "mass", "zero", (F.col("lang_n") + F.col("v")).alias("lang_mass")), "sources")


def _fits(sources: DataFrame) -> bool:
    """Whether the sources may be sent to every task, by the sum of their sizes."""
    size = F.octet_length("lang") + F.octet_length("source") + 64
    return (sources.agg(F.sum(size)).first()[0] or 0) <= SENT


def entries_of(rows: DataFrame, sources: DataFrame, sent: bool) -> DataFrame:
    """(row, lang, term, source, at, p, zero, q) of every nonzero count, q of the language."""
    entries = rows.select("row", "lang", "term", "total", F.inline("counts"))
    if sent:
        met = entries.join(F.broadcast(sources), ["lang", "source"])
    else:
        # One source may have a large part of the entries: dealt out by row as well.
        salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = entries.withColumn("salt", (F.col("row") % SALTS).cast("int")).join(salted, ["lang", "source", "salt"])
    return met.select(
        "row", "lang", "term", "source", "at",
        probability("n", "mass").alias("p"), "zero", probability("total", "lang_mass").alias("q"),
    )


def _above(p, q):
    d = p - q
    return d * d // q


def corrections(at, p, zero, weight):
    """(first, second, high and low of both directions) summed over the tree of some rows.

    `at`, `p` and `zero` have one sorted row of the tree each, filled up with -1 and 1. A pair
    has the sums of weight times correction for (first, second) and for (second, first), each
    as two numbers of which the first counts 2^32, so no sum overflows.
    """
    n, width = at.shape
    as_before = np.zeros((n, width), bool)
    as_before[1:] = (at[1:] == at[:-1]) & (p[1:] == p[:-1]) & (at[1:] >= 0)
    as_before = np.logical_and.accumulate(as_before, axis=1)
    pairs, sums = [], []
    for k in range(1, width):
        starts = np.flatnonzero(~as_before[:, k])
        times = np.add.reduceat(weight, starts)
        real = at[starts, k] >= 0
        nodes, times = starts[real], times[real, None]
        if not len(nodes):
            continue
        a, pa_, za = at[nodes, :k], p[nodes, :k], zero[nodes, :k]
        b, pb, zb = at[nodes, k, None], p[nodes, k, None], zero[nodes, k, None]
        there = _above(pa_, pb) - _above(pa_, zb) - _above(za, pb) + _above(za, zb)
        back = _above(pb, pa_) - _above(pb, za) - _above(zb, pa_) + _above(zb, za)
        pairs.append((a << 32 | b).ravel())
        parts = [half * times for g in (there, back) for half in (g >> 32, g & 0xFFFFFFFF)]
        sums.append(np.stack([x.ravel() for x in parts]))
    if not pairs:
        return np.zeros(0, np.int64), np.zeros((4, 0), np.int64)
    pairs, sums = np.concatenate(pairs), np.concatenate(sums, axis=1)
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(sums[:, order], first, axis=1)


def _corrected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "first", "second", "there_high", "there_low", "back_high", "back_low"]
    for batch in batches:
        langs = batch["lang"].to_pylist()
        lengths = np.asarray(pa.compute.list_value_length(batch["path"]))
        weight = np.asarray(batch["n"])
        flat = batch["path"].flatten()
        columns = [np.asarray(flat.field(i)) for i in range(3)]
        ends = np.cumsum(lengths)
        begin = 0
        while begin < len(langs):
            # One language, and as many rows as fill a matrix of bounded size.
            end, width = begin, 0
            while end < len(langs) and langs[end] == langs[begin]:
                width = max(width, int(lengths[end]))
                if end > begin and (end + 1 - begin) * width > ENTRIES:
                    break
                end += 1
            width = int(lengths[begin:end].max())
            inside = np.arange(width) < lengths[begin:end, None]
            span = slice(int(ends[begin] - lengths[begin]), int(ends[end - 1]))
            matrices = []
            for values, fill in zip(columns, (-1, 1, 1)):
                matrix = np.full(inside.shape, fill, np.int64)
                matrix[inside] = values[span]
                matrices.append(matrix)
            pairs, sums = corrections(*matrices, weight[begin:end])
            if len(pairs):
                made = [pa.array([langs[begin]] * len(pairs), pa.string()), pa.array(pairs >> 32), pa.array(pairs & 0xFFFFFFFF)]
                yield pa.RecordBatch.from_arrays([*made, *map(pa.array, sums)], names=names)
            begin = end


def corrected(entries: DataFrame) -> DataFrame:
    """(lang, a, b, value): corrections of the ordered pairs that have a term in common."""
    paths = entries.groupBy("row", "lang").agg(F.sort_array(F.collect_list(F.struct("at", "p", "zero"))).alias("path"))
    # A term of one source only has no ancestor.
    paths = paths.filter(F.size("path") > 1).groupBy("lang", "path").agg(F.count(F.lit(1)).alias("n"))
    paths = saved(paths, "paths").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    longs = ", ".join(f"{c} long" for c in ("first", "second", "there_high", "there_low", "back_high", "back_low"))
    sums = paths.mapInArrow(_corrected, f"lang string, {longs}")

    def whole(name: str) -> Column:
        high, low = (F.col(f"{name}_{half}").cast("decimal(20,0)") for half in ("high", "low"))
        return high * F.lit(1 << 32).cast("decimal(11,0)") + low

    ways = [F.struct(F.col(a).cast("int").alias("a"), F.col(b).cast("int").alias("b"), whole(w).alias("value")) for a, b, w in (("first", "second", "there"), ("second", "first", "back"))]
    return sums.select("lang", F.inline(F.array(*ways)))


def single(entries: DataFrame, sources: DataFrame, sent: bool) -> DataFrame:
    """(lang, a, b, value): for each ordered pair, the terms that one of the two has."""
    having = entries.groupBy("lang", "at", "zero", "p").agg(F.count(F.lit(1)).alias("n"))
    others = sources.select("lang", F.col("at").alias("other"), F.col("zero").alias("other_zero"))
    if sent:
        met = having.join(F.broadcast(others), "lang")
    else:
        salted = others.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = having.withColumn("salt", (F.col("p") % SALTS).cast("int")).join(salted, ["lang", "salt"])
    met = met.filter("at <> other")
    there = f("p", "other_zero") - f("zero", "other_zero")
    back = f("other_zero", "p") - f("other_zero", "zero")
    times = F.col("n").cast("decimal(18,0)")
    ways = [
        F.struct(F.col(a).alias("a"), F.col(b).alias("b"), (change.cast("decimal(19,0)") * times).alias("value"))
        for a, b, change in (("at", "other", there), ("other", "at", back))
    ]
    return met.select("lang", F.inline(F.array(*ways)))


def divergences(sources: DataFrame, entries: DataFrame, sent: bool) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    mine = sources.select("lang", "source", F.col("at").alias("a"), "zero", "v")
    theirs = sources.select("lang", F.col("source").alias("item"), F.col("at").alias("b"), F.col("zero").alias("other_zero"))
    pairs = mine.join(theirs, "lang").filter("a <> b")
    absent = F.coalesce(f("zero", "other_zero").cast("decimal(19,0)") * F.col("v").cast("decimal(18,0)"), F.lit(0))
    wide = F.col("value").cast("decimal(38,0)")
    changes = single(entries, sources, sent).select("lang", "a", "b", wide.alias("value"))
    changes = changes.unionByName(corrected(entries).select("lang", "a", "b", wide.alias("value")))
    changes = changes.groupBy("lang", "a", "b").agg(F.sum("value").alias("change"))
    value = absent.cast("decimal(38,0)") + F.coalesce("change", F.lit(0).cast("decimal(38,0)"))
    return pairs.join(changes, ["lang", "a", "b"], "left").select("lang", "source", "item", value.cast("long").alias("value"))


def ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    rows = rows.filter(F.col("rank") <= most) if most else rows
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, lang_col="lang", source_col="source", text_col="text") -> DataFrame:
    """(lang, source, part, item, value, rank): part 'pair' has every other source of the
    language by divergence, part 'term' the RANKS terms that a source has most above the language.

    NULL texts, languages and sources count as ''. Every row is a document, repeated rows too.
    A source without kept terms has a part 'pair' as well; a source alone in its language has
    none. Equal values are ranked by item. An empty table gives an empty result. A path has an
    entry for each source of a language at most; nothing else is gathered by key.
    """
    rows = only(docs, lang=lang_col, source=source_col, text=text_col)
    rows = rows.select(*[whole_text(F.col(c).cast("string")).alias(c) for c in ("lang", "source", "text")])
    kept = term_rows(rows)
    sources = sources_of(rows, kept)
    sent = _fits(sources)
    entries = entries_of(kept, sources, sent)
    above = entries.filter("p > q").select("lang", "source", F.col("term").alias("item"), f("p", "q").alias("value"))
    return ranked(divergences(sources, entries, sent), "pair").unionByName(ranked(above, "term", RANKS))
