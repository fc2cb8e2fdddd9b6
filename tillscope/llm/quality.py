"""Quality rules: counts over a text, and its distance from the usual text of a language.

The distance is that of Jensen and Shannon (base 2, so 0 to 1) between two histograms of the
document and those of each reference language: its characters by class, and its words by common
word. References are the mean shares of all documents of a language, counted over the whole
table, so they follow the corpus; the list of common words is fixed.
"""

from __future__ import annotations

import re
import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import let, saved, spaced_words, whole_text

#: Very common words of each reference language.
COMMON_WORDS = {
    "de": "der die und in den von zu mit das sich auf für ist im dem nicht ein eine als auch",
    "en": "the of and to in that is with for on by are was from at this an be it as",
    "es": "de la que el en y los se del las un por con una para su al lo no como",
    "fr": "de la le et les des en un une que est pour par dans sur qui pas au avec du",
}
BINS = sorted({word for words in COMMON_WORDS.values() for word in words.split()})
#: Classes of characters. White space, bytes beyond one a character and the rest follow from
#: lengths.
CLASSES = [string.ascii_uppercase, string.digits, ".,;:!?'\"()-", "#*$%&|<>"]
N_CLASSES = len(CLASSES) + 3

#: Fewest words of a document, and most words in repeated windows per hundred.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Fewest words for a verdict by distance: shorter histograms say too little.
LEAST_FOR_CLASSES, LEAST_FOR_WORDS = 50, 100
#: Largest distance from the nearest reference, by each histogram and by their sum.
MOST_BY_CLASS, MOST_BY_WORD, MOST_BY_BOTH = 0.30, 0.40, 0.45
#: Shares are whole billionths, so their sums do not depend on the order of the rows.
UNIT = 1_000_000_000


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def class_counts(text: Column, word_chars: Column) -> Column:
    """Bytes of the text by class. Few characters of a text are in a class, so matches are counted:
    taking them out one by one goes through a lookup for each character of the text."""
    whole, n = F.octet_length(text), F.length(text)
    patterns = [F.lit(f"[{re.escape(c)}]") for c in CLASSES]
    found = [F.regexp_count(text, c) for c in patterns] + [n - word_chars, whole - n]
    return F.transform(F.array(*found, whole - reduce(Column.__add__, found)), lambda x: x.cast("long"))


def word_counts(words: Column) -> Column:
    """How often each of BINS occurs, and last the number of all other words.

    The common words of a text are sorted, so each one's count is the way to the next one.
    """

    def starts(common: Column, kinds: Column) -> Column:
        return F.transform(kinds, lambda w: F.array_position(common, w).cast("int"))

    def placed(common: Column, kinds: Column, at: Column) -> Column:
        ends = F.concat(F.slice(at, 2, len(BINS)), F.array(F.size(common) + 1))
        counts = F.zip_with(at, ends, lambda a, b: F.coalesce(b, a) - F.coalesce(a, b))
        return let(counts, lambda n: F.transform(
            F.array(*map(F.lit, BINS)),
            lambda w: F.coalesce(F.get(n, F.array_position(kinds, w).cast("int") - 1), F.lit(0)).cast("long"),
        ))

    common = F.sort_array(F.filter(words, lambda w: w.isin(BINS)))
    return let(common, lambda c: let(F.array_distinct(c), lambda k: let(starts(c, k), lambda at: F.concat(
        placed(c, k, at), F.array((F.size(words) - F.size(c)).cast("long"))
    ))))


def word_windows(words: Column) -> Column:
    """A 64-bit hash of every three consecutive words. Two windows of one text that differ share
    a hash once in some 10^11 texts of 20,000 words."""
    return F.when(
        F.size(words) >= 3,
        F.transform(
            F.slice(words, F.lit(1), F.size(words) - 2),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def covered(windows: Column) -> Column:
    """Words that lie in a window found twice or more: windows are sorted with their places, and
    the places of those equal to a neighbour cover the words. Without repeats nothing is sorted."""

    def twins(placed: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            same = [F.get(placed, k + step)["w"] == x["w"] for step in (-1, 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(placed, repeated), lambda x: x["i"]))

    def lengths(places: Column) -> Column:
        return F.transform(
            places, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1), at + 3) - at).cast("long")
        )

    def counted(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        return F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            let(placed, lambda p: let(twins(p), lambda places: total(lengths(places)))),
        ).otherwise(F.lit(0).cast("long"))

    return let(windows, counted)


def measures(docs: DataFrame, text_col="text") -> DataFrame:
    """The rows with a struct `_m` of counts and histograms, from one reading of each text."""
    text, words = F.col("_text"), F.col("_words")
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    rows = (
        docs.withColumn("_text", whole_text(f"`{text_col}`"))
        .withColumn("_words", spaced_words(text))
        .withColumn("_chars", F.length(F.array_join(words, "")))
        .withColumn("_classes", class_counts(text, F.col("_chars")))
    )
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        F.element_at("_classes", len(CLASSES)).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        covered(word_windows(words)).alias("n_repeat_words"),
        F.col("_classes").alias("classes"),
        word_counts(words).alias("common"),
    )
    return rows.select(*[f"`{c}`" for c in docs.columns], counts.alias("_m"))


def references(rows: DataFrame, lang_col="lang") -> dict[str, tuple[list, list]]:
    """For each language of COMMON_WORDS that occurs: mean shares of classes and of common words.

    Every document of at least LEAST_FOR_WORDS words counts, with the same weight. At most
    four rows of some eighty numbers come to the driver.
    """
    def shares(counts: str) -> Column:
        return let(total(F.col(counts)), lambda n: F.transform(counts, lambda c: F.floor(c * UNIT / n)))

    rows = (
        rows.filter(F.col(f"`{lang_col}`").isin(list(COMMON_WORDS)))
        .filter(F.col("_m.n_words") >= LEAST_FOR_WORDS)
        .select(F.col(f"`{lang_col}`").alias("_lang"), shares("_m.classes").alias("c"), shares("_m.common").alias("w"))
    )
    sizes = (("c", N_CLASSES), ("w", len(BINS) + 1))
    sums = [F.sum(F.col(k)[i]).alias(f"{k}{i}") for k, m in sizes for i in range(m)]
    found = {}
    for row in rows.groupBy("_lang").agg(*sums).collect():
        values = [[row[f"{k}{i}"] for i in range(m)] for k, m in sizes]
        found[row["_lang"]] = tuple([v / sum(part) for v in part] for part in values)
    return dict(sorted(found.items()))


def divergence(counts: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance, base 2, of a histogram from reference shares; NULL if it is empty."""

    def part(x: Column, mean: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mean)).otherwise(F.lit(0.0))

    def term(p: Column, q: Column) -> Column:
        return part(p, (p + q) / 2) + part(q, (p + q) / 2)

    def distance(n: Column) -> Column:
        terms = F.zip_with(counts, F.array(*map(F.lit, reference)), lambda c, q: term(c / n, q))
        bits = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / 2
        return F.when(n > 0, F.sqrt(F.greatest(bits, F.lit(0.0))))

    return let(total(counts), distance)


def _judged(docs: DataFrame, columns: list[str], text_col="text", lang_col="lang") -> DataFrame:
    """(_row, quality): the named columns as a struct, and the struct that `judged` adds."""
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
        F.col(f"`{text_col}`").alias("_given"),
        F.col(f"`{lang_col}`").alias("_lang"),
    )
    rows = saved(measures(given, "_given").select("_row", "_lang", "_m"), "quality")
    found = references(rows, "_lang")
    known = found.values()
    m = F.col("_m")

    def nearest(parts: list[Column]) -> Column:
        return F.array_min(F.array(*parts)) if parts else F.lit(None).cast("double")

    m = m.withField("class_distance", nearest([divergence(F.col("_m.classes"), c) for c, _ in known]))
    m = m.withField("word_distance", nearest([divergence(F.col("_m.common"), w) for _, w in known]))
    rows = rows.withColumn("_m", m.dropFields("classes", "common"))
    m = F.col("_m")
    failed = (m.n_words < LEAST_WORDS) | (100 * m.n_repeat_words > MOST_REPEATED * m.n_words)
    by_class = (m.n_words >= LEAST_FOR_CLASSES) & (m.class_distance > MOST_BY_CLASS)
    by_word = (m.n_words >= LEAST_FOR_WORDS) & (
        (m.word_distance > MOST_BY_WORD) | (m.class_distance + m.word_distance > MOST_BY_BOTH)
    )
    strange = F.coalesce(by_class, F.lit(False)) | F.coalesce(by_word, F.lit(False))
    # References say nothing about a text of another language.
    strange = strange & F.coalesce(F.col("_lang").isin(list(found)), F.lit(False))
    return rows.select("_row", m.withField("base_failed", failed).withField("kept", ~failed & ~strange).alias("quality"))


def judged(docs: DataFrame, columns: list[str] | None = None, text_col="text", lang_col="lang") -> DataFrame:
    """The rows, in the named columns (all of them by default), with a struct `_quality`: n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance,
    base_failed and kept.

    A NULL or empty text has no words and fails the base rules. A document is compared with the
    nearest reference of any language. For one whose own language is NULL or has no reference, only
    the base rules decide; so they do without any reference (an empty table or no known
    language). Repeated rows are judged alike.

    Texts are read once: counts and histograms are written with the named columns.
    """
    columns = docs.columns if columns is None else columns
    return _judged(docs, columns, text_col, lang_col).select("_row.*", F.col("quality").alias("_quality"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns."""
    return _judged(docs, docs.columns).filter("quality.kept").select("_row.*")
