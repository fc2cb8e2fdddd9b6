"""License notices in documents: fixed phrases, and a set-similarity join with templates.

The blocks of a document are its lines and, as a notice is often wrapped over lines, all runs of
its words that are 1 / THRESHOLD times as long as the template. A block meets a template if it
holds at least THRESHOLD of the template's different words. All words of templates are ordered by
the number of documents that have them, rarest first; in that order
- length: a block with fewer template words than the needed overlap is left out at once,
- prefix: block and template must share a word of their first words, as many as leave too few
  for the overlap when all of them differ,
- position: what follows the first shared word on both sides must still allow the overlap.
What passes is counted exactly. Runs of words are looked at only around words of the prefix, and
only in a document that passes as one block. Templates are a parameter of a few lines, so each task has all
of them in its expressions and the join moves no document.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import NOT_WORD, ascii_lower, let, only, split_words, whole_text

#: Phrases whose places are counted, and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Sentences by which the published licenses are known.
TEMPLATES = [
    ("agpl", "This program is licensed under the GNU Affero General Public License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("artistic", "This library is free software under the terms of the Artistic License 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "The author has dedicated the work to the public domain by waiving all rights under CC0 1.0 Universal"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "This project is licensed under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.8


def template_words(text: str) -> list[str]:
    """The different words of a template, as `alnum_words` would cut it."""
    lowered = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return list(dict.fromkeys(w for w in re.split(NOT_WORD, lowered) if w))


def needed(words: list[str], threshold: float) -> int:
    return math.ceil(threshold * len(words) - 1e-9)


def run_length(text: str, threshold: float) -> int:
    """Words of a run that is compared with the template."""
    return math.ceil(len([w for w in re.split(NOT_WORD, text.lower()) if w]) / threshold - 1e-9)


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def global_order(lowered: DataFrame, words: list[str]) -> list[str]:
    """The words of all templates, those in fewest documents first.

    What comes to the driver is at most one count for each template word.
    """
    own = F.array_intersect(_strings(words), F.split("lower", NOT_WORD))
    counts = lowered.select(F.explode(own).alias("w")).groupBy("w").count().collect()
    found = {row["w"]: row["count"] for row in counts}
    return sorted(words, key=lambda w: (found.get(w, 0), w))


def _containment(block: Column, words: list[str], order: list[str], threshold: float) -> Column:
    """Share of the template's words in a block (in the global order); 0 if below the threshold."""
    rank = {w: i for i, w in enumerate(order)}
    words = sorted(words, key=rank.__getitem__)
    least = needed(words, threshold)
    prefix = _strings(words[: len(words) - least + 1])
    size = F.size(block)

    def placed(first: Column) -> Column:
        after = F.least(len(words) - F.array_position(_strings(words), first), size - F.array_position(block, first))
        overlap = F.size(F.array_intersect(block, _strings(words)))
        return F.when((after + 1 >= least) & (overlap >= least), overlap / len(words)).otherwise(0.0)

    shared = F.array_intersect(prefix, F.slice(block, F.lit(1), F.greatest(size - least + 1, F.lit(0))))
    return F.when(
        size >= least,
        let(shared, lambda s: F.when(F.size(s) > 0, placed(F.get(s, F.lit(0)))).otherwise(0.0)),
    ).otherwise(0.0)


def _in_runs(text: Column, words: list[str], length: int, order: list[str], threshold: float) -> Column:
    """Largest share of the template's words in `length` consecutive words; 0 if below the threshold."""
    rank = {w: i for i, w in enumerate(order)}
    least = needed(words, threshold)
    prefix = sorted(words, key=rank.__getitem__)[: len(words) - least + 1]
    own = _strings(words)

    def overlap(first: Column, n) -> Column:
        return F.size(F.array_intersect(own, F.slice(text, first + 1, n)))

    # A run that holds enough has a word of the prefix; what lies around that word holds the run.
    places = F.filter(F.sequence(F.lit(0), F.size(text) - 1), lambda i: F.get(text, i).isin(prefix))
    begin = lambda i: F.greatest(i - (length - 1), F.lit(0))
    near = F.filter(places, lambda i: overlap(begin(i), F.lit(2 * length - 1)) >= least)
    starts = F.array_distinct(F.flatten(F.transform(near, lambda i: F.sequence(begin(i), i))))
    most = F.coalesce(F.array_max(F.transform(starts, lambda i: overlap(i, F.lit(length)))), F.lit(0))
    return let(most, lambda n: F.when(n >= least, n / len(words)).otherwise(0.0))


def _places(words: Column, joined: Column, phrase: str) -> Column:
    """Starts of a phrase among the words; texts without it are not searched word by word."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(words, i) == parts[0]
        for step, part in enumerate(parts[1:], 1):
            test = test & (F.coalesce(F.get(words, i + step), F.lit("")) == part)
        return test

    none = F.array().cast("array<int>")
    every = F.sequence(F.lit(0), F.size(words) - 1)
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), F.filter(every, here)).otherwise(none)


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n_base, first_word, last_word, base_labels, labels, score) of every row.

    n_base counts the places of all phrases; first_word and last_word are their smallest and
    largest start. labels are those of phrases and of templates met by a block, arrays sorted.
    score is 1 with a phrase, else the largest share of a template that a block holds, if it
    reaches the threshold, else 0. NULL and empty texts have nothing. Rows stay as they are
    repeated; an empty table gives an empty result.
    """
    sets = [(label, template_words(text)) for label, text in templates]
    lengths = [run_length(text, threshold) for _, text in templates]
    lowered = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id", ascii_lower(whole_text("text")).alias("lower")
    )
    order = global_order(lowered, sorted({w for _, words in sets for w in words}))
    shortest = min((needed(words, threshold) for _, words in sets), default=1)

    rows = lowered.withColumn("words", split_words(F.col("lower"), NOT_WORD))
    rows = rows.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    places = [_places(F.col("words"), F.col("joined"), phrase) for phrase, _ in PHRASES]
    blocks = F.filter(
        F.transform(F.split("lower", "\n"), lambda x: F.array_intersect(_strings(order), F.split(x, NOT_WORD))),
        lambda b: F.size(b) >= shortest,
    )
    # The words of templates in the whole document, in the global order.
    rows = rows.withColumn("held", F.array_intersect(_strings(order), "words"))
    runs = [
        F.when(_containment(F.col("held"), words, order, threshold) > 0, _in_runs(F.col("words"), words, length, order, threshold))
        .otherwise(0.0)
        for (_, words), length in zip(sets, lengths)
    ]
    runs = F.when(F.size("held") >= shortest, F.array(*runs)).otherwise(F.array().cast("array<double>"))
    rows = rows.select("doc_id", F.array(*places).alias("places"), blocks.alias("blocks"), runs.alias("runs"))

    def best(k: int, words: list[str]) -> Column:
        shares = F.transform("blocks", lambda b: _containment(b, words, order, threshold))
        return F.greatest(F.coalesce(F.array_max(shares), F.lit(0.0)), F.get("runs", F.lit(k)))

    met = F.when(
        F.size("runs") > 0,
        F.array(*[F.struct(best(k, words).alias("share"), F.lit(label).alias("label")) for k, (label, words) in enumerate(sets)]),
    ).otherwise(F.array().cast("array<struct<share:double,label:string>>"))
    rows = rows.select("doc_id", "places", F.filter(met, lambda m: m["share"] > 0).alias("met"))
    base = F.array_sort(F.array_distinct(F.flatten(F.array(*[
        F.when(F.size(F.col("places")[i]) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
        for i, (_, label) in enumerate(PHRASES)
    ]))))
    rows = rows.select("doc_id", F.flatten("places").alias("at"), base.alias("base_labels"), "met")
    return rows.select(
        "doc_id",
        F.size("at").cast("long").alias("n_base"),
        F.array_min("at").cast("long").alias("first_word"),
        F.array_max("at").cast("long").alias("last_word"),
        "base_labels",
        F.sort_array(F.array_union("base_labels", F.transform("met", lambda m: m["label"]))).alias("labels"),
        F.when(F.size("at") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform("met", lambda m: m["share"])), F.lit(0.0)))
        .alias("score"),
    )
