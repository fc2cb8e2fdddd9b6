"""The registered queries of this subpackage, as functions of (session, folder of the tables)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tillscope.llm import (
    bpe,
    decontaminate,
    divergence,
    htmltext,
    interactions,
    licenses,
    passages,
    quality,
    sharding,
    simhash,
    suffixes,
    toxicity,
    warc,
)
from tillscope.llm.common import table

QUERIES = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


@registered
def op1_benchmark_decontamination(spark, sf_dir):
    rows = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return rows.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


@registered
def op2_license_scan(spark, sf_dir):
    rows = licenses.scan(table(spark, sf_dir, "documents"))
    listed = {c: F.concat_ws(",", c) for c in ("base_labels", "labels")}
    return rows.withColumns(listed)


@registered
def op3_substring_dedup(spark, sf_dir):
    rows = passages.without_repeats(table(spark, sf_dir, "documents"), ["doc_id"], linked=True)
    of = F.transform("_passages.repeats", lambda r: r["of"])
    return rows.select(
        "doc_id",
        F.coalesce("_passages.class_id", "doc_id").alias("class_id"),
        "_passages.n_links",
        "_passages.n_words",
        "_passages.n_removed",
        "_passages.n_spans",
        F.array_distinct(of).alias("repeats_of"),
        F.sha2("_passages.kept", 256).alias("kept_sha256"),
    )


@registered
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.scored(docs, *toxicity.lexicon(docs, table(spark, sf_dir, "labels")))
    # A row without an id has no remainder, so none that may be learned from.
    held_out = F.coalesce(~toxicity.may_train(), F.lit(True))
    return rows.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"),
    )


@registered
def op5_quality_rules(spark, sf_dir):
    rows = quality.judged(table(spark, sf_dir, "documents"), ["doc_id"])
    near = {c: F.round(c, 6) for c in ("class_distance", "word_distance")}
    return rows.select("doc_id", "_quality.*").withColumns(near)


@registered
def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@registered
def op7_bpe_round_trip(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    back = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return back.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@registered
def op8_suffix_array_dedup(spark, sf_dir):
    rows = suffixes.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@registered
def op9_html_extraction(spark, sf_dir):
    rows = htmltext.extracted(table(spark, sf_dir, "pages"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


@registered
def op10_extendible_sharding(spark, sf_dir):
    return sharding.sharded(table(spark, sf_dir, "documents"), columns=["doc_id"])


@registered
def op11_filter_interactions(spark, sf_dir):
    return interactions.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op12_warc(spark, sf_dir):
    rows = warc.round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@registered
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))
