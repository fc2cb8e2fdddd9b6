"""The stages of the pipeline against plain versions of what they decide."""

import hashlib
from pathlib import Path

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from test_passages import prose

from tillscope.llm import quality


def test_stages_in_order(spark, sf_dir):
    assert [n for n, _ in pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "substring_dedup", "benchmark_decontamination", "byte_pair_tokens",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, before = docs.columns, docs.count()
    judged = {r.doc_id: r.kept for r in quality.judged(docs, ["doc_id"]).select("doc_id", "_quality.kept").collect()}
    for name, stage in pipeline.STAGES[:-1]:
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = pipeline.saved(stage(spark, docs, sf_dir), name)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == names and left <= ids and docs.count() == len(left)
        if name == "quality_rules":
            assert left == {i for i, kept in judged.items() if kept}
    assert 0 < docs.count() < before
    texts = {r.doc_id: r.text for r in docs.collect()}
    tokens = pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id: r.decoded for r in tokens} == texts
    whole = pipeline.run(spark, sf_dir).select("doc_id", "ids").collect()
    digest = lambda rows: {r.doc_id: hashlib.sha256(r.ids).hexdigest() for r in rows}
    assert digest(whole) == digest(tokens)


def test_copies_of_other_columns_survive(spark, sf_dir):
    import random

    rng = random.Random(1)
    text = prose(rng, 120)
    rows = [(1, text, "en", "k", len(text), 3), (2, text, "en", "k", len(text), 4), (3, prose(rng, 90), None, None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, words INT")
    for _, stage in pipeline.STAGES[1:-1]:
        docs = pipeline.saved(stage(spark, docs, sf_dir), "stage")
    assert sorted(tuple(r) for r in docs.collect()) == [rows[0], rows[2]]


CLASHING = "_text _words _chars _classes _given _lang _m _quality _row _k _r _l _id _s _kept _passages _twice _key _hit k h quality".split()


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES[:-1]], ids=[n for n, _ in pipeline.STAGES[:-1]])
def test_columns_of_the_caller_keep_their_values(spark, sf_dir, stage):
    """Names that the operators use themselves, in one table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    docs = docs.union(docs.limit(3)).withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHING})
    out = stage(spark, pipeline.saved(docs, "clashing"), sf_dir)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[c] == f"{c} of {r.doc_id}" for c in CLASHING)


def test_scratch_of_earlier_stages_goes(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (name, stage) in enumerate(pipeline.STAGES):
        before = set(pipeline._scratch)
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        gone = before - set(pipeline._scratch)
        assert gone == before and not any(Path(p).exists() for p in gone)
        assert n == 4 or all(Path(p).exists() for p in pipeline._scratch)
    # A stage whose documents are still to be read from scratch keeps it.
    docs = pipeline.quality_rules(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)
    assert pipeline.simhash_near_dedup(spark, docs, sf_dir).count() > 0
