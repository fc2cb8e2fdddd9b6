import random
import re

from pyspark.sql import functions as F

from tillscope.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(hit), n < 50 or 100 * len(hit) > 50 * n,
    )


def texts():
    rng = random.Random(8)
    common = "the of and to in that is with for on".split()
    for n in (0, 1, 2, 3, 49, 50, 51, 300):
        yield " ".join(rng.choice(common + ["word%d" % rng.randrange(99)]) for _ in range(n))
    yield "a b c " * 40
    yield "a b c d a b c d a\nx\ny\nx\n\n \n# * $ | <é> 中文 \U0001f600\x0b"
    yield ("|".join("#$%" for _ in range(30)) + " ") * 90
    yield from (None, "", "\n\n", "z" * 50_000)


def test_measures_equal_the_plain_form(spark):
    every = list(texts())
    rows = [(i, t, "en" if i % 3 else None, 5) for i, t in enumerate(every)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, n_words INT")
    got = {r.doc_id: r for r in quality.judged(docs, ["doc_id"]).select("doc_id", "_quality.*").collect()}
    for i, text in enumerate(every):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(text)
        assert not (r.base_failed and r.kept)
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.judged(docs.limit(0)).count() == 0


def test_distance_is_that_of_jensen_and_shannon(spark):
    import math

    p, q = [3, 0, 5, 2], [0.1, 0.4, 0.25, 0.25]
    shares = [x / 10 for x in p]
    mean = [(a + b) / 2 for a, b in zip(shares, q)]
    part = lambda x: sum(a * math.log2(a / m) for a, m in zip(x, mean) if a)
    row = spark.createDataFrame([(p,), ([0, 0, 0, 0],)], "c ARRAY<BIGINT>")
    got = [r[0] for r in row.select(quality.divergence(F.col("c"), q)).collect()]
    assert abs(got[0] - math.sqrt((part(shares) + part(q)) / 2)) < 1e-12 and got[1] is None


def test_strange_texts_go_and_prose_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("lang IS NOT NULL")
    odd = spark.createDataFrame([(-1, "#|$ " * 30 + "%<> " * 30 + "&* " * 60, "en")], "doc_id BIGINT, text STRING, lang STRING")
    rows = quality.judged(docs.select("doc_id", "text", "lang").union(odd), ["doc_id"]).select("doc_id", "_quality.*")
    by_id = {r.doc_id: r for r in rows.collect()}
    assert not by_id[-1].kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r for i, r in by_id.items() if labels.get(i) == 1 and not r.base_failed]
    assert good and sum(r.kept for r in good) >= 0.98 * len(good)


def test_languages_without_a_reference_are_judged_by_the_base_rules(spark, sf_dir):
    """Clean texts of other scripts, and of no language, beside the four that are known."""
    rng = random.Random(6)

    def text(first, last):
        return " ".join("".join(chr(rng.randrange(first, last)) for _ in range(rng.randrange(2, 9))) for _ in range(150))

    others = [(-i, text(*{"ru": (0x430, 0x450), "zh": (0x4E00, 0x9000), "el": (0x3B1, 0x3CA)}[lang]), lang) for i, lang in enumerate(["ru", "zh", "el"] * 10, 1)]
    others += [(-99, text(0x430, 0x450), None), (-100, "слово " * 200, "ru")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = quality.judged(docs.union(spark.createDataFrame(others, docs.schema)), ["doc_id"])
    kept = {r.doc_id: r.kept for r in rows.select("doc_id", "_quality.kept").filter("doc_id < 0").collect()}
    assert kept == {i: i != -100 for i, _, _ in others}
