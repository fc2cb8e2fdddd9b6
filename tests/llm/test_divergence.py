"""Divergence of sources against a plain version over all terms."""

import random
import re
from collections import Counter

import numpy as np

from tillscope.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, row int, n int, docs int, at int, salt int"


def plain(docs):
    docs = [(t or "", la or "", s or "") for t, la, s in docs]
    rows = []
    for lang in {d[1] for d in docs}:
        held = [(Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))), s) for t, la, s in docs if la == lang]
        seen = Counter(t for c, _ in held for t in c)
        kept = [t for t in seen if seen[t] >= 3]
        sources = sorted({s for _, s in held})
        counts = {s: Counter() for s in sources}
        for c, s in held:
            counts[s].update({t: c[t] for t in kept if c[t]})
        whole = sum(counts.values(), Counter())

        def probabilities(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // n for t in kept}

        q = probabilities(whole)
        p = {s: probabilities(counts[s]) for s in sources}
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pairs = [(x, sum(f(p[s][t], p[x][t]) for t in kept)) for x in sources if x != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, divergence.RANKS)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                rows += [(lang, s, part, item, value, r) for r, (item, value) in enumerate(items[:most], 1)]
    return sorted(rows)


def audited(spark, docs):
    rows = [(i, *d, "t", 1, 2, 3, 4, 5) for i, d in enumerate(docs)]
    result = divergence.audit(spark.createDataFrame(rows, SCHEMA))
    return sorted(tuple(r) for r in result.collect())


def random_docs(seed, n=300, words=40, sources=7):
    rng = random.Random(seed)
    vocabulary = ["a", "The", "the", "été", "漢字", "x_y", "don't", "Été"] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    docs = []
    for _ in range(n):
        # A third of all rows are of one source, and sources prefer other words.
        s = 0 if rng.random() < 0.33 else rng.randrange(sources)
        text = " ".join(vocabulary[min(int(rng.expovariate(0.08)) + s, len(vocabulary) - 1)] for _ in range(rng.randrange(words)))
        docs.append((text, rng.choice(["en", "en", "de", None]), f"s{s}" if s else None))
    return docs


def test_equals_plain_version(spark):
    docs = random_docs(1)
    docs += [(None, "fr", "x"), ("", "fr", "y"), ("12 34", "fr", None), ("alone alone alone", "it", "only"), ("", "", "")]
    docs += [docs[0]] * 5 + [(" ".join(["very", "long"] * 200_000), "en", "s1")]
    assert audited(spark, docs) == plain(docs)


def test_sources_that_are_too_many_to_be_sent(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SENT", 0)
    docs = random_docs(2, n=200)
    assert audited(spark, docs) == plain(docs)


def test_more_terms_than_ranks_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "ENTRIES", 16)
    rng = random.Random(3)
    docs = [(" ".join("".join(rng.choices("abcdefgh", k=3)) for _ in range(60)), "en", f"s{i % 4}") for i in range(200)]
    rows = audited(spark, docs)
    assert rows == plain(docs) and max(r[5] for r in rows) == divergence.RANKS


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_counts_beyond_64_bits_stay_exact(spark):
    n = 10**13
    row = spark.range(1).selectExpr(f"{n}L AS n", f"{3 * n + 7}L AS mass").select(divergence.probability("n", "mass").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 1) // (3 * n + 7)


def test_corrections_of_a_tree():
    """Nodes and ancestors of sorted rows, against every pair of every row."""
    rng = random.Random(4)
    zero = {s: rng.randrange(1, 50) for s in range(6)}
    rows = sorted({tuple((s, rng.randrange(1, 4) * 1_000_000) for s in range(6) if rng.random() < 0.6) for _ in range(200)} - {()})
    weight = np.array([rng.randrange(1, 1_000_000) for _ in rows], np.int64)
    at, p, z = (np.full((len(rows), 6), fill, np.int64) for fill in (-1, 1, 1))
    expected = Counter()
    f = lambda a, b: (a - b) ** 2 // b
    for i, row in enumerate(rows):
        for k, (s, v) in enumerate(row):
            at[i, k], p[i, k], z[i, k] = s, v, zero[s]
        for s, v in row:
            for x, w in row:
                if s != x:
                    expected[s, x] += int(weight[i]) * (f(v, w) - f(v, zero[x]) - f(zero[s], w) + f(zero[s], zero[x]))
    pairs, sums = divergence.corrections(at, p, z, weight)
    got = {}
    for code, (th, tl, bh, bl) in zip(pairs.tolist(), sums.T.tolist()):
        a, b = code >> 32, code & 0xFFFFFFFF
        got[a, b], got[b, a] = (th << 32) + tl, (bh << 32) + bl
    assert got == {k: v for k, v in expected.items() if k in got} and set(got) == set(expected)
