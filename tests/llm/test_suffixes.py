import hashlib
import random
from collections import Counter

from tillscope.llm import suffixes


def brute(texts):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + 400] for r in raws for i in range(len(r) - 399))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - 399):
            if seen[r[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        flags = "".join(map(str, gone))
        out.append((len(r), sum(gone), len([x for x in flags.split("0") if x]), hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def texts():
    rng = random.Random(5)
    def prose(n):
        return "".join(rng.choice("abcdeé \n") for _ in range(n))
    shared, other = prose(900), prose(420)
    yield from [None, "", "short", prose(399), prose(1500), "x" * 2000, "ab" * 700]
    for _ in range(12):
        cut = rng.randrange(0, 500)
        yield prose(rng.randrange(300)) + shared[cut : cut + rng.randrange(380, 900)] + prose(rng.randrange(300))
    yield shared + other
    yield other + shared
    yield prose(100) + other + other[:405] + prose(50)
    twin = prose(700)
    yield from [twin, twin, twin[:300] + "!" + twin[300:], twin[:100] + "?" + twin[100:]]
    # Two partners that cover one passage from different sides.
    whole = prose(600)
    yield from [whole, whole[:450] + prose(200), prose(200) + whole[150:]]


def results(spark, rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, runs STRING, h STRING")
    out = suffixes.without_repeats(docs)
    out = out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("r"), F.size("runs").alias("s"), F.sha2("kept", 256).alias("k"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_equals_brute_force(spark, monkeypatch):
    every = list(texts())
    rows = [(i if i % 7 else None, t, "x", "y") for i, t in enumerate(every)]
    expected = sorted(((r[0], *e) for r, e in zip(rows, brute(every))), key=repr)
    assert results(spark, rows) == expected
    # The same in small pieces, and with everything shuffled instead of broadcast.
    monkeypatch.setattr(suffixes, "PIECE", 500)
    monkeypatch.setattr(suffixes, "sent_if_small", lambda df, size: df)
    assert results(spark, rows) == expected


def test_levels_merge_geometrically(spark):
    family = suffixes.Family()
    for i in range(7):
        family.insert(spark.createDataFrame([(i,), (100,)], "gram BIGINT"))
    assert [size for size, _ in family.levels] == [4, 2, 1]
    assert {r.gram for r in family.met.distinct().collect()} == {100}


def test_empty_table(spark):
    assert results(spark, []) == []
