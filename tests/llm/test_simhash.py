import itertools
import random

import pytest
import xxhash

from tillscope.llm import components, simhash


def slow_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    """Root of each: the smallest index that links of at most two bits reach."""
    root = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(fps)), 2):
            if bin(fps[i] ^ fps[j]).count("1") <= 2 and root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                changed = True
    return root


def texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(4)) for _ in range(300)]
    base = [" ".join(rng.choice(words) for _ in range(n)) for n in (400, 300, 5, 2, 1)]
    near = []
    for _ in range(25):
        w = base[0].split(" ")
        w[rng.randrange(400)] = rng.choice(words)
        near.append(" ".join(w))
    return [*base, *near, base[1], base[1].upper(), "", None, " \n\t", "É a b c", "é a b c"]


def test_fingerprints_equal_the_plain_form():
    for text in texts():
        assert simhash.fingerprint((text or "").encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("paired", [32, 2])
def test_components_equal_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    every = texts()
    fps = [slow_fingerprint(t) for t in every]
    roots = slow_components(fps)
    rows = [(i, t, 1, "h") for i, t in enumerate(every)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, fp INT, h STRING")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_copies(docs).collect()}
    assert got == {i: (f"{f:016x}", r) for i, (f, r) in enumerate(zip(fps, roots))}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(roots)


def test_masks_find_every_close_pair():
    masks = simhash.ring_masks()
    for i, j in itertools.combinations(range(64), 2):
        assert any(m & (1 << 64) - 1 & (1 << i | 1 << j) == 0 for m in masks), (i, j)


def test_missing_ids_and_repeated_rows(spark):
    rows = [(None, "alone here now"), (None, "alone here now"), (7, "a b c"), (7, "a b c"), (7, "d e f g"), (9, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = sorted(((r.doc_id or 0, r.text) for r in simhash.one_of_each(docs).collect()))
    assert kept == [(0, "alone here now"), (7, "a b c"), (7, "d e f g")]
    assert simhash.near_copies(docs.limit(0)).count() == 0


def test_long_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a BIGINT, b BIGINT")
    got = {r.node: r.root for r in components.connected(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components.connected(links.limit(0)).count() == 0
