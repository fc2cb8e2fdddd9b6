"""Overlap of filters against a plain version that applies every order to every document."""

from collections import Counter
from itertools import permutations

from hypothesis import given, settings
from hypothesis import strategies as st

from tillscope.llm import interactions

SCHEMA = "doc_id long, text string, lang string, key string, part string, fails int, n int"


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        }
        parts.setdefault(lang or "", []).append(({f for f in fails if fails[f]}, i in good, i in toxic))
    rows = []
    for part, members in parts.items():
        shapley = Counter()
        made = []
        for order in permutations("ABCDE"):
            for step, own in enumerate(order, 1):
                before = set(order[: step - 1])
                left = [m for m in members if not m[0] & before]
                removed = [m for m in left if own in m[0]]
                shapley[own] += len(removed)
                counts = (
                    len(left) - len(removed), len(removed),
                    sum(own in m[0] and bool(m[0] & before) for m in members),
                    sum(m[0] == {own} for m in members),
                    sum(m[1] for m in removed), sum(m[2] for m in removed),
                )
                made.append((part, "".join(order), step, *counts, own))
        rows += [(*r[:-1], shapley[r[-1]]) for r in made]
    return sorted(rows)


def audited(spark, docs, labels):
    # The other columns have the names that the operator uses itself.
    rows = [(*d, "k", "p", 9, 9) for d in docs]
    marks = [(*x, "x") for x in labels]
    result = interactions.audit(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, quality int, toxic int, lists string")
    )
    return sorted(tuple(r) for r in result.collect())


LONG = " ".join(f"w{i}" for i in range(400_000))


def test_equals_plain_version(spark):
    docs = [
        (1, "some words", "en"), (2, "some words", "de"), (2, "some words", "de"), (3, "", "en"), (4, None, "en"),
        (5, LONG, "en"), (6, LONG, None), (None, "some words", "en"), (None, LONG, ""), (7, "ABC " * 300, "en"),
        (8, " ".join(f"v{i}" for i in range(250)), "de"), (9, "no\x0bbreak\x85here " * 120, "de"), (10, "50% | off", "de"),
        (8, "another text of a repeated id #", "de"),
    ]
    labels = [(1, 1, 1), (2, 1, 0), (2, 0, 1), (7, None, 1), (8, 1, None), (None, 1, 1), (99, 1, 1), (5, 1, 0)]
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_part_without_failures_and_no_labels(spark):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(200)), "en") for i in range(3)]
    rows = audited(spark, docs, [])
    assert rows == plain(docs, []) and {r[3] for r in rows} == {3}


def test_empty_table(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []


def test_a_third_of_the_rows_are_copies(spark):
    docs = [(i, "the same" if i % 3 == 0 else f"text {i} of its own", "en" if i % 2 else "de") for i in range(600)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 600, 7)]
    assert audited(spark, docs, [(i, q, int(t)) for i, q, t in labels]) == plain(docs, [(i, q, int(t)) for i, q, t in labels])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 60)), min_size=1, max_size=7))
def test_regions_by_galloping(sets):
    expected = Counter(sum(1 << n for n, s in enumerate(sets) if x in s) for x in set().union(*sets))
    assert interactions.regions({n: sorted(s) for n, s in enumerate(sets)}) == expected


@given(st.sets(st.integers(0, 200)), st.integers(-1, 201), st.integers(0, 20))
def test_gallop_finds_the_first_place(ids, x, at):
    ids = sorted(ids)
    at = min(at, len(ids))
    assert interactions.gallop(ids, x, at) == next((i for i in range(at, len(ids)) if ids[i] >= x), len(ids))
