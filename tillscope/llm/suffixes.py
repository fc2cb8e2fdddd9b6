"""Repeated byte strings, by a logarithmic family of sparse suffix arrays.

A repeated string of LONG bytes is found through its anchor: the place in it whose next GRAM
bytes have the least hash. Equal strings have the same anchor, so only suffixes that begin at
anchors are indexed, about one in a hundred places. The array of a batch holds its suffixes in the order
of the hash of their first GRAM bytes, in which equal beginnings are neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import only, saved, sent_if_small, whole_text

#: Bytes of a string that counts as repeated, and of the beginning that anchors are chosen by.
LONG, GRAM = 400, 192
#: Batches that a table is indexed in.
BATCHES = 4
#: Bytes of a text that are indexed at a time, which bounds the memory for a long one.
PIECE = 1 << 22
#: An odd multiplier and its inverse modulo 2^64, and the constants of a published mixer.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of BASE and INVERSE, as far as they have been needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 14)
            self.up, self.down = (np.full(size, x, np.uint64) for x in (BASE, INVERSE))
            self.up[0] = self.down[0] = 1
            self.up, self.down = self.up.cumprod(dtype=np.uint64), self.down.cumprod(dtype=np.uint64)
        return self.up[:n], self.down[:n]


class Hashed:
    """A piece of text with hashes of all of its substrings, in time per substring."""

    def __init__(self, raw: bytes, powers: Powers):
        codes = mixed(np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1))
        self.n = len(codes)
        self.up, down = powers.of(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(codes * down[: self.n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.up[start])

    def every(self, size: int) -> np.ndarray:
        """Of the substring of `size` bytes at each place."""
        return mixed((self.sums[size:] - self.sums[:-size]) * self.up[: self.n - size + 1])


def anchors(text: Hashed) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash of its first GRAM bytes, first, last): each anchor with the range of the
    strings of LONG bytes that it is the anchor of. Of equal hashes the leftmost counts."""
    grams = text.every(GRAM)
    key = (grams & ~np.uint64((1 << 23) - 1)) | np.arange(len(grams), dtype=np.uint64)
    width, least = 1, key
    while 2 * width <= LONG - GRAM + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = LONG - GRAM + 1 - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    return place[first], grams[place[first]], first, last


def keyed_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, h, text): rows are told apart by id and text."""
    rows = only(docs, doc_id=id_col, text=text_col).select("doc_id", whole_text("text").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("h"), "text")


def suffix_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, h, gram, ctx, first, last): the indexed suffixes of `keyed` documents.

    gram and ctx hash the first GRAM bytes and all bytes of the strings first..last; two
    suffixes of the same ctx stand for the same strings.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            rows, parts = [], []
            for i, raw in enumerate(batch.column(2).cast(pa.binary())):
                raw = raw.as_py() or b""
                for at in range(0, max(0, len(raw) - LONG + 1), PIECE):
                    text = Hashed(raw[at : at + PIECE + LONG - 1], powers)
                    place, gram, first, last = anchors(text)
                    ctx = mixed(text.of(first, last + LONG) ^ (place - first + 1).astype(np.uint64))
                    rows.append(np.full(len(place), i))
                    parts.append((gram.view(np.int64), ctx.view(np.int64), first + at, last + at))
            if not parts:
                continue
            taken = pa.array(np.concatenate(rows))
            columns = [batch.column(k).take(taken) for k in (0, 1)]
            columns += [pa.array(np.concatenate(c)) for c in zip(*parts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "h", "gram", "ctx", "first", "last"])

    longs = [T.StructField(c, T.LongType()) for c in ("h", "gram", "ctx", "first", "last")]
    return docs.select("doc_id", "h", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], *longs]))


class Family:
    """Levels of sorted arrays (gram, n): how many suffixes begin with each gram.

    A new batch is scanned against itself and every level for beginnings that meet; then it
    becomes a level, and as long as there are two of one size they are merged into one of twice
    the size. So there are at most log2(batches) + 1 levels, and a suffix is merged as often.
    """

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []
        self.met: DataFrame | None = None

    def insert(self, suffixes: DataFrame) -> None:
        batch = saved(self._array(suffixes.select("gram", F.lit(1).cast("long").alias("n"))), "level")
        found = [batch.filter("n > 1").select("gram")]
        found += [batch.join(level.select("gram"), "gram", "left_semi").select("gram") for _, level in self.levels]
        for part in found:
            self.met = part if self.met is None else self.met.union(part)
        size = 1
        while self.levels and self.levels[-1][0] == size:
            batch = saved(self._array(self.levels.pop()[1].union(batch)), "level")
            size *= 2
        self.levels.append((size, batch))

    @staticmethod
    def _array(rows: DataFrame) -> DataFrame:
        return rows.groupBy("gram").agg(F.sum("n").alias("n")).sortWithinPartitions("gram")


def string_rows(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(id, w, at): hash and place of every string of LONG bytes that begins in the ranges, from
    `ranges` (doc_id, h, r array of (id, first, last))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for raw, spans in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()):
                raw = raw.as_py()
                for span in spans:
                    text = Hashed(raw[span["first"] : span["last"] + LONG], powers)
                    hashes = text.every(LONG).view(np.int64)
                    at = np.arange(span["first"], span["last"] + 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), span["id"])), pa.array(hashes), pa.array(at)], names=["id", "w", "at"]
                    )

    joined = docs.join(ranges, [docs.doc_id.eqNullSafe(ranges.doc_id), docs.h == ranges.h]).select("text", "r")
    return joined.mapInArrow(run, "id BIGINT, w BIGINT, at BIGINT")


def joined_runs(spans: DataFrame) -> DataFrame:
    """(doc_id, h, runs): maximal runs [start, stop) of bytes, from spans of string starts."""
    spans = spans.select("doc_id", "h", F.col("first").alias("start"), (F.col("last") + LONG).alias("stop"))
    order = Window.partitionBy("doc_id", "h").orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    runs = opened.withColumn("run", F.sum("new").over(order)).groupBy("doc_id", "h", "run")
    runs = runs.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))


def repeated_runs(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, h, runs) of the `keyed` documents in which a string of LONG bytes also begins
    anywhere else; runs are the maximal ranges of bytes that such strings cover.

    Suffixes whose beginning meets no other cannot be repeated. Of the rest, those with an equal
    twin (all strings of one anchor at once) are settled by counting. What remains are the ends
    of repeated passages: there each string is compared by itself, with one twin of each kind.
    """
    family, entries = Family(), None
    for i in range(batches):
        part = docs.filter(F.pmod(F.xxhash64("doc_id", "h"), F.lit(batches)) == i) if batches > 1 else docs
        part = saved(suffix_rows(part), "suffixes")
        family.insert(part)
        entries = part if entries is None else entries.union(part)
    met = saved(family.met.distinct(), "met")
    met = sent_if_small(met, F.lit(16))
    candidates = saved(entries.join(met, "gram", "left_semi"), "candidates")

    kinds = candidates.groupBy("gram", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "h", "first", "last")).alias("one")
    )
    kinds = saved(kinds, "kinds")
    single = kinds.filter("n = 1").select("gram").distinct()
    open_kinds = kinds.join(single, "gram", "left_semi").select("one.*")
    ranges = saved(open_kinds.withColumn("id", F.monotonically_increasing_id()), "ranges")
    by_doc = ranges.groupBy("doc_id", "h").agg(F.collect_list(F.struct("id", "first", "last")).alias("r"))
    by_doc = saved(by_doc, "ranges-by-document")
    strings = string_rows(docs, sent_if_small(by_doc, F.size("r") * 24 + 32))
    # Rows of repeated texts give the same strings twice; one of each place counts.
    strings = strings.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("w")))
    ends = strings.filter("n > 1").groupBy("id").agg(F.array_distinct(F.collect_list("at")).alias("at"))
    ends = ends.join(ranges, "id").select("doc_id", "h", F.explode("at").alias("first")).withColumn("last", F.col("first"))
    twins = candidates.join(kinds.filter("n > 1").select("gram", "ctx"), ["gram", "ctx"], "left_semi")
    return joined_runs(twins.select("doc_id", "h", "first", "last").union(ends))


def without_repeats(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n_bytes, runs, kept BINARY) of every row: the text without repeated bytes.

    NULL and short texts have no runs. A row that is repeated is a repeat of itself, so nothing
    of it is kept if it is long enough. An empty table gives an empty result.
    """
    rows = keyed_bytes(docs, id_col, text_col)
    runs = saved(repeated_runs(rows), "runs")
    runs = sent_if_small(runs, F.size("runs") * 16 + 32).select(F.col("doc_id").alias("i"), F.col("h").alias("j"), "runs")
    joined = rows.join(runs, rows.doc_id.eqNullSafe(F.col("i")) & (rows.h == F.col("j")), "left")
    joined = joined.select("doc_id", "text", F.coalesce("runs", F.array().cast("array<struct<start:bigint,stop:bigint>>")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes = [], []
            for raw, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist()):
                raw = raw.as_py() or b""
                at = [0, *(x for s in spans for x in (s["start"], s["stop"])), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(at[::2], at[1::2])))
                sizes.append(len(raw))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), batch.column(2), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "runs", "kept"],
            )

    kind = T.StructType([
        joined.schema["doc_id"], T.StructField("n_bytes", T.LongType()), joined.schema["runs"], T.StructField("kept", T.BinaryType()),
    ])
    return joined.mapInArrow(run, kind)
