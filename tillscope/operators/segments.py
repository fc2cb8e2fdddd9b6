"""Disjoint segments of the address space, each with the most specific block that holds it.

CIDR blocks are nested or apart, so their ends cut the space into segments within which the most
specific block does not change. A sweep over the blocks of a cell, sorted by their first address,
finds them with a stack of the blocks that are open, at most 33. It runs in Python workers, over
blocks only, streams them, and reads them once.

A lookup is one equi-join. Segments are cut at /16, and at /24 as well in a /16 of more than
CROWDED segments, so a join key stands for at most 256 of them; of these one holds the address.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_BITS = 8
AREA_BITS, SMALL_AREA_BITS = 16, 24
CROWDED = 64
#: Rows handed on at once.
BATCH = 10_000

_CELL_SHIFT = 32 - CELL_BITS
_AREA_SHIFT, _SMALL_SHIFT = 32 - AREA_BITS, 32 - SMALL_AREA_BITS

# Executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def swept(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """(lo, hi, row) of disjoint segments, from (cell, lo, hi, row) of nested intervals, sorted by
    cell and lo, the outer one first."""
    cell, at, still_open = None, 0, []

    def close(before):
        """Intervals that end before the next one begins; `before` None ends them all."""
        nonlocal at
        while still_open and (before is None or still_open[-1][0] < before):
            hi, row = still_open.pop()
            if at <= hi:
                yield at, hi, row
            at = hi + 1

    for own, lo, hi, row in blocks:
        yield from close(lo if own == cell else None)
        if still_open and at < lo:
            yield at, lo - 1, still_open[-1][1]
        cell, at = own, lo
        still_open.append((hi, row))
    yield from close(None)


def keyed(segments: Iterator[tuple]) -> Iterator[tuple]:
    """(_key, lo, hi, row): the segments cut at /16, and at /24 where a /16 has too many."""

    def cut(rows, shift):
        for lo, hi, row in rows:
            for part in range(lo >> shift, (hi >> shift) + 1):
                yield part, max(lo, part << shift), min(hi, ((part + 1) << shift) - 1), row

    def keys(area, held):
        if len(held) <= CROWDED:
            yield from ((area, *segment) for segment in held)
        else:
            yield from ((part + (1 << AREA_BITS), *segment) for part, *segment in cut(held, _SMALL_SHIFT))

    area, held = None, []  # at most 2^17 segments: those of one /16
    for part, *segment in cut(segments, _AREA_SHIFT):
        if part != area:
            yield from keys(area, held)
            area, held = part, []
        held.append(segment)
    yield from keys(area, held)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None

    def rows():
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field("row").type
            yield from zip(*(c.to_pylist() for c in batch.columns))

    segments = keyed(swept(rows()))
    while made := list(islice(segments, BATCH)):
        columns = zip(zip(*made), (pa.int64(), pa.int64(), pa.int64(), kind))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=["_key", "lo", "hi", "row"])


def sweep(blocks: DataFrame, bounds: str) -> DataFrame:
    """(_key, lo, hi, row) of the disjoint segments by join key, from (_len, _first, _last, row) of
    blocks that occur once each. With 'strict' bounds a block does not hold its own ends."""
    edge = 1 if bounds == "strict" else 0
    first, last = F.col("_first") + edge, F.col("_last") - edge
    cells = F.when(first <= last, F.sequence(F.shiftright(first, _CELL_SHIFT), F.shiftright(last, _CELL_SHIFT)))
    held = blocks.select("_len", "row", first.alias("lo"), last.alias("hi"), F.explode(cells).alias("cell"))
    cell_first = F.shiftleft("cell", _CELL_SHIFT)
    cell_last = cell_first + ((1 << _CELL_SHIFT) - 1)
    clipped = held.select("cell", F.greatest("lo", cell_first).alias("lo"), F.least("hi", cell_last).alias("hi"), "row", "_len")
    sorted_blocks = clipped.repartition("cell").sortWithinPartitions("cell", "lo", "_len").drop("_len")
    longs = [T.StructField(name, T.LongType()) for name in ("_key", "lo", "hi")]
    return sorted_blocks.mapInArrow(_sweep, T.StructType([*longs, sorted_blocks.schema["row"]]))


def keys_of(address: str) -> Column:
    """The two join keys of an address (a BIGINT), of which at most one has segments."""
    return F.array(F.shiftright(address, _AREA_SHIFT), F.shiftright(address, _SMALL_SHIFT) + (1 << AREA_BITS))
