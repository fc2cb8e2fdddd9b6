"""Join of addresses to the CIDR blocks that hold them.

A range condition would be planned as a nested loop over all pairs. A block of length p is
an aligned interval, so an address lies in it exactly if its first p bits are the block's.
That turns the range join into an equi-join on (p, first p bits), with one probe row per
address for each length that may match:

1. `presence` lists, for every /16 of the address space, the lengths of the blocks that
   overlap it. It has at most 65,536 rows of at most 33 lengths, whatever the tables hold,
   and is broadcast. It reduces the probes of an address from all lengths in the table to
   the lengths found in its neighbourhood, and drops addresses near no block at once.
2. Probes meet the blocks by equi-join on one BIGINT. A block shorter than /12 is entered
   once for each /12 it covers, so one join key stands for at most 2^20 different addresses
   and not for a quarter of the address space. The blocks are broadcast if the
   plan estimates few bytes for them; else both sides are shuffled by the key.

The longest match needs neither: the blocks are cut into disjoint segments, each with its most
specific block (`segments`), and an address meets the one that holds it.

A few addresses, such as a top-k, are the smaller side themselves. Their probes of all 33
lengths are broadcast, and the blocks are scanned once without any preparation.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import cidr_prefix, network_of
from tillscope.functions.address import cidr_address, last_of
from tillscope.operators.segments import keys_of, sweep

# Bytes, by the estimate of the plan, up to which the blocks are broadcast.
BROADCAST_BYTES = 64 << 20
# Addresses up to which their probes are broadcast: 33 rows each.
BROADCAST_ADDRESSES = 10_000

_PRESENCE_BITS = 16
_CELL_BITS = 12


def _key(cell: str | Column, prefix: str) -> Column:
    """One BIGINT for a cell (32 bits) and a length (6 bits)."""
    return F.shiftleft(cell, 6) + F.col(prefix)


def _estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _proven_rows(df: DataFrame) -> float:
    """Most rows that the plan can give, such as the number of a limit; else infinite."""
    rows = df._jdf.queryExecution().optimizedPlan().maxRows()
    return rows.get() if rows.isDefined() else float("inf")


@dataclass(frozen=True)
class BlockIndex:
    """Blocks prepared for `cidr_join`; reusable for any number of joins.

    `ranges` has the blocks' columns and _len, _first, _last, all NULL where the text is no
    IPv4 block.
    """

    ranges: DataFrame
    columns: tuple[str, ...]
    broadcast_bytes: int

    @cached_property
    def entries(self) -> DataFrame:
        """The blocks by join key: their columns and _key, _len, _first, _last."""
        # All join columns come out of the generator: filters that the join infers on them
        # stay above it and do not evaluate the text functions once more. No block, no cells,
        # no row.
        return self.ranges.select(
            *self.columns,
            F.inline(
                F.transform(
                    F.sequence("_first", "_last", F.lit(1 << (32 - _CELL_BITS))),
                    lambda cell: F.struct(
                        _key(cell, "_len").alias("_key"),
                        F.col("_len"),
                        F.col("_first"),
                        F.col("_last"),
                    ),
                )
            ),
        )

    def segments(self, bounds: str) -> DataFrame:
        """By join key the disjoint segments, with the least row of their most specific block:
        _key, lo, hi, row."""
        blocks = self.ranges.groupBy("_len", "_first", "_last")
        blocks = blocks.agg(F.min(F.struct(*self.columns)).alias("row"))
        return sweep(blocks, bounds)

    @cached_property
    def presence(self) -> DataFrame:
        """_area and the lengths _lens of the blocks that overlap this /16."""
        shift = 32 - _PRESENCE_BITS
        return (
            # Distinct before the expansion: copies of a short block are expanded once.
            self.ranges.select(
                "_len",
                F.shiftright("_first", shift).alias("lo"),
                F.shiftright("_last", shift).alias("hi"),
            )
            .distinct()
            .select("_len", F.explode(F.sequence("lo", "hi")).alias("_area"))
            .groupBy("_area")
            .agg(F.bit_or(F.expr("shiftleft(1L, _len)")).alias("mask"))
            .select(
                "_area", F.expr("filter(sequence(0, 32), i -> getbit(mask, i) = 1)").alias("_lens")
            )
        )

    @cached_property
    def small(self) -> bool:
        """Whether the entries may be broadcast: an estimate of the plan in bytes, all columns
        of the caller's blocks included. No job runs, and an unknown size is a large one."""
        return _estimated_bytes(self.ranges) <= self.broadcast_bytes


def block_index(
    blocks: DataFrame, *, network: str = "network", broadcast_bytes: int = BROADCAST_BYTES
) -> BlockIndex:
    """Index of blocks by their CIDR text. Rows whose text is no IPv4 block match nothing."""
    ranges = (
        blocks.withColumns({"_len": cidr_prefix(network), "_address": cidr_address(network)})
        .withColumn("_first", network_of("_address", "_len"))
        .withColumn("_last", last_of("_address", "_len"))
        .drop("_address")
    )
    return BlockIndex(ranges, tuple(blocks.columns), broadcast_bytes)


def _with_key(probes: DataFrame, address: str) -> DataFrame:
    cell = network_of(address, f"greatest(_len, {_CELL_BITS})")
    return probes.withColumn("_key", _key(cell, "_len")).drop("_len")


def _near(addresses: DataFrame, index: BlockIndex, address: str) -> DataFrame:
    """One row per address and length that occurs near it, with the join key."""
    # Never NULL, so that no filter on it is inferred and evaluates the address again.
    area = F.coalesce(F.shiftright(address, 32 - _PRESENCE_BITS), F.lit(-1))
    near = addresses.join(F.broadcast(index.presence), area == F.col("_area"))
    return _with_key(
        near.withColumn("_len", F.explode("_lens")).drop("_area", "_lens"), address
    )


def _join_keyed(
    probes: DataFrame, blocks: DataFrame, index: BlockIndex, few: bool
) -> DataFrame:
    """Equi-join on _key, with whichever side is known to be small broadcast."""
    if few:
        return blocks.join(F.broadcast(probes), "_key")
    return probes.join(F.broadcast(blocks) if index.small else blocks, "_key")


def _match(
    addresses: DataFrame, index: BlockIndex, address: str, bounds: str, few: bool
) -> DataFrame:
    if few:
        lengths = F.explode(F.sequence(F.lit(0), F.lit(32)))
        probes = _with_key(addresses.withColumn("_len", lengths), address)
    else:
        probes = _near(addresses, index, address)
    found = _join_keyed(probes, index.entries, index, few)
    if bounds == "strict":
        inside = (F.col(address) > F.col("_first")) & (F.col(address) < F.col("_last"))
        # As in `_near`: no inferred filter that parses every address once more.
        found = found.where(F.coalesce(inside, F.lit(False)))
    return found


def cidr_join(
    addresses: DataFrame,
    index: BlockIndex,
    *,
    address: str = "ip_long",
    bounds: str = "inclusive",
    match: str = "all",
    at_most: int | None = None,
) -> DataFrame:
    """Inner join of addresses to blocks: the columns of both.

    `bounds` is 'inclusive', or 'strict' to leave out a block's first and last address.
    `match` is 'all' for every block that holds the address, or 'longest' for the most
    specific one (the least row of it, should the network occur twice).
    `at_most` says that `addresses` has few rows, such as a limit; it counts only if the plan
    proves it.
    """
    if bounds not in ("inclusive", "strict"):
        raise ValueError(f"unknown bounds: {bounds}")
    if match not in ("all", "longest"):
        raise ValueError(f"unknown match: {match}")
    clash = set(addresses.columns) & set(index.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    few = at_most is not None and _proven_rows(addresses) <= min(at_most, BROADCAST_ADDRESSES)
    if match == "all":
        found = _match(addresses, index, address, bounds, few)
        return found.select(*addresses.columns, *index.columns)

    if few:
        # An address lies in one network of each length, so the greatest length names it.
        found = _match(addresses.select(address).distinct(), index, address, bounds, few)
        nearest = F.min(F.struct((-F.col("_len")).alias("_less"), F.struct(*index.columns).alias("_row")))
        best = found.groupBy(address).agg(nearest.alias("_best")).select(address, "_best._row.*")
        return addresses.join(F.broadcast(best), address)

    segments = index.segments(bounds)
    probes = addresses.withColumn("_key", F.explode(keys_of(address)))
    found = probes.join(F.broadcast(segments) if index.small else segments, "_key")
    # As in `_match`: no inferred filter.
    held = F.coalesce(F.col(address).between(F.col("lo"), F.col("hi")), F.lit(False))
    return found.where(held).select(*addresses.columns, "row.*")
