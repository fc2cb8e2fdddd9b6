"""Join of addresses to the blocks that hold them, for tables of both families of addresses.

IPv4 rows take the join of `geojoin`. For IPv6 a block of length p holds an address exactly if
their first p of 128 bits agree, so the join is one on (length, high, low) of the prefix. The
lengths that occur near an address are listed for each /16 of the space, at most 65,536 rows of at
most 129 lengths, which are broadcast; blocks shorter than /12 are entered per /12.

The families stay apart: an IPv4 address in IPv6 notation lies in IPv6 blocks only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillscope.functions import ip_to_long
from tillscope.functions.address6 import cidr6_prefix, ip6_parts, last6, network6
from tillscope.operators.computed import as_computed, compute_once
from tillscope.operators.geojoin import BROADCAST_BYTES, _estimated_bytes, block_index, cidr_join

_AREA_BITS, _CELL_BITS = 16, 12


def _area(high: str) -> Column:
    return F.shiftrightunsigned(high, 64 - _AREA_BITS).cast("int")


def _steps(first: str, last: str, bits: int) -> Column:
    """The cells of so many bits from one high BIGINT to another."""
    return F.sequence(F.shiftrightunsigned(first, 64 - bits), F.shiftrightunsigned(last, 64 - bits))


def _ranges(blocks: DataFrame, network: str) -> DataFrame:
    """_row, _len and the first and last address of the IPv6 blocks; other texts have no row."""
    high, low = ip6_parts("_text")
    rows = blocks.select(F.struct(*blocks.columns).alias("_row"), cidr6_prefix(f"`{network}`").alias("_len"), F.substring_index(network, "/", 1).alias("_text"))
    rows = compute_once(rows.filter(F.col("_text").contains(":")), "_parts", F.struct(high.alias("h"), low.alias("l")))
    rows = rows.select("_row", "_len", F.col("_parts.h").alias("_h"), F.col("_parts.l").alias("_l"))
    rows = rows.filter("_len IS NOT NULL AND _h IS NOT NULL")
    first, last = network6("_h", "_l", "_len"), last6("_h", "_l", "_len")
    names = ("_first_h", "_first_l", "_last_h", "_last_l")
    return rows.select("_row", "_len", *[c.alias(n) for c, n in zip((*first, *last), names)])


def _entries(ranges: DataFrame) -> DataFrame:
    """The blocks by join key: those shorter than a cell once for each cell."""
    cells = F.when(F.col("_len") < _CELL_BITS, _steps("_first_h", "_last_h", _CELL_BITS))
    keys = F.coalesce(F.transform(cells, lambda c: F.shiftleft(c, 64 - _CELL_BITS)), F.array("_first_h"))
    return ranges.withColumn("_key_h", F.explode(keys)).withColumn("_key_l", F.col("_first_l"))


def _presence(ranges: DataFrame) -> DataFrame:
    spans = ranges.select("_len", _area("_first_h").alias("a"), _area("_last_h").alias("b"))
    areas = spans.distinct().select("_len", F.explode(F.sequence("a", "b")).alias("_area"))
    return areas.groupBy("_area").agg(F.collect_set("_len").alias("_lens"))


def cidr6_join(
    addresses: DataFrame,
    blocks: DataFrame,
    *,
    high: str = "ip_high",
    low: str = "ip_low",
    network: str = "network",
    bounds: str = "inclusive",
    match: str = "all",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of IPv6 addresses to blocks: the columns of both. See `cidr_join` for `bounds`
    and `match`. Blocks that are no IPv6 blocks, and NULL addresses, match nothing."""
    if bounds not in ("inclusive", "strict"):
        raise ValueError(f"unknown bounds: {bounds}")
    if match not in ("all", "longest"):
        raise ValueError(f"unknown match: {match}")
    ranges = _ranges(blocks, network)
    small = _estimated_bytes(ranges) <= broadcast_bytes
    if match == "longest":
        # Of the blocks of one network only the least row counts, so a probe meets one row at most.
        network_of_block = ("_len", "_first_h", "_first_l", "_last_h", "_last_l")
        ranges = ranges.groupBy(*network_of_block).agg(F.min("_row").alias("_row"))
    # The longest match is looked up once for each different address.
    keys = addresses if match == "all" else addresses.select(high, low).distinct()
    near = keys.join(F.broadcast(_presence(ranges)), _area(high) == F.col("_area"))
    near = near.withColumn("_len", F.explode("_lens")).withColumn("_cell", F.greatest("_len", F.lit(_CELL_BITS)))
    key_h, _ = network6(high, low, "_cell")
    _, key_l = network6(high, low, "_len")
    probes = near.withColumns({"_key_h": key_h, "_key_l": key_l}).drop("_area", "_lens", "_cell")
    entries = _entries(ranges)
    found = probes.join(F.broadcast(entries) if small else entries, ["_len", "_key_h", "_key_l"])
    if bounds == "strict":
        edges = [(F.col(high) == F.col(f"_{e}_h")) & (F.col(low) == F.col(f"_{e}_l")) for e in ("first", "last")]
        found = found.filter(~edges[0] & ~edges[1])
    if match == "all":
        return found.select(*addresses.columns, "_row.*")
    nearest = F.min(F.struct((-F.col("_len")).alias("_less"), "_row"))
    best = found.groupBy(high, low).agg(nearest.alias("_best")).select(high, low, "_best._row.*")
    return addresses.join(best, [high, low]).select(*addresses.columns, *blocks.columns)


def mixed_join(addresses: DataFrame, blocks: DataFrame, *, ip: str = "ip", network: str = "network", **options: str) -> DataFrame:
    """Inner join of addresses in text form, of either family, to blocks of either family."""
    columns = [*addresses.columns, *blocks.columns]
    addresses = as_computed(addresses)
    is_six = F.coalesce(F.col(ip).contains(":"), F.lit(False))
    four = addresses.filter(~is_six).withColumn("_long", ip_to_long(ip))
    four = cidr_join(four, block_index(blocks, network=network), address="_long", **options)
    parts = F.struct(*[c.alias(n) for c, n in zip(ip6_parts(ip), "hl")])
    six = compute_once(addresses.filter(is_six), "_parts", parts)
    six = six.withColumns({"_high": F.col("_parts.h"), "_low": F.col("_parts.l")}).drop("_parts")
    six = cidr6_join(six, blocks, high="_high", low="_low", network=network, **options)
    return four.select(columns).unionByName(six.select(columns))
