"""Registered queries: name to function of (session, folder of the test tables)."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.functions import (
    cidr_contains,
    cidr_first,
    cidr_last,
    cidr_prefix,
    day_text,
    epoch_ms,
    ip_to_long,
    long_to_ip,
    parse_moment,
    register_functions,
)
from tillscope.functions.address import cidr_first_sql, cidr_last_sql, long_to_ip_sql
from tillscope.operators import (
    cidr_join,
    compute_once,
    count_by,
    spend_by_ip,
    spend_by_ip_long,
    with_category_total,
)
from tillscope.operators.computed import as_computed
from tillscope.operators.geojoin import block_index
from tillscope.operators.geojoin6 import mixed_join
from tillscope.operators.ranking import sort_desc
from tillscope.plans import reports, views
from tillscope.plans.incremental import KeptReports
from tillscope.session import scratch_path
from tillscope.sinks import append_lines, write_all, write_csv
from tillscope.sinks.commits import CommitLog, compact, read_committed, read_folders
from tillscope.sinks.files import flags_as_ints, lines_of, write_purchases
from tillscope.sources import catalog, files, schemas, startables, synthetic
from tillscope.streaming import (
    LineSink,
    follow_lines,
    ingest_lines,
    read_line_stream,
    read_sink,
    supervised_ingest,
)
from tillscope.streaming.supervise import UNREADABLE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_FIELDS = ("name", "price", "ts", "category", "ip")


def _registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Projections, filters and functions


@_registered
def preview_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = startables.purchases(spark, sf_dir)
    return files.preview(rows.orderBy(*[F.col(c).asc_nulls_first() for c in _FIELDS]), 10)


@_registered
def project_rename_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = startables.purchases(spark, sf_dir).select(
        F.concat(F.lit(" "), "name", F.lit(" ")).alias("name"),
        F.col("price").cast("string").alias("price"),
        "ip",
    )
    return lines.select(
        F.trim("name").alias("product"),
        F.col("price").cast("float").cast("double").alias("price"),
        F.col("ip").alias("address"),
    )


@_registered
def epoch_ms_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return startables.table(spark, sf_dir, "events").select(
        "event_id", epoch_ms("ts").alias("epoch_ms")
    )


@_registered
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = startables.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 50 == 0, F.lit("no time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .alias("text"),
    )
    parsed = texts.select("event_id", parse_moment("text").alias("ts"))
    return parsed.select(
        "event_id", "ts", day_text("ts").alias("dt"), epoch_ms("ts").alias("epoch_ms")
    )


@_registered
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = compute_once(startables.purchases(spark, sf_dir), "ip_long", ip_to_long("ip"))
    return rows.where(
        (F.col("ip_long") > cidr_first("'96.0.0.0/3'"))
        & (F.col("ip_long") < cidr_last("'96.0.0.0/3'"))
    ).select("name", "ip", "price")


def _written_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their address written in different ways."""
    address = startables.order_address("l_orderkey")
    octets = "split(dotted, '\\\\.')"
    return (
        startables.table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", F.expr(long_to_ip_sql(address)).alias("dotted"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.expr(
                f"""CASE l_linenumber
                      WHEN 1 THEN concat(' ', dotted)
                      WHEN 2 THEN concat(get({octets}, 0), '.', get({octets}, 1))
                      WHEN 3 THEN concat(CAST(get({octets}, 0) AS INT) + 256, ' . ',
                                         get({octets}, 1), '.', get({octets}, 2), '.',
                                         get({octets}, 3))
                      WHEN 4 THEN concat(dotted, '.77')
                      WHEN 5 THEN concat('x', dotted)
                      WHEN 6 THEN NULL
                      ELSE dotted END"""
            ).alias("ip"),
        )
    )


@_registered
def ip_to_long_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_addresses(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        ip_to_long("ip").alias("ip_long"),
        ip_to_long("ip", null_as_zero=True).alias("ip_or_zero"),
    )


def _owned_cidrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks written with the owner's own address, host bits included."""
    return startables.block_owners(spark, sf_dir).select(
        "geoname_id", F.concat(long_to_ip("address"), F.lit("/"), "prefix_len").alias("network")
    )


@_registered
def cidr_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owned_cidrs(spark, sf_dir).select(
        "network",
        cidr_prefix("network").alias("prefix_len"),
        cidr_first("network").alias("start_ip"),
        cidr_last("network").alias("end_ip"),
    )


@_registered
def cidr_dotted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _owned_cidrs(spark, sf_dir).select(
        "network",
        long_to_ip(cidr_first_sql("network")).alias("first_address"),
        long_to_ip(cidr_last_sql("network")).alias("last_address"),
    )


def _address_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with an address and a block near it."""
    address = startables.spread("l_orderkey")
    near = f"(({address} + l_linenumber * 65536L) % {startables.SPACE}L)"
    return startables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.expr(long_to_ip_sql(address)).alias("ip"),
        F.expr(f"concat({long_to_ip_sql(near)}, '/', 8 + l_partkey % 17)").alias("cidr"),
    )


@_registered
def cidr_contains_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _address_pairs(spark, sf_dir).select(
        "ip", "cidr", cidr_contains("ip", "cidr").alias("inside")
    )


@_registered
def sql_registered_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_functions(spark)
    return spark.sql(
        """SELECT ip, cidr, getIP(ip) AS ip_long, getStartIP(cidr) AS start_ip,
                  getEndIP(cidr) AS end_ip, getNetworkAddress(cidr) AS first_address,
                  getBroadcastAddress(cidr) AS last_address, isInRange(ip, cidr) AS inside
           FROM {pairs}""",
        pairs=_address_pairs(spark, sf_dir),
    )


# Aggregations and sorting


@_registered
def count_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(startables.purchases(spark, sf_dir), "category")


@_registered
def count_by_name_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(startables.purchases(spark, sf_dir), "name", "category")


@_registered
def spend_by_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_by_ip(startables.purchases(spark, sf_dir))


@_registered
def spend_by_address_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spend_by_ip_long(startables.purchases(spark, sf_dir))


@_registered
def sort_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_by(startables.purchases(spark, sf_dir), "name")
    return sort_desc(counts.select("cnt", "name"), "cnt", "name")


# Joins


@_registered
def block_country_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        startables.blocks(spark, sf_dir)
        .join(startables.countries(spark, sf_dir), "geoname_id")
        .select("network", "geoname_id", "country_name")
    )


@_registered
def category_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_by(startables.purchases(spark, sf_dir), "name", "category")
    return with_category_total(counts)


def _geo_join(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    index = reports.geo_blocks(startables.blocks(spark, sf_dir))
    spend = spend_by_ip(startables.purchases(spark, sf_dir))
    return cidr_join(spend, index, **options).select("ip", "sump", "network", "geoname_id")


@_registered
def geo_join_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo_join(spark, sf_dir)


@_registered
def geo_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As geo_join_inclusive, the way blocks take that are too large to broadcast."""
    index = block_index(
        startables.blocks(spark, sf_dir).select("network", "geoname_id"), broadcast_bytes=0
    )
    spenders = spend_by_ip(startables.purchases(spark, sf_dir))
    return cidr_join(spenders, index).select("ip", "sump", "network", "geoname_id")


@_registered
def geo_join_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo_join(spark, sf_dir, bounds="strict")


@_registered
def geo_join_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo_join(spark, sf_dir, match="longest")


@_registered
def geo_join_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spenders of both families: those with an even address come from IPv6 as well, where the
    customers own blocks of /40 to /64 that nest by their length."""
    spend = as_computed(spend_by_ip(startables.purchases(spark, sf_dir)))
    six = F.format_string("2001:db8:%x:%x::%x", F.expr("shiftright(ip_long, 16)"), F.expr("ip_long & 65535"), F.expr("ip_long % 97"))
    spenders = spend.select("ip", "sump").unionByName(
        spend.where("ip_long % 2 = 0").select(six.alias("ip"), "sump")
    )
    owners = startables.table(spark, sf_dir, "customer").select(
        F.expr(startables.spread("c_custkey")).alias("n"),
        F.expr("CAST(40 + c_custkey % 25 AS INT)").alias("p"),
        F.col("c_nationkey").cast("long").alias("geoname_id"),
    )
    text = F.format_string("2001:DB8:%x:%x::/%d", F.expr("shiftright(n, 16)"), F.expr("n & 65535"), "p")
    blocks = startables.blocks(spark, sf_dir).select("network", "geoname_id")
    blocks = blocks.unionByName(owners.select(text.alias("network"), "geoname_id"))
    return mixed_join(spenders, blocks, match="longest").select("ip", "sump", "network", "geoname_id")


# Reports


@_registered
def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_categories(startables.purchases(spark, sf_dir))


@_registered
def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products(startables.purchases(spark, sf_dir))


@_registered
def top_products_k100(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products(startables.purchases(spark, sf_dir), k=100)


@_registered
def all_products_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products(startables.purchases(spark, sf_dir), k=None)


@_registered
def top_products_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_products_per_category(startables.purchases(spark, sf_dir))


@_registered
def top_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_ips(startables.purchases(spark, sf_dir))


@_registered
def top_ips_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_ips_pruned(startables.purchases(spark, sf_dir))


@_registered
def top_ip_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_ip_countries(
        startables.purchases(spark, sf_dir),
        startables.blocks(spark, sf_dir),
        startables.countries(spark, sf_dir),
    )


@_registered
def top_ip_countries_k10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_ip_countries(
        startables.purchases(spark, sf_dir),
        startables.blocks(spark, sf_dir),
        startables.countries(spark, sf_dir),
        pre_k=10,
        bounds="strict",
    )


@_registered
def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_countries(
        startables.purchases(spark, sf_dir),
        startables.blocks(spark, sf_dir),
        startables.countries(spark, sf_dir),
    )


@_registered
def top_countries_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_countries(
        startables.purchases(spark, sf_dir),
        startables.blocks(spark, sf_dir),
        startables.countries(spark, sf_dir),
        match="all",
    )


@_registered
def top_countries_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_countries(
        startables.purchases(spark, sf_dir),
        startables.blocks(spark, sf_dir),
        startables.countries(spark, sf_dir),
        match="longest",
    )


# SQL views


@_registered
def view_top_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT ip, iip, sump FROM {vproduct}",
        vproduct=views.top_ip_view(startables.purchases(spark, sf_dir)),
    )


@_registered
def view_block_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT geoname_id, startip, endip FROM {vcountryip}",
        vcountryip=views.block_bounds_view(startables.blocks(spark, sf_dir)),
    )


@_registered
def view_product_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT dt, min(dateAsLong) AS first_ms, max(IPAsLong) AS max_ip, count(*) AS cnt
           FROM {product} WHERE category IS NOT NULL GROUP BY dt""",
        product=views.product_view(startables.purchases(spark, sf_dir)),
    )


# Files: written, read back


@_registered
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purchases-csv")
    write_csv(startables.purchases(spark, sf_dir), path, _FIELDS)
    return files.read_purchases(spark, path)


@_registered
def purchase_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purchase-lines")
    quoted = F.concat(F.lit('"'), "name", F.lit('" \\'))
    write_purchases(startables.purchases(spark, sf_dir).withColumn("name", quoted), path)
    return files.read_purchases(spark, path)


@_registered
def quoted_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "countries-csv")
    supplier = startables.table(spark, sf_dir, "supplier")
    named = (
        supplier.join(
            startables.countries(spark, sf_dir), F.col("s_nationkey") == F.col("geoname_id")
        )
        .withColumn(
            "country_name",
            F.concat("country_name", F.lit(', the "'), "s_name", F.lit('" of \\')),
        )
        .withColumn("geoname_id", F.col("s_suppkey"))
    )
    write_csv(flags_as_ints(named), path, schemas.COUNTRIES.names)
    return files.read_countries(spark, path)


@_registered
def blocks_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "blocks-csv")
    write_csv(flags_as_ints(startables.blocks(spark, sf_dir)), path, schemas.BLOCKS.names)
    return files.read_blocks(spark, path)


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase lines of the events, with event_ts."""
    rows = startables.events_as_purchases(spark, sf_dir)
    texts = rows.withColumn("ts_text", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
    return texts.select(
        F.concat_ws(",", "name", F.col("price").cast("string"), "ts_text", "category", "ip").alias(
            "value"
        ),
        F.col("ts").alias("event_ts"),
    )


@_registered
def reference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block lines of all customers, some with an id that is none or with fields missing: the
    good ones by id, and each bad one with its text."""
    path = scratch_path(spark, "blocks-bad")
    network = F.concat(long_to_ip("n"), F.lit("/16"))
    owners = startables.table(spark, sf_dir, "customer").select(
        F.expr(startables.spread("c_custkey")).alias("n"), F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("id")
    )
    line = (
        F.when(F.expr("k % 53 = 5"), F.concat_ws(",", network, F.lit("abc"), "id", "id", F.lit("0"), F.lit("1")))
        .when(F.expr("k % 59 = 7"), F.concat_ws(",", network, "id"))
        .otherwise(F.concat_ws(",", network, "id", F.lit(""), "id", F.lit("0"), F.lit("1")))
    )
    append_lines(owners.select(line.alias("value")), path)
    read = files.read_blocks(spark, path, keep_rejected=True)
    return read.groupBy(F.col(files.REJECTED).alias("rejected"), "geoname_id", "is_satellite_provider").agg(
        F.count(F.lit(1)).alias("lines"), F.min("start_ip").alias("first_ip")
    )


@_registered
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purchases-dt")
    append_lines(_dated_lines(spark, sf_dir), path, "dt", gather=True)
    return files.read_purchases(spark, path, partitioned=True)


@_registered
def partition_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purchases-dt")
    append_lines(_dated_lines(spark, sf_dir), path, "dt", gather=True)
    days = files.read_purchases(spark, path, partitioned=True).where(
        F.col("dt").between("2024-01-05", "2024-01-07")
    )
    return count_by(days, "dt", "category")


@_registered
def purchase_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "purchases-table")
    append_lines(_dated_lines(spark, sf_dir), path, "dt", gather=True)
    name = f"purchases_{uuid.uuid4().hex}"
    catalog.create_purchase_table(spark, name, path)
    return spark.sql(f"SELECT name, price, ts, category, ip, dt FROM {name}")


@_registered
def ymd_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines-ymd")
    append_lines(_dated_lines(spark, sf_dir), path, "ymd", gather=True)
    return (
        spark.read.schema("value STRING, year STRING, month STRING, day STRING").text(path)
    )


@_registered
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines = lines_of(startables.purchases(spark, sf_dir), "name", "price", "category", "ip")
    with_category = F.col("value").contains(",category")
    append_lines(lines.where(with_category), path)
    append_lines(lines.where(~with_category), path)
    return files.read_lines(spark, path)


@_registered
def rolled_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines-rolled")
    lines = lines_of(startables.purchases(spark, sf_dir), "name", "ip")
    append_lines(lines, path, max_records_per_file=1000)
    per_file = (
        files.read_lines(spark, path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return per_file.agg(
        F.sum("lines").alias("lines"), (F.max("lines") <= 1000).alias("within_limit")
    )


@_registered
def rows_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = reports.top_products(startables.purchases(spark, sf_dir), k=None)
    return counts.to(schemas.TOP_PRODUCTS)


@_registered
def cached_multi_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "reports")
    spend = spend_by_ip(startables.purchases(spark, sf_dir)).select("ip", "sump")
    write_all(
        spend,
        lambda df: write_csv(df, f"{path}/csv", ("ip", "sump")),
        lambda df: append_lines(lines_of(df, "ip"), f"{path}/lines"),
    )
    as_csv = spark.read.schema("ip STRING, sump DOUBLE").csv(f"{path}/csv")
    as_lines = files.read_lines(spark, f"{path}/lines").select(F.col("value").alias("ip"))
    return as_csv.join(as_lines, "ip").select("ip", "sump")


@_registered
def synthetic_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = startables.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id")
    )
    return synthetic.add_purchases(ids)


# Streaming ingest


def _arriving_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase lines of the events, some of them cut short or without a readable time."""
    rows = startables.table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("concat('user_', user_id)").alias("name"),
        F.col("value").cast("string").alias("price"),
        F.when(F.col("event_id") % 89 == 5, F.lit("yesterday"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .alias("ts_text"),
        F.col("event_type").alias("category"),
        F.expr(long_to_ip_sql(startables.spread("user_id"))).alias("ip"),
    )
    return rows.select(
        "event_id",
        F.when(F.col("event_id") % 97 == 7, F.concat_ws(",", "name", "price"))
        .otherwise(F.concat_ws(",", "name", "price", "ts_text", "category", "ip"))
        .alias("value"),
    )


def _ingest(
    spark: SparkSession,
    sf_dir: str,
    sinks: list[LineSink],
    scratch: str,
    purchases: bool = False,
    log: str | None = None,
    max_files: int = 256,
    after: Callable[[], object] = lambda: None,
) -> None:
    """Ingest all lines in two runs on one checkpoint, new files arriving in between; `after`
    each run something else."""
    lines = _arriving_lines(spark, sf_dir)
    for half in (0, 1):
        append_lines(
            lines.where(F.col("event_id") % 2 == half).select("value"),
            f"{scratch}/in",
            max_records_per_file=100_000,
        )
        ingest_lines(
            read_line_stream(spark, f"{scratch}/in", max_files_per_trigger=max_files),
            sinks,
            checkpoint=f"{scratch}/checkpoint",
            rejects=f"{scratch}/rejects",
            date_index=2,
            purchases=purchases,
            log=log,
        ).awaitTermination()
        after()


@_registered
def stream_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_path(spark, "stream-date")
    sink = LineSink(f"{scratch}/product", "dt", 20_000)
    _ingest(spark, sf_dir, [sink], scratch)
    return read_sink(spark, sink)


@_registered
def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_path(spark, "stream-fanout")
    by_day = LineSink(f"{scratch}/product", "dt", 20_000)
    nested = LineSink(f"{scratch}/event", "ymd", 1_000)
    flat = LineSink(f"{scratch}/raw")
    _ingest(spark, sf_dir, [by_day, nested, flat], scratch)
    copies = [
        read_sink(spark, by_day).select(F.lit("product").alias("sink"), "dt", "value"),
        read_sink(spark, nested).select(
            F.lit("event").alias("sink"),
            F.concat_ws("-", "year", "month", "day").alias("dt"),
            "value",
        ),
        read_sink(spark, flat).select(
            F.lit("raw").alias("sink"), F.lit("all").alias("dt"), "value"
        ),
    ]
    return (
        copies[0]
        .unionByName(copies[1])
        .unionByName(copies[2])
        .groupBy("sink", "dt")
        .agg(F.count(F.lit(1)).alias("lines"), F.max("value").alias("last_line"))
    )


@_registered
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = scratch_path(spark, "stream-rejects")
    _ingest(spark, sf_dir, [LineSink(f"{scratch}/product", "dt")], scratch)
    return (
        spark.read.schema("value STRING, reason STRING, batch_id BIGINT")
        .text(f"{scratch}/rejects")
        .select("value", "reason")
    )


def _grow(lines: DataFrame, folder: str, sizes: dict[str, int], *, complete: bool) -> dict[str, int]:
    """Append lines (log, value) to the files of a folder, each in one task; their new sizes.

    The break of a last line is written with what follows, or with `complete`. A file is cut to
    its known size first, so a task that runs again appends nothing twice.
    """

    def append(batches):
        ends = {}
        for batch in batches:
            rows = zip(batch["log"].to_pylist(), batch["value"].to_pylist())
            for log, of_log in groupby(rows, key=itemgetter(0)):
                path = f"{folder}/{log}.log"
                with open(path, "ab") as file:
                    if path not in ends:
                        file.truncate(sizes.get(path, 0))
                    data = b"".join(b"\n" + value.encode() for _, value in of_log)
                    file.write(data if file.tell() else data[1:])
                    ends[path] = file.tell()
        for path in ends if complete else ():
            with open(path, "ab") as file:
                ends[path] += file.write(b"\n")
        yield pa.RecordBatch.from_pydict({"path": list(ends), "size": list(ends.values())})

    dealt = lines.repartition("log").sortWithinPartitions("log", "value").select("log", "value")
    return {r["path"]: r["size"] for r in dealt.mapInArrow(append, "path string, size long").collect()}


@_registered
def stream_growing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines appended to eight files, taken in after each of three rounds; the last line of a
    round has no line break until the next one."""
    scratch = scratch_path(spark, "stream-growing")
    folder = "/" + scratch.removeprefix("file:").lstrip("/") + "/in"
    os.makedirs(folder)
    sink = LineSink(f"{scratch}/product", "dt", 20_000)
    lines = _arriving_lines(spark, sf_dir)
    sizes: dict[str, int] = {}
    for part in range(3):
        arrived = lines.where(F.col("event_id") % 3 == part).withColumn("log", F.col("event_id") % 8)
        sizes |= _grow(arrived, folder, sizes, complete=part == 2)
        ingest_lines(
            follow_lines(spark, folder, range_bytes=1 << 20),
            [sink],
            checkpoint=f"{scratch}/checkpoint",
            rejects=f"{scratch}/rejects",
            date_index=2,
        ).awaitTermination()
    return read_sink(spark, sink)


@_registered
def ingest_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From arriving lines to a report on the catalog table over what the ingest wrote."""
    scratch = scratch_path(spark, "ingest-table")
    sink = LineSink(f"{scratch}/product", "dt", 20_000)
    _ingest(spark, sf_dir, [sink], scratch, purchases=True)
    name = f"purchases_{uuid.uuid4().hex}"
    catalog.create_purchase_table(spark, name, sink.path, batches=True)
    return reports.top_categories(spark.table(name))


@_registered
def stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks that show all of a batch or nothing, one of them compacted after each run."""
    scratch = scratch_path(spark, "stream-committed")
    by_day, flat, log = LineSink(f"{scratch}/product", "dt"), LineSink(f"{scratch}/raw"), f"{scratch}/log"
    _ingest(
        spark, sf_dir, [by_day, flat], scratch, log=log, max_files=1,
        after=lambda: compact(spark, log, by_day.path, by_day.layout),
    )
    copies = [
        read_committed(spark, log, by_day.path, "dt").select(F.lit("product").alias("sink"), "dt", "value"),
        read_committed(spark, log, flat.path).select(F.lit("raw").alias("sink"), F.lit("all").alias("dt"), "value"),
    ]
    return (
        copies[0]
        .unionByName(copies[1])
        .groupBy("sink", "dt")
        .agg(F.count(F.lit(1)).alias("lines"), F.max("value").alias("last_line"))
    )


@_registered
def stream_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingest among whose files are two that cannot be read: the lines of the others by day,
    and for the two their names."""
    scratch = scratch_path(spark, "stream-supervised")
    lines = _arriving_lines(spark, sf_dir).select("value")
    append_lines(lines, f"{scratch}/in", max_records_per_file=20_000)
    # Lines of the table under a name that promises a compressed file.
    append_lines(lines.limit(1_000), f"{scratch}/plain")
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    plain = store.globStatus(root.suffix("/plain/part-*"))[0].getPath()
    for name in ("a", "b"):
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
            store, plain, store, root.suffix(f"/in/{name}.txt.gz"), False, spark._jsc.hadoopConfiguration()
        )
    sink, log = LineSink(f"{scratch}/product", "dt"), f"{scratch}/log"
    supervised_ingest(
        spark, f"{scratch}/in", [sink], checkpoint=f"{scratch}/checkpoint", rejects=f"{scratch}/rejects", log=log,
        attempts=2, pause=0.1, date_index=2,
    )
    rejected = read_folders(spark, f"{scratch}/rejects", CommitLog(spark, log).state().live[f"{scratch}/rejects"], ["reason"])
    aside = rejected.where(F.col("reason") == UNREADABLE).select(
        F.regexp_extract("value", "([^/]*)\t", 1).alias("value"), F.col("reason").alias("dt")
    )
    return read_committed(spark, log, sink.path, "dt").unionByName(aside)


@_registered
def stream_kept_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three reports from aggregates that are brought up to date after each run of an ingest,
    with a compaction of its lines in between."""
    scratch = scratch_path(spark, "stream-kept")
    sink, log = LineSink(f"{scratch}/product", "dt"), f"{scratch}/log"
    kept = KeptReports(spark, f"{scratch}/store", log, sink.path)

    def after() -> None:
        kept.refresh()
        compact(spark, log, sink.path, sink.layout)

    _ingest(spark, sf_dir, [sink], scratch, purchases=True, log=log, after=after)
    kept.refresh()
    rows = [
        kept.top_categories().select(F.lit("categories").alias("report"), F.col("category").alias("item"), F.col("cnt").cast("double").alias("amount")),
        kept.top_products().select(F.lit("products"), F.concat_ws("/", "name", "category"), F.col("cnt").cast("double")),
        kept.top_ips().select(F.lit("ips"), "ip", "sump"),
    ]
    return rows[0].union(rows[1]).union(rows[2])


@_registered
def spend_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of prices of fractions of a cent, half cents and negative ones."""
    rows = startables.table(spark, sf_dir, "lineitem").select(
        F.expr("concat('10.0.0.', l_linenumber)").alias("ip"),
        F.expr("CAST((l_orderkey % 2001 - 1000) / 1000.0D + 0.004D AS DOUBLE)").alias("price"),
    )
    return spend_by_ip(rows)


@_registered
def batch_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a file by what the reader makes of them; none is lost."""
    path = scratch_path(spark, "lines")
    prices = F.expr(
        "element_at(array('NaN', 'Infinity', '1e30', 'dear', '-1e12'), CAST(event_id % 5 AS INT) + 1)"
    )
    lines = _arriving_lines(spark, sf_dir)
    odd = F.col("event_id") % 83 == 11
    made = F.concat_ws(",", F.lit("odd"), prices, F.lit("2024-01-01 00:00:00"), F.lit("c"), F.lit("1.2.3.4"))
    append_lines(lines.select(F.when(odd, made).otherwise(F.col("value")).alias("value")), path)
    read = files.read_purchases(spark, path, keep_rejected=True)
    return read.groupBy(
        F.col(files.REJECTED).alias("rejected"), F.when(F.col(files.REJECTED).isNull(), F.col("category")).alias("category")
    ).agg(F.count(F.lit(1)).alias("lines"))
