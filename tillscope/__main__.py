"""Command line: generate purchases, ingest lines, write the reports."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.plans.reports import all_reports
from tillscope.session import build_session
from tillscope.sinks import append_lines, write_all, write_csv, write_jdbc
from tillscope.sinks.files import LAYOUTS, lines_of
from tillscope.sources import files
from tillscope.sources.synthetic import synthetic_purchases
from tillscope.streaming import LineSink, ingest_lines, read_line_stream


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def _sink(text: str) -> LineSink:
    """LAYOUT=PATH or LAYOUT=PATH,LINES_PER_FILE."""
    layout, target = _pair(text)
    path, _, lines = target.partition(",")
    if layout not in LAYOUTS or not path:
        raise argparse.ArgumentTypeError(f"not LAYOUT=PATH[,LINES]: {text}")
    return LineSink(path, layout, int(lines or 0))


def _generate(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = synthetic_purchases(
        spark, args.rows, products=args.products, categories=args.categories, seed=args.seed
    )
    append_lines(lines_of(rows, "name", "price", "ts", "category", "ip"), args.output)


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    lines = read_line_stream(
        spark,
        args.input,
        max_files_per_trigger=args.max_files,
        max_bytes_per_trigger=args.max_bytes,
    )
    ingest_lines(
        lines,
        args.sink,
        checkpoint=args.checkpoint,
        rejects=args.rejects,
        date_index=args.date_index,
        purchases=args.purchases,
        interval=args.interval,
    ).awaitTermination()


# What the CSV of a report holds, where it is not all of its columns.
_CSV_COLUMNS = {"top_ip_countries": ("sump", "ip", "country_name")}


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.rejects:
        kept = files.read_purchases(
            spark, args.purchases, keep_rejected=True, partitioned=args.partitioned
        )
        rejected = kept.where(F.col(files.REJECTED).isNotNull())
        rejected.select(F.col(files.REJECTED).alias("value")).write.mode("overwrite").text(args.rejects)
    reports = all_reports(
        files.read_purchases(
            spark, args.purchases, strict=not args.rejects, partitioned=args.partitioned
        ),
        files.read_blocks(spark, args.blocks, strict=True),
        files.read_countries(spark, args.countries, strict=True),
        k=args.k,
        pre_k=args.pre_k,
        bounds=args.bounds,
        match=args.match,
    )
    try:
        for name, frame in reports.frames.items():
            write_all(frame, *_writers(name, args))
    finally:
        reports.release()


def _writers(name: str, args: argparse.Namespace) -> list:
    def to_csv(frame: DataFrame) -> None:
        write_csv(frame, f"{args.output}/{name}", _CSV_COLUMNS.get(name))

    writers = [to_csv]
    if args.jdbc_url:
        writers.append(
            partial(
                write_jdbc, url=args.jdbc_url, table=name, properties=dict(args.jdbc_property)
            )
        )
    return writers


def parse_arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tillscope", description=__doc__)
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    commands = parser.add_subparsers(required=True)

    generate = commands.add_parser("generate", help="write random purchase lines")
    generate.add_argument("output")
    generate.add_argument("rows", type=int)
    generate.add_argument("products", type=int)
    generate.add_argument("categories", type=int)
    generate.add_argument("--seed", type=int, default=42)
    generate.set_defaults(run=_generate)

    ingest = commands.add_parser("ingest", help="route the lines of arriving files to sinks")
    ingest.add_argument("input")
    ingest.add_argument("--sink", type=_sink, action="append", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--rejects", required=True, help="where lines go that cannot be routed")
    ingest.add_argument("--purchases", action="store_true", help="lines are purchases")
    ingest.add_argument("--date-index", type=int, default=-1)
    bound = ingest.add_mutually_exclusive_group()
    bound.add_argument("--max-files", type=int)
    bound.add_argument("--max-bytes", type=int)
    ingest.add_argument("--interval", help="keep polling, as in '10 seconds'")
    ingest.set_defaults(run=_ingest)

    report = commands.add_parser("report", help="write all reports as CSV, and to a database")
    report.add_argument("purchases")
    report.add_argument("countries")
    report.add_argument("blocks")
    report.add_argument("output")
    report.add_argument("--partitioned", action="store_true", help="purchases lie in dt= folders")
    report.add_argument("--rejects", help="where malformed purchases go; without it they fail the report")
    report.add_argument("--k", type=int, default=10)
    report.add_argument("--pre-k", type=int, default=100)
    report.add_argument("--bounds", choices=("inclusive", "strict"), default="inclusive")
    report.add_argument("--match", choices=("all", "longest"))
    report.add_argument("--jdbc-url")
    report.add_argument("--jdbc-property", type=_pair, action="append", default=[])
    report.set_defaults(run=_report)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parse_arguments(argv)
    args.run(spark or build_session("tillscope", args.master), args)


if __name__ == "__main__":
    main()
