"""Lines that arrive as files, routed by event time to one or several sinks.

The source is a directory: files are added to it, and each is read once. Progress is kept
in the checkpoint. Every sink partitions its output by batch below the day, and a batch
replaces just its own partitions, so a batch that runs again after a failure leaves no
line twice and none out, in any sink.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillscope.functions.moments import parse_moment_sql
from tillscope.sinks.commits import commit_batch, write_folder
from tillscope.sinks.files import layout_columns
from tillscope.sources.files import REJECTED, parse_purchases

INGEST_TIME = -1
# Files of a batch, unless the caller bounds it.
MAX_FILES = 1_000
_BATCH = "batch_id"


@dataclass(frozen=True)
class LineSink:
    """Where lines go: a directory, its layout (flat, dt or ymd) and its file size in lines."""

    path: str
    layout: str = "flat"
    max_records_per_file: int = 0


def read_line_stream(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Lines (`value`) of the files that appear in a directory, bounded per batch.

    The bound is a number of files or of bytes, not both; by default MAX_FILES files.
    """
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    reader = spark.readStream
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger or MAX_FILES)
    return reader.text(path)


def classify_lines(
    lines: DataFrame, *, date_index: int = INGEST_TIME, min_fields: int = 3
) -> DataFrame:
    """Add event_ts and reason to lines; reason is NULL on good lines.

    event_ts is the time in field `date_index`, counted from 0, or the time of the batch
    with INGEST_TIME. Lines of fewer than `min_fields` fields and lines without a readable
    time are to be rejected.
    """
    # Trailing empty fields do not count.
    fields = "split(rtrim(',', value), ',')"
    if date_index == INGEST_TIME:
        event_ts = F.current_timestamp().cast("timestamp_ntz")
    else:
        event_ts = F.expr(parse_moment_sql(f"get(split(value, ','), {date_index})"))
    return lines.select("value", event_ts.alias("event_ts")).withColumn(
        "reason",
        F.when(F.expr(f"size({fields})") < min_fields, F.lit("too_few_fields")).when(
            F.col("event_ts").isNull(), F.lit("bad_time")
        ),
    )


def classify_purchases(lines: DataFrame) -> DataFrame:
    """As `classify_lines`, with the rule and the time of `parse_purchases`: what is not
    rejected here is a row of every later read."""
    parsed = parse_purchases(lines.select("value", F.col("value").alias("line")), keep_rejected=True)
    return parsed.select(
        F.col("line").alias("value"),
        F.col("ts").alias("event_ts"),
        F.when(F.col(REJECTED).isNotNull(), F.lit("no_purchase")).alias("reason"),
    )


def route(lines: DataFrame, *, date_index: int = INGEST_TIME, min_fields: int = 3, purchases: bool = False) -> DataFrame:
    """Lines with their time and, if they are to be rejected, the reason."""
    if purchases:
        return classify_purchases(lines)
    return classify_lines(lines, date_index=date_index, min_fields=min_fields)


def _write_batch(rows: DataFrame, sink: LineSink, batch_id: int) -> None:
    parts = layout_columns(sink.layout)
    rows = rows.withColumns({**parts, _BATCH: F.lit(batch_id)}).select("value", *parts, _BATCH)
    if parts:
        # Lines of a day are brought together, a large day stays in several tasks.
        rows = rows.hint("rebalance", *parts)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", sink.max_records_per_file)
        .partitionBy(*parts, _BATCH)
        .text(sink.path)
    )


def _write_commit(rows: DataFrame, sink: LineSink, name: str) -> None:
    parts = layout_columns(sink.layout)
    rows = rows.withColumns(parts).hint("rebalance", *parts) if parts else rows
    write_folder(rows, sink.path, name, list(parts), sink.max_records_per_file)


def folder_writers(rows: DataFrame, sinks: Sequence[LineSink], rejects: str) -> dict[str, Callable[[str], None]]:
    """By path what writes routed rows to the folder of a commit, for every sink and the rejects."""
    good, bad = rows.where(F.col("reason").isNull()), rows.where(F.col("reason").isNotNull())
    writers: dict[str, Callable[[str], None]] = {sink.path: partial(_write_commit, good, sink) for sink in sinks}
    writers[rejects] = lambda name: write_folder(bad, rejects, name, ["reason"])
    return writers


def _write_rejects(rows: DataFrame, path: str, batch_id: int) -> None:
    (
        rows.withColumn(_BATCH, F.lit(batch_id))
        .select("value", "reason", _BATCH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("reason", _BATCH)
        .text(path)
    )


def ingest_lines(
    lines: DataFrame,
    sinks: Sequence[LineSink],
    *,
    checkpoint: str,
    rejects: str,
    date_index: int = INGEST_TIME,
    min_fields: int = 3,
    purchases: bool = False,
    interval: str | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Start the ingest: each batch is read once and written to all sinks.

    Lines that cannot be routed go to `rejects`, by reason, so none is lost. With `purchases`
    the lines are purchases, routed by their own time, and only what every reader of purchases
    takes for one is routed; else `date_index` and `min_fields` decide (`classify_lines`).
    With an `interval` the query polls for new files for ever; without, it takes what is
    there in bounded batches and stops. A failed batch stops the query; starting it again
    with the same checkpoint resumes at that batch.

    With a `log` each batch becomes visible in all sinks and in the rejects at once, to those who
    read with `sinks.commits.read_committed`; the log belongs to this checkpoint, whose name it
    knows its batches by.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if log is not None:
                commit_batch(batch.sparkSession, log, checkpoint, batch_id, folder_writers(batch, sinks, rejects))
                return
            good = batch.where(F.col("reason").isNull())
            for sink in sinks:
                _write_batch(good, sink, batch_id)
            _write_rejects(batch.where(F.col("reason").isNotNull()), rejects, batch_id)
        finally:
            batch.unpersist()

    routed = route(lines, date_index=date_index, min_fields=min_fields, purchases=purchases)
    writer = routed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def read_sink(spark: SparkSession, sink: LineSink) -> DataFrame:
    """Lines of a sink with the partition columns of its layout, as strings."""
    parts = list(layout_columns(sink.layout))
    schema = ", ".join(["value STRING", *[f"{p} STRING" for p in parts], f"{_BATCH} BIGINT"])
    return spark.read.schema(schema).text(sink.path).drop(_BATCH)
