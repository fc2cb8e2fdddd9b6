"""An ingest that goes on after errors.

A query that stops with an error is started again after a pause, which doubles with each failure
of the same batch. A batch that fails ATTEMPTS times is taken apart: its files are written as a
whole, else as two halves, and so on, until each file that cannot be read is alone. Those are set
aside in the rejects with the error, the others are committed as that batch in one entry of the
log, and the query, which finds its batch committed, goes on behind it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillscope.sinks.commits import CommitLog, commit_id, has_files, write_folder
from tillscope.streaming.ingest import LineSink, folder_writers, ingest_lines, read_line_stream, route

#: Failures of a batch before it is taken apart, the first pause and the longest one in seconds.
ATTEMPTS, PAUSE, LONGEST_PAUSE = 3, 1.0, 300.0
#: What a failing job raises.
ERRORS = (PySparkException, Py4JJavaError, OSError)
#: Why a file is in the rejects, whose `value` is its path, a tab and the error.
UNREADABLE = "unreadable_file"


def files_of_batch(spark: SparkSession, checkpoint: str, batch: int) -> list[str]:
    """The files that the file source has planned for a batch, from its log in the checkpoint."""
    found = []
    for row in spark.read.text(f"{checkpoint}/sources/0/{batch}*").collect():
        if row.value.startswith("{"):
            entry = json.loads(row.value)
            if entry["batchId"] == batch:
                found.append(entry["path"])
    return sorted(set(found))


def _message(error: Exception) -> str:
    text = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
    return " ".join((text or type(error).__name__).split())


def place_files(
    files: Sequence[str], place: Callable[[Sequence[str]], str], readable: Callable[[str], bool]
) -> tuple[list[str], list[tuple[str, str]]]:
    """Place files together if that works, else each half by itself: the names of what was placed,
    and the files that could not be, with the error. A file that can be read is not to blame, so
    its error is raised."""
    try:
        return [place(files)], []
    except ERRORS as error:
        if len(files) == 1:
            if readable(files[0]):
                raise
            return [], [(files[0], _message(error))]
    half = len(files) // 2
    placed, aside = place_files(files[:half], place, readable)
    more, bad = place_files(files[half:], place, readable)
    return placed + more, aside + bad


def take_apart(
    spark: SparkSession,
    files: Sequence[str],
    sinks: Sequence[LineSink],
    rejects: str,
    options: dict,
) -> tuple[dict[str, list[str]], list[tuple[str, str]]]:
    """Write what can be read of some files: folders by sink, for one commit, and the other files
    with the error. Each part is written to all sinks or counts in none."""

    def place(some: Sequence[str]) -> str:
        name = commit_id("part")
        rows: DataFrame = route(spark.read.schema("value STRING").text(list(some)), **options)
        for write in folder_writers(rows, sinks, rejects).values():
            write(name)
        return name

    def readable(file: str) -> bool:
        try:
            spark.read.text(file).write.format("noop").mode("overwrite").save()
            return True
        except ERRORS:
            return False

    placed, aside = place_files(files, place, readable)
    paths = [*(sink.path for sink in sinks), rejects]
    add = {path: [name for name in placed if has_files(spark, path, name)] for path in paths}
    if aside:
        name = commit_id("aside")
        rows = spark.createDataFrame([(f"{path}\t{error}",) for path, error in aside], "value STRING")
        write_folder(rows.withColumn("reason", F.lit(UNREADABLE)), rejects, name, ["reason"])
        add[rejects].append(name)
    return add, aside


def supervised_ingest(
    spark: SparkSession,
    path: str,
    sinks: Sequence[LineSink],
    *,
    checkpoint: str,
    rejects: str,
    log: str,
    attempts: int = ATTEMPTS,
    pause: float = PAUSE,
    sleep: Callable[[float], None] = time.sleep,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    interval: str | None = None,
    **options: object,
) -> StreamingQuery:
    """`ingest_lines` of the files of a folder until it ends without an error; its last query.

    `options` are those of `ingest_lines` that decide about lines. An error that comes before a
    batch has any files, or that taking the batch apart does not mend, is raised after `attempts`
    failures. Without an `interval` the ingest ends when all files have been taken in.
    """
    failures, failed = 0, -1
    while True:
        lines = read_line_stream(
            spark, path, max_files_per_trigger=max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger
        )
        query = ingest_lines(lines, sinks, checkpoint=checkpoint, rejects=rejects, log=log, interval=interval, **options)
        try:
            query.awaitTermination()
            return query
        except PySparkException:
            commits = CommitLog(spark, log)
            batch = commits.state().batches.get(checkpoint, -1) + 1
            failures, failed = (failures + 1 if batch == failed else 1), batch
            if failures >= attempts:
                if failures > attempts:
                    raise
                try:
                    files = files_of_batch(spark, checkpoint, batch)
                except PySparkException:
                    files = []
                if not files:
                    raise
                add, _ = take_apart(spark, files, sinks, rejects, options)
                commits.commit(add, writer=checkpoint, batch=batch)
            else:
                sleep(min(pause * 2 ** (failures - 1), LONGEST_PAUSE))
