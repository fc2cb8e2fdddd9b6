"""Lines that are appended to files, as a streaming source that follows them.

The files are one file, or all files of a folder, in a store that every executor reaches. An
offset has for each file the bytes that have been read, always up to a line break, and a mark of
the bytes before that place. So a last line that is still being written waits, and a file that
was cut, replaced or removed is an error, not a loss. Offsets are kept in the checkpoint.

A batch takes all that has been appended. It is cut into byte ranges, one for each task; a range
owns the lines that begin in it, and its task reads on to the end of the last one.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

#: Bytes of a range, of a read, of the mark before an offset, and lines handed on at once.
RANGE_BYTES, STEP, MARKED, BATCH = 64 << 20, 1 << 20, 1 << 10, 10_000

# Executors, and the process that plans for the driver, need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Read = Callable[[int, int], bytes]


def _store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


def list_files(path: str) -> dict[str, int]:
    """Sizes by path: of the file, or of the files of the folder whose names begin with neither
    a dot nor an underscore."""
    store, inner = _store(path)
    info = store.get_file_info(inner)
    if info.type == pyarrow.fs.FileType.File:
        return {inner: info.size}
    found = store.get_file_info(pyarrow.fs.FileSelector(inner, allow_not_found=True))
    files = [f for f in found if f.type == pyarrow.fs.FileType.File and f.base_name[0] not in "._"]
    return {f.path: f.size for f in sorted(files, key=lambda f: f.path)}


def last_break(read: Read, size: int) -> int:
    """Bytes up to and with the last line break."""
    end = size
    while end > 0:
        start = max(0, end - STEP)
        found = read(start, end - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    return 0


def mark(read: Read, at: int) -> int:
    """A checksum of the bytes before an offset."""
    start = max(0, at - MARKED)
    return zlib.crc32(read(start, at - start))


def owned_lines(read: Read, start: int, low: int, high: int, end: int) -> Iterator[bytes]:
    """The lines that begin in [low, high), of a file whose lines from `start` to `end`, which is
    behind a line break, are those of the batch."""
    # From the byte before, so that a line that begins at `low` is told from one that goes on.
    at, rest, skipping = (low, b"", False) if low == start else (low - 1, b"", True)
    begins = at  # of `rest`
    while at < end:
        chunk = read(at, min(STEP, end - at))
        if not chunk:
            raise EOFError(f"the file ends at byte {at}, before {end}")
        at += len(chunk)
        *lines, rest = (rest + chunk).split(b"\n")
        for line in lines:
            if skipping:
                skipping = False
            elif begins >= high:
                return
            else:
                yield line.removesuffix(b"\r")
            begins += len(line) + 1
        if begins >= high and not skipping:
            return


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    low: int
    high: int
    end: int


class FollowedFiles(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def _open(self, path: str) -> tuple[Read, pa.NativeFile]:
        store, inner = _store(self.path)
        file = store.open_input_file(path)
        return lambda at, n: file.read_at(n, at), file

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        latest = {}
        for path, size in list_files(self.path).items():
            read, file = self._open(path)
            with file:
                at = last_break(read, size)
                latest[path] = {"at": at, "mark": mark(read, at)}
        return latest

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        # Also asked for an empty range when a query starts again, so a loss is seen at once.
        sizes = list_files(self.path)
        for path, done in start.items():
            if path not in sizes:
                raise RuntimeError(f"{path} was removed after {done['at']} bytes of it had been read")
            if sizes[path] < done["at"]:
                raise RuntimeError(f"{path} was cut: {done['at']} bytes of it had been read, {sizes[path]} are left")
            read, file = self._open(path)
            with file:
                if mark(read, done["at"]) != done["mark"]:
                    raise RuntimeError(f"{path} was replaced: the bytes before {done['at']} are other ones")
        ranges = []
        for path, now in end.items():
            first = start.get(path, {"at": 0})["at"]
            for low in range(first, now["at"], self.range_bytes):
                ranges.append(ByteRange(path, first, low, min(low + self.range_bytes, now["at"]), now["at"]))
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        read, file = self._open(partition.path)

        def batch_of(lines: list[str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

        held, size = [], 0
        with file:
            for line in owned_lines(read, partition.start, partition.low, partition.high, partition.end):
                held.append(line.decode("utf-8", "replace"))
                size += len(line)
                if len(held) == BATCH or size > STEP:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)


class GrowingLines(DataSource):
    """Options: `path`, and `rangeBytes` of a task."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "value STRING"

    def streamReader(self, schema) -> FollowedFiles:
        return FollowedFiles(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


def follow_lines(spark: SparkSession, path: str, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Lines (`value`) that are appended to a file, or to the files of a folder, for
    `ingest_lines`. New files of the folder are read from their beginning.

    Lines end with \\n or \\r\\n; bytes that are no UTF-8 become U+FFFD. Each line arrives once, when
    its line break has been written.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").option("rangeBytes", range_bytes).load(path)
