"""A log of commits that makes what was written to several sinks visible as a whole.

What is written goes to a folder of its own, `commit=ID` below its sink. It counts only once an
entry of the log names it, and one entry names the folders of all sinks of a batch. Readers take
the folders that are live by the log, so they see all of a batch or nothing, in every sink, and
a batch that runs again after its entry was written is not written twice.

Compaction puts the files of small folders into bins of a target size, day by day, writes each
bin as one file to one new folder, and replaces the old folders by it in one entry. Old folders
stay for those who are reading them until `vacuum`.

Entries are numbered files that are renamed into place; a number that is taken is lost to another
writer, who is then taken into account. That is atomic where a rename that does not overwrite is.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.sinks.files import layout_columns

FOLDER = "commit"
#: Every so many entries, one holds the whole state, so that readers need none before it.
SNAPSHOT_EVERY = 20
TARGET_BYTES = 128 << 20


@dataclass
class State:
    """What counts after an entry: folders by sink, and the last batch of each writer."""

    version: int = -1
    live: dict[str, list[str]] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def after(self, version: int, entry: dict) -> State:
        if "state" in entry:
            return State(version, entry["state"]["live"], entry["state"]["batches"])
        live = {sink: list(folders) for sink, folders in self.live.items()}
        for sink, folders in entry["remove"].items():
            live[sink] = [x for x in live[sink] if x not in folders]
        for sink, folders in entry["add"].items():
            live[sink] = live.get(sink, []) + folders
        batches = self.batches | ({entry["writer"]: entry["batch"]} if entry["batch"] is not None else {})
        return State(version, live, batches)


class CommitLog:
    """The log in a folder, of one or several writers."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._root = self._path(self.path)
        self._fs = self._root.getFileSystem(self._conf)

    def _path(self, text: str):
        return self._jvm.org.apache.hadoop.fs.Path(text)

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._root)]
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json"))

    def _read(self, version: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/{version:020d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self) -> State:
        entries = []
        for version in reversed(self._versions()):
            entries.append((version, self._read(version)))
            if "state" in entries[-1][1]:
                break
        state = State()
        for version, entry in reversed(entries):
            state = state.after(version, entry)
        return state

    def entries(self, after: int = -1) -> list[tuple[int, dict]]:
        """Every entry behind a version, in order."""
        return [(version, self._read(version)) for version in self._versions() if version > after]

    def _put(self, version: int, entry: dict) -> bool:
        """Whether the entry has become the one of this version."""
        self._fs.mkdirs(self._root)
        made = self._path(f"{self.path}/.{uuid.uuid4().hex}")
        out = self._fs.create(made, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._root.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(made, self._path(f"{self.path}/{version:020d}.json"), self._gateway.new_array(rename, 0))
            return True
        except Py4JJavaError as error:
            self._fs.delete(made, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise

    def commit(
        self,
        add: dict[str, list[str]],
        *,
        remove: dict[str, list[str]] | None = None,
        writer: str = "",
        batch: int | None = None,
    ) -> bool:
        """Make folders count, and others no longer, in one step.

        False if that is out of date: the batch has been committed before, or a folder to be
        removed no longer counts.
        """
        entry = {"writer": writer, "batch": batch, "add": add, "remove": remove or {}}
        while True:
            state = self.state()
            if batch is not None and batch <= state.batches.get(writer, -1):
                return False
            if any(set(folders) - set(state.live.get(sink, [])) for sink, folders in entry["remove"].items()):
                return False
            version = state.version + 1
            written = entry
            if version % SNAPSHOT_EVERY == 0:
                after = state.after(version, entry)
                written = entry | {"state": {"live": after.live, "batches": after.batches}}
            if self._put(version, written):
                return True


def commit_id(label: object) -> str:
    """A new name for what a batch or a compaction writes; each attempt has its own."""
    return f"{label}-{uuid.uuid4().hex}"


def write_folder(rows: DataFrame, path: str, commit: str, parts: list[str], max_records_per_file: int = 0) -> None:
    """Lines (`value` and the partition columns) to the folder of a commit, which no one sees yet."""
    (
        rows.select("value", *parts)
        .write.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*parts)
        .text(f"{path}/{FOLDER}={commit}")
    )


def has_files(spark: SparkSession, path: str, commit: str) -> bool:
    """Whether the folder of a commit holds any lines; without, it has no partitions to be read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}={commit}")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return any(s.getPath().getName()[0] not in "._" for s in found)


def read_folders(spark: SparkSession, path: str, commits: list[str], parts: list[str]) -> DataFrame:
    """Lines of these commits: value, the partition columns, and `commit`."""
    kinds = ", ".join(["value STRING", f"{FOLDER} STRING", *[f"{p} STRING" for p in parts]])
    if not commits:
        return spark.createDataFrame([], kinds).select("value", *parts, FOLDER)
    reader = spark.read.schema(kinds).option("basePath", path)
    return reader.text([f"{path}/{FOLDER}={c}" for c in commits]).select("value", *parts, FOLDER, "_metadata")


def read_committed(spark: SparkSession, log: str, path: str, layout: str = "flat") -> DataFrame:
    """Lines of a sink that count by the log, with the partition columns of the layout."""
    parts = list(layout_columns(layout))
    return read_folders(spark, path, CommitLog(spark, log).state().live.get(path, []), parts).select("value", *parts)


def _files(spark: SparkSession, path: str, commits: list[str]) -> DataFrame:
    """(commit, folder, file, length) of the files of these commits; only names and sizes are read.
    `folder` is the one of the day, below that of the commit, empty without one."""
    files = spark.read.format("binaryFile").option("basePath", path).option("recursiveFileLookup", True)
    files = files.load([f"{path}/{FOLDER}={c}" for c in commits]).select("path", "length")
    inner = F.regexp_extract("path", f"/{FOLDER}=([^/]*)/(.*)$", 2)
    return files.select(
        F.regexp_extract("path", f"/{FOLDER}=([^/]*)/", 1).alias(FOLDER),
        F.regexp_extract(inner, "^(.*)/[^/]*$", 1).alias("folder"),
        F.regexp_extract(inner, "([^/]*)$", 1).alias("file"),
        "length",
    )


def bins(files: DataFrame, target: int) -> DataFrame:
    """The files with the number of their bin within the day: whole files, in the order of their
    names, as long as they begin within the target."""
    before = Window.partitionBy("folder").orderBy(FOLDER, "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / F.lit(target)))


def compact(spark: SparkSession, log: str, path: str, layout: str = "flat", *, target_bytes: int = TARGET_BYTES) -> int:
    """Replace the folders of a sink whose files have less than half the target on average by one
    with files of about the target; the number of files that went.

    Nothing happens with fewer than two such folders. If another compaction was faster, what this
    one wrote never counts. No line is lost or doubled at any time.
    """
    commits = CommitLog(spark, log)
    live = commits.state().live.get(path, [])
    if len(live) < 2:
        return 0
    files = _files(spark, path, live)
    sizes = files.groupBy(FOLDER).agg(F.avg("length").alias("mean"), F.count(F.lit(1)).alias("n")).collect()
    empty = set(live) - {r[FOLDER] for r in sizes}
    small = sorted(empty | {r[FOLDER] for r in sizes if 2 * r["mean"] < target_bytes})
    if len(small) < 2:
        return 0
    parts = list(layout_columns(layout))
    dealt = bins(files.filter(F.col(FOLDER).isin(small)), target_bytes)
    lines = read_folders(spark, path, small, parts)
    day = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in parts]) if parts else F.lit("")
    lines = lines.select("value", *parts, FOLDER, day.alias("folder"), F.col("_metadata.file_name").alias("file"))
    numbered = lines.join(dealt.drop("length"), [FOLDER, "folder", "file"])
    made = commit_id("compacted")
    n = max(1, dealt.select("folder", "bin").distinct().count())
    write_folder(numbered.repartition(n, "folder", "bin"), path, made, parts)
    done = commits.commit({path: [made]}, remove={path: small})
    return sum(r["n"] for r in sizes if r[FOLDER] in small) if done else 0


def vacuum(spark: SparkSession, log: str, path: str, *, older_than: float) -> list[str]:
    """Delete the folders of a sink that do not count and are older than so many seconds: replaced
    ones, and those of batches that failed. A batch that takes longer must not be running."""
    commits = CommitLog(spark, log)
    root = commits._path(path)
    store = root.getFileSystem(commits._conf)
    before = (time.time() - older_than) * 1000
    found = [s for s in store.listStatus(root) if s.getPath().getName().startswith(f"{FOLDER}=")]
    old = [s.getPath() for s in found if s.getModificationTime() <= before]
    # Read after the folders were listed: one that was committed in between counts.
    live = {f"{FOLDER}={c}" for c in commits.state().live.get(path, [])}
    gone = [p for p in old if p.getName() not in live]
    for folder in gone:
        store.delete(folder, True)
    return sorted(p.getName() for p in gone)


Writer = Callable[[str], None]


def commit_batch(spark: SparkSession, log: str, writer: str, batch: int, sinks: dict[str, Writer]) -> bool:
    """Write a batch to every sink, by path a function of the commit's name, and make it count in
    all of them at once. False, and nothing written, if the batch counts already."""
    commits = CommitLog(spark, log)
    if batch <= commits.state().batches.get(writer, -1):
        return False
    name = commit_id(batch)
    for write in sinks.values():
        write(name)
    add = {path: [name] for path in sinks if has_files(spark, path, name)}
    return commits.commit(add, writer=writer, batch=batch)
