"""The log of commits: all sinks or none, no batch twice, compaction without loss."""

import pytest
from pyspark.errors.exceptions.base import PySparkException

from tillscope.sinks import commits
from tillscope.sinks.commits import CommitLog, compact, read_committed, vacuum
from tillscope.streaming import LineSink, ingest_lines, read_line_stream
from tillscope.streaming import ingest as ingest_module


def _line(i):
    return f"product{i}, 50{i % 10}.5, 2010-10-{15 + i % 3} 17:03:21.250, category{i % 3}, 10.0.0.{i}"


class Ingest:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.sinks = [LineSink(str(folder / "product"), "dt"), LineSink(str(folder / "event"), "ymd"), LineSink(str(folder / "raw"))]
        self.log, self.lines = str(folder / "log"), []
        (folder / "in").mkdir()

    def drop(self, name, lines):
        (self.folder / "in" / name).write_text("\n".join(lines) + "\n")
        self.lines += lines

    def run(self):
        ingest_lines(
            read_line_stream(self.spark, str(self.folder / "in"), max_files_per_trigger=1),
            self.sinks,
            checkpoint=str(self.folder / "checkpoint"),
            rejects=str(self.folder / "rejects"),
            date_index=2,
            log=self.log,
        ).awaitTermination()

    def seen(self, sink):
        return sorted(r.value for r in read_committed(self.spark, self.log, sink.path, sink.layout).collect())


@pytest.fixture()
def ingest(spark, tmp_path):
    return Ingest(spark, tmp_path)


def test_crash_between_two_sinks_shows_nothing_then_all(ingest, monkeypatch):
    ingest.drop("a.txt", [_line(i) for i in range(6)])
    ingest.run()
    before = sorted(ingest.lines)
    write = ingest_module._write_commit

    def failing(rows, sink, name):
        if sink is ingest.sinks[1]:
            raise OSError("disk full")
        write(rows, sink, name)

    monkeypatch.setattr(ingest_module, "_write_commit", failing)
    ingest.drop("b.txt", [_line(i) for i in range(6, 12)])
    with pytest.raises(PySparkException):
        ingest.run()
    for sink in ingest.sinks:
        assert ingest.seen(sink) == before
    monkeypatch.undo()
    ingest.run()
    for sink in ingest.sinks:
        assert ingest.seen(sink) == sorted(ingest.lines)
    # What the failed attempt left is not live, and goes.
    first = ingest.sinks[0]
    assert len(vacuum(ingest.spark, ingest.log, first.path, older_than=0)) == 1
    assert ingest.seen(first) == sorted(ingest.lines)


def test_batch_that_was_committed_is_not_written_again(ingest):
    """The query stopped after the entry of the log, before that of its checkpoint."""
    ingest.drop("a.txt", [_line(i) for i in range(5)] + ["too,short"])
    ingest.run()
    for name in ("0", ".0.crc"):
        (ingest.folder / "checkpoint" / "commits" / name).unlink()
    ingest.run()
    for sink in ingest.sinks:
        assert ingest.seen(sink) == sorted(ingest.lines[:5])
    rejects = str(ingest.folder / "rejects")
    live = CommitLog(ingest.spark, ingest.log).state().live[rejects]
    rows = commits.read_folders(ingest.spark, rejects, live, ["reason"]).collect()
    assert [(r.value, r.reason) for r in rows] == [("too,short", "too_few_fields")]


def test_compaction_lessens_files_and_keeps_lines(ingest):
    for part in range(5):
        ingest.drop(f"{part}.txt", [_line(i) for i in range(part * 10, part * 10 + 10)])
    ingest.run()
    day, nested, flat = ingest.sinks
    log = CommitLog(ingest.spark, ingest.log)

    def files(sink):
        return commits._files(ingest.spark, sink.path, log.state().live[sink.path]).collect()

    for sink, least in ((day, 3), (nested, 3), (flat, 1)):
        n = len(files(sink))
        assert n >= 5
        held = read_committed(ingest.spark, ingest.log, sink.path, sink.layout)
        assert compact(ingest.spark, ingest.log, sink.path, sink.layout) == n
        assert len(files(sink)) == least
        assert ingest.seen(sink) == sorted(ingest.lines)
        assert held.count() == 50  # of the old files, which are still there
        assert compact(ingest.spark, ingest.log, sink.path, sink.layout) == 0
    assert {(r.dt, r.value) for r in read_committed(ingest.spark, ingest.log, day.path, "dt").collect()} == {
        (f"2010-10-{15 + i % 3}", _line(i)) for i in range(50)
    }
    # Bins of a smaller target: more files, and batches that came meanwhile stay as they are.
    ingest.drop("late.txt", [_line(i) for i in range(50, 60)])
    ingest.run()
    assert compact(ingest.spark, ingest.log, flat.path, target_bytes=100) == 0
    assert ingest.seen(flat) == sorted(ingest.lines)
    assert len(vacuum(ingest.spark, ingest.log, flat.path, older_than=0)) == 5
    assert vacuum(ingest.spark, ingest.log, flat.path, older_than=3600) == []
    assert ingest.seen(flat) == sorted(ingest.lines)


def test_bins_hold_whole_files_of_one_day(spark):
    files = spark.createDataFrame(
        [(f"c{i}", "d1" if i % 2 else "d2", "f", 10 * (i + 1)) for i in range(12)], "commit string, folder string, file string, length long"
    )
    got = {}
    for r in commits.bins(files, 100).collect():
        got.setdefault((r.folder, r.bin), []).append(r.length)
    assert sum(map(len, got.values())) == 12
    assert all(sum(lengths) < 100 + max(lengths) for lengths in got.values())


def test_of_two_compactions_one_counts(spark, tmp_path, monkeypatch):
    path, log = str(tmp_path / "s"), str(tmp_path / "log")
    for n in range(3):
        commits.write_folder(spark.createDataFrame([(f"line {n}",)], "value string"), path, f"b{n}", [])
        assert CommitLog(spark, log).commit({path: [f"b{n}"]}, writer="w", batch=n)
    write = commits.write_folder

    def slower(*args):
        monkeypatch.undo()
        assert compact(spark, log, path) == 3
        write(*args)

    monkeypatch.setattr(commits, "write_folder", slower)
    assert compact(spark, log, path) == 0
    assert sorted(r.value for r in read_committed(spark, log, path).collect()) == [f"line {n}" for n in range(3)]


def test_log_of_many_entries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 4)
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.state() == commits.State()
    for n in range(11):
        assert log.commit({"s": [f"c{n}"]}, writer="w", batch=n)
    assert not log.commit({"s": ["again"]}, writer="w", batch=7)
    assert log.commit({"s": ["k"]}, remove={"s": ["c1", "c2"]})
    assert not log.commit({"s": ["k2"]}, remove={"s": ["c1"]})
    state = log.state()
    assert state.live == {"s": ["c0", *[f"c{n}" for n in range(3, 11)], "k"]} and state.batches == {"w": 10}
    # A number that is taken is not written over.
    assert not log._put(3, {"writer": "x"})
    assert log.state() == state
    assert read_committed(spark, log.path, "nowhere").count() == 0
