"""Reports from kept aggregates against the same reports over all lines."""

import random

import pytest

from tillscope.plans import incremental, reports
from tillscope.plans.incremental import KeptReports
from tillscope.sinks import commits
from tillscope.sinks.commits import compact, read_committed, vacuum
from tillscope.sources.files import parse_purchases
from tillscope.streaming import LineSink, ingest_lines, read_line_stream


def _lines(rng, n):
    return [
        f"p{rng.randrange(15)},{rng.randrange(1, 9999) / 1000},2010-10-{rng.randrange(10, 28)} 01:02:03.5,"
        f"c{rng.randrange(5)},10.0.{rng.randrange(3)}.{rng.randrange(9)}"
        for _ in range(n)
    ]


@pytest.fixture()
def ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    sink = LineSink(str(tmp_path / "product"), "dt")
    log = str(tmp_path / "log")

    def run(name, lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        ingest_lines(
            read_line_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1), [sink], purchases=True,
            checkpoint=str(tmp_path / "checkpoint"), rejects=str(tmp_path / "rejects"), log=log,
        ).awaitTermination()

    run.sink, run.log, run.folder = sink, log, tmp_path
    run.kept = KeptReports(spark, str(tmp_path / "store"), log, sink.path)
    return run


def _same(spark, ingest):
    purchases = parse_purchases(read_committed(spark, ingest.log, ingest.sink.path, "dt").select("value"))
    for name in ("top_categories", "top_products", "top_products_per_category", "top_ips"):
        expected = [tuple(r) for r in getattr(reports, name)(purchases).collect()]
        assert sorted(map(tuple, getattr(ingest.kept, name)().collect())) == sorted(expected), name
    assert expected


def test_equals_the_full_report_after_late_and_repeated_batches(spark, ingest, monkeypatch):
    rng = random.Random(1)
    assert ingest.kept.refresh() == 0 and ingest.kept.top_ips().count() == 0
    ingest("a.txt", _lines(rng, 40))
    ingest("b.txt", _lines(rng, 40) + ["bad,line"])
    assert ingest.kept.refresh() == 2
    assert ingest.kept.refresh() == 0
    _same(spark, ingest)
    # A batch that runs again, a late one of old days, and a compaction in between.
    for name in ("1", ".1.crc"):
        (ingest.folder / "checkpoint" / "commits" / name).unlink()
    assert compact(spark, ingest.log, ingest.sink.path, "dt") > 0
    ingest("late.txt", ["p1,5,2001-01-01 00:00:00,c1,10.0.0.1"] * 7)
    vacuum(spark, ingest.log, ingest.sink.path, older_than=3600)
    read = []
    folders = commits.read_folders
    monkeypatch.setattr(incremental, "read_folders", lambda s, p, names, parts: read.extend(names) or folders(s, p, names, parts))
    assert ingest.kept.refresh() == 1
    assert len(read) == 1  # only the folder of the new batch was read
    _same(spark, ingest)
    vacuum(spark, ingest.log, ingest.sink.path, older_than=0)
    _same(spark, ingest)


def test_parts_are_merged(spark, ingest, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_PARTS", 2)
    rng = random.Random(2)
    for i in range(4):
        ingest(f"{i}.txt", _lines(rng, 20))
        assert ingest.kept.refresh() == 1
    assert len(ingest.kept._commits.state().live["parts"]) <= 2
    _same(spark, ingest)


def test_refresh_that_fails_adds_nothing(spark, ingest, monkeypatch):
    ingest("a.txt", _lines(random.Random(3), 30))

    def broken(self, counts, spent, name):
        counts.write.parquet(f"{self.store}/counts/{name}")
        raise OSError("disk full")

    monkeypatch.setattr(KeptReports, "_write", broken)
    with pytest.raises(OSError):
        ingest.kept.refresh()
    assert ingest.kept.top_ips().count() == 0
    monkeypatch.undo()
    assert ingest.kept.refresh() == 1
    _same(spark, ingest)
