"""Errors of an ingest: passing ones heal, files that cannot be read are set aside."""

import gzip

import pytest
from pyspark.errors.exceptions.base import PySparkException

from tillscope.sinks.commits import CommitLog, read_committed, read_folders
from tillscope.streaming import LineSink, supervised_ingest
from tillscope.streaming import ingest as ingest_module
from tillscope.streaming.supervise import UNREADABLE, place_files


def _lines(name, n=4):
    return [f"{name}{i},1.5,2010-10-1{i} 00:00:00,c,1.2.3.4" for i in range(n)]


@pytest.fixture()
def ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    sinks = [LineSink(str(tmp_path / "product"), "dt"), LineSink(str(tmp_path / "raw"))]

    def run(**options):
        run.pauses = []
        supervised_ingest(
            spark, str(tmp_path / "in"), sinks, checkpoint=str(tmp_path / "checkpoint"), rejects=str(tmp_path / "rejects"),
            log=str(tmp_path / "log"), date_index=2, sleep=run.pauses.append, **options,
        )
        return [sorted(r.value for r in read_committed(spark, str(tmp_path / "log"), s.path, s.layout).collect()) for s in sinks]

    def rejected():
        path = str(tmp_path / "rejects")
        live = CommitLog(spark, str(tmp_path / "log")).state().live.get(path, [])
        return sorted((r.reason, r.value) for r in read_folders(spark, path, live, ["reason"]).collect())

    run.folder, run.rejected, run.sinks = tmp_path, rejected, sinks
    return run


def test_passing_error_heals_after_growing_pauses(ingest, monkeypatch):
    write, failures = ingest_module._write_commit, []

    def failing(rows, sink, name):
        if sink is ingest.sinks[1] and len(failures) < 3:
            failures.append(name)
            raise OSError("the store is away")
        write(rows, sink, name)

    monkeypatch.setattr(ingest_module, "_write_commit", failing)
    (ingest.folder / "in" / "a.txt").write_text("\n".join(_lines("a")) + "\n")
    assert ingest(attempts=5, pause=0.5) == [_lines("a")] * 2
    assert ingest.pauses == [0.5, 1.0, 2.0] and ingest.rejected() == []


def test_files_that_cannot_be_read_are_set_aside(ingest):
    good = []
    for name in "abcdefg":
        good += _lines(name)
        (ingest.folder / "in" / f"{name}.txt").write_text("\n".join(_lines(name)) + "\n")
    whole = gzip.compress("\n".join(_lines("z", 9) * 50).encode())
    (ingest.folder / "in" / "cut.txt.gz").write_bytes(whole[: len(whole) // 2])
    (ingest.folder / "in" / "no.txt.gz").write_bytes(b"no archive")
    (ingest.folder / "in" / "ok.txt.gz").write_bytes(gzip.compress(b"short\n" + "\n".join(_lines("k")).encode()))
    good += _lines("k")
    assert ingest(attempts=2) == [sorted(good)] * 2
    assert ingest.pauses == [1.0]
    rejected = ingest.rejected()
    assert [r for r in rejected if r[0] != UNREADABLE] == [("too_few_fields", "short")]
    aside = [value.split("\t") for reason, value in rejected if reason == UNREADABLE]
    assert [path.rsplit("/", 1)[1] for path, _ in aside] == ["cut.txt.gz", "no.txt.gz"] and all(error for _, error in aside)
    # The ingest goes on behind that batch.
    (ingest.folder / "in" / "later.txt").write_text("\n".join(_lines("later")) + "\n")
    assert ingest(attempts=2) == [sorted(good + _lines("later"))] * 2
    assert ingest.pauses == [] and ingest.rejected() == rejected


def test_error_that_stays_is_raised(ingest, monkeypatch):
    monkeypatch.setattr(ingest_module, "write_folder", lambda *a: (_ for _ in ()).throw(ValueError("a mistake")))
    (ingest.folder / "in" / "a.txt").write_text("\n".join(_lines("a")) + "\n")
    with pytest.raises((PySparkException, ValueError)):
        ingest(attempts=2)


def test_store_that_fails_blames_no_file():
    def place(files):
        raise OSError("disk full")

    with pytest.raises(OSError, match="disk full"):
        place_files(["a", "b"], place, lambda f: True)


@pytest.mark.parametrize("bad", [set(), {3}, {0, 7}, {1, 2, 3}, set(range(8))])
def test_halving_finds_each_bad_file(bad):
    tries = []

    def place(files):
        tries.append(files)
        if bad & set(files):
            raise OSError(f"bad: {sorted(bad & set(files))}")
        return tuple(files)

    placed, aside = place_files(list(range(8)), place, lambda f: f not in bad)
    assert sorted(x for part in placed for x in part) == sorted(set(range(8)) - bad)
    assert [f for f, _ in aside] == sorted(bad)
    assert len(tries) <= 1 + 2 * 3 * max(1, len(bad))
