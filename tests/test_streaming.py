import datetime

import pytest
from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import functions as F

from tillscope.sources import files
from tillscope.streaming import (
    LineSink,
    classify_lines,
    ingest_lines,
    read_line_stream,
    read_sink,
)
from tillscope.streaming import ingest as ingest_module


def _line(i, day=15):
    return f"product{i}, 50{i % 10}.5, 2010-10-{day} 17:03:21.250, category{i % 3}, 10.0.0.{i}"


@pytest.fixture()
def folders(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def _drop(folders, name, lines):
    (folders / "in" / name).write_text("\n".join(lines) + "\n")


def _run(spark, folders, sinks, max_files=1, **options):
    query = ingest_lines(
        read_line_stream(spark, str(folders / "in"), max_files_per_trigger=max_files),
        sinks,
        checkpoint=str(folders / "checkpoint"),
        **{"date_index": 2, "rejects": str(folders / "rejects"), **options},
    )
    query.awaitTermination()
    return query


def _values(df):
    return sorted(r.value for r in df.collect())


def test_lines_go_to_their_day_in_bounded_batches(spark, folders):
    sink = LineSink(str(folders / "product"), "dt")
    lines = [_line(i, 15 + i % 3) for i in range(30)]
    for part in range(3):
        _drop(folders, f"{part}.txt", lines[part * 10 : part * 10 + 10])
    query = _run(spark, folders, [sink])
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    got = read_sink(spark, sink)
    assert _values(got) == sorted(lines)
    assert {(r.value, r.dt) for r in got.collect()} == {
        (line, f"2010-10-{15 + i % 3}") for i, line in enumerate(lines)
    }
    # The tree is the one the batch reader takes.
    purchases = files.read_purchases(spark, sink.path, partitioned=True)
    assert purchases.count() == 30
    assert purchases.where("dt = '2010-10-16'").select("dt").distinct().count() == 1


def test_restart_takes_new_files_only(spark, folders):
    sink = LineSink(str(folders / "product"), "dt")
    _drop(folders, "a.txt", [_line(1), _line(2)])
    _run(spark, folders, [sink])
    _run(spark, folders, [sink])
    _drop(folders, "b.txt", [_line(3)])
    _run(spark, folders, [sink])
    assert _values(read_sink(spark, sink)) == sorted([_line(1), _line(2), _line(3)])


def test_batch_that_fails_between_sinks_leaves_no_line_twice(spark, folders, monkeypatch):
    first, second = (LineSink(str(folders / n), "dt") for n in ("first", "second"))
    _drop(folders, "a.txt", [_line(i) for i in range(5)])
    write = ingest_module._write_batch

    def failing(rows, sink, batch_id):
        if sink is second:
            raise OSError("disk full")
        write(rows, sink, batch_id)

    monkeypatch.setattr(ingest_module, "_write_batch", failing)
    with pytest.raises(PySparkException):
        _run(spark, folders, [first, second])
    assert read_sink(spark, first).count() == 5
    monkeypatch.undo()
    _run(spark, folders, [first, second])
    for sink in (first, second):
        assert _values(read_sink(spark, sink)) == sorted(_line(i) for i in range(5))


def test_fan_out_and_file_sizes(spark, folders):
    sinks = [
        LineSink(str(folders / "product"), "dt", 20_000),
        LineSink(str(folders / "event"), "ymd", 4),
        LineSink(str(folders / "raw")),
    ]
    lines = [_line(i) for i in range(10)]
    _drop(folders, "a.txt", lines)
    _run(spark, folders, sinks)
    for sink in sinks:
        assert _values(read_sink(spark, sink)) == sorted(lines)
    day = folders / "event" / "year=2010" / "month=10" / "day=15"
    sizes = [len(p.read_text().splitlines()) for p in day.glob("batch_id=0/part-*")]
    assert sorted(sizes) == [2, 4, 4]


def test_bad_lines_do_not_block_the_file(spark, folders):
    sink = LineSink(str(folders / "product"), "dt")
    rejects = str(folders / "rejects")
    _drop(
        folders,
        "a.txt",
        [_line(1), "a,b", "a,,", "", "a,b,not a time,d,e", "a,b,2010-10-15,d,e", _line(2)],
    )
    _run(spark, folders, [sink], rejects=rejects)
    assert _values(read_sink(spark, sink)) == sorted([_line(1), _line(2)])
    rows = {(r.value, r.reason) for r in spark.read.text(rejects).collect()}
    assert rows == {
        ("a,b", "too_few_fields"),
        ("a,,", "too_few_fields"),
        ("", "too_few_fields"),
        ("a,b,not a time,d,e", "bad_time"),
        ("a,b,2010-10-15,d,e", "bad_time"),
    }


def test_without_a_date_field_the_time_is_that_of_the_batch(spark, folders):
    sink = LineSink(str(folders / "raw"), "dt")
    _drop(folders, "a.txt", ["9.8.0.0/21,515,717,,1,0"])
    before = datetime.date.today() - datetime.timedelta(days=1)
    _run(spark, folders, [sink], date_index=-1)
    row = read_sink(spark, sink).first()
    assert row.value.startswith("9.8.0.0/21")
    assert row.dt >= before.isoformat()


def test_classification_in_a_batch(spark):
    lines = spark.createDataFrame([("a,b,2010-10-15 00:00:00",), ("a",)], "value STRING")
    rows = classify_lines(lines, date_index=2).orderBy(F.length("value")).collect()
    assert [r.reason for r in rows] == ["too_few_fields", None]
    assert rows[1].event_ts == datetime.datetime(2010, 10, 15)


def test_polling_query_picks_up_files(spark, folders):
    sink = LineSink(str(folders / "product"), "dt")
    _drop(folders, "a.txt", [_line(1)])
    query = ingest_lines(
        read_line_stream(spark, str(folders / "in"), max_bytes_per_trigger=1_000_000),
        [sink],
        checkpoint=str(folders / "checkpoint"),
        rejects=str(folders / "rejects"),
        date_index=2,
        interval="100 milliseconds",
    )
    try:
        query.processAllAvailable()
        _drop(folders, "b.txt", [_line(2, 16)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert _values(read_sink(spark, sink)) == sorted([_line(1), _line(2, 16)])
