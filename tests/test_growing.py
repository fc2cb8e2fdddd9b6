"""Files that grow: each line once, half-written ones wait, cut and replaced files are errors."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors.exceptions.base import PySparkException

from tillscope.streaming import LineSink, follow_lines, growing, ingest_lines, read_sink


@pytest.fixture()
def ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(path="in", range_bytes=64):
        sink = LineSink(str(tmp_path / "out"))
        ingest_lines(
            follow_lines(spark, str(tmp_path / path), range_bytes=range_bytes),
            [sink],
            checkpoint=str(tmp_path / "checkpoint"),
            rejects=str(tmp_path / "rejects"),
            min_fields=1,
        ).awaitTermination()
        return sorted(r.value for r in read_sink(spark, sink).collect())

    run.folder = tmp_path
    return run


def _append(path, data):
    with path.open("ab") as file:
        file.write(data)


def test_appended_lines_arrive_once_and_a_half_line_waits(ingest):
    log = ingest.folder / "in" / "a.log"
    _append(log, b"first\nsecond\r\nthi")
    assert ingest("in/a.log") == ["first", "second"]
    assert ingest("in/a.log") == ["first", "second"]
    _append(log, b"rd\n\xff bad\nfour")
    assert ingest("in/a.log") == sorted(["first", "second", "third", "� bad"])
    _append(log, b"\n")
    assert ingest("in/a.log") == sorted(["first", "second", "third", "� bad", "four"])


def test_many_files_and_ranges(ingest):
    rng = random.Random(5)
    written = []
    for step in range(3):
        for name in [f"{i}.log" for i in range(2 + step)]:
            for i in range(200):
                written.append(f"{step} {name} {i} " + "x" * rng.choice([1, 30, 300]))
                _append(ingest.folder / "in" / name, written[-1].encode() + b"\n")
        _append(ingest.folder / "in" / "_hidden", b"not read\n")
        assert ingest(range_bytes=997) == sorted(written)


@pytest.mark.parametrize("harm", ["cut", "replaced", "removed"])
def test_lost_bytes_are_an_error(ingest, harm):
    log = ingest.folder / "in" / "a.log"
    _append(log, b"one line\nanother\n")
    ingest()
    if harm == "cut":
        log.write_bytes(b"one line\n")
    elif harm == "replaced":
        log.write_bytes(b"quite another file\nthat is longer\n")
    else:
        log.rename(ingest.folder / "gone.log")
        _append(ingest.folder / "in" / "b.log", b"x\n")
    with pytest.raises(PySparkException, match=harm):
        ingest()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 12), max_size=30), st.integers(1, 20), st.integers(0, 3))
def test_every_line_belongs_to_one_range(lengths, size, before):
    """For any lengths of lines, size of ranges and beginning of the batch."""
    lines = [b"x" * n for n in lengths]
    data = b"old\n" * before + b"".join(line + b"\n" for line in lines)
    start, end = 4 * before, len(data)
    got = []
    for low in range(start, end, size):
        got += growing.owned_lines(lambda at, n: data[at : at + n], start, low, min(low + size, end), end)
    assert got == lines
    assert growing.last_break(lambda at, n: data[at : at + n] + b"", end) == end
