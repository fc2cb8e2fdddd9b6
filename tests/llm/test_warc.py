"""Archives written and read back, by ranges of any size, and archives that others wrote."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.errors.exceptions.base import PySparkException

from tillscope.llm import warc

SCHEMA = "page_id long, url string, html string, key long, digest string, original string, n int"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "d", "o", 2) for r in rows], SCHEMA)


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def plain(rows):
    best = {}
    for page_id, _, html in rows:
        best.setdefault(html or "", []).append(-1 if page_id is None else page_id)
    out, done = [], set()
    for page_id, _, html in sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True):
        payload = (html or "").encode()
        first = payload not in done
        done.add(payload)
        refers = None if first else max(best[html or ""])
        out.append((page_id, len(payload), sha(payload), "response" if first else "revisit", None if refers == -1 else refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (3, None, ""), (4, "http://a b/\r\nX: y", None),
    (5, "http://a/5", "<p>é 漢 \U0001f600</p>"), (6, "http://a/6", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "http://n", "<p>one</p>"),
    (7, "http://a/7", "x" * 5_000_000 + "y"), (2, "http://a/2", "<p>one</p>"), (8, "http://a/8", "<b>\x00\x1f</b>"), (None, None, None),
]


def test_round_trip_equals_plain_version(spark):
    got = warc.round_trip(pages_of(spark, ROWS)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    assert sorted(map(tuple, got.collect()), key=repr) == plain(ROWS)


def test_empty_table(spark):
    assert warc.round_trip(pages_of(spark, [])).collect() == []


@pytest.mark.parametrize("size", [97, 1_000, 1 << 20])
def test_every_range_owns_the_records_that_start_in_it(spark, tmp_path, size):
    rng = random.Random(size)
    html = ["".join(chr(rng.randrange(32, 0x2FF)) for _ in range(rng.randrange(2_000))) for _ in range(60)]
    rows = [(i, f"http://h/{i}", html[i % 45]) for i in range(60)]
    path = str(tmp_path / "a")
    warc.write(pages_of(spark, rows).coalesce(2), path)
    got = warc.read(spark, path, size=size).collect()
    assert sorted(r.page_id for r in got) == list(range(60))
    assert {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response"} == {
        i: html[i % 45] for i in range(60) if i >= 15
    }
    assert {r.page_id: r.refers_to for r in got if r.record_type == "revisit"} == {i: i + 45 for i in range(15)}
    assert all(r.url == f"http://h/{r.page_id}" for r in got)


def test_a_third_of_the_pages_are_equal(spark):
    rows = [(i, f"u{i}", "same" if i % 3 == 0 else f"own {i}") for i in range(900)]
    got = warc.round_trip(pages_of(spark, rows)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_short_payloads_are_written_whole(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write(pages_of(spark, [(1, "u", "ab"), (2, "v", "ab"), (3, "w", "abcd"), (4, "x", "abcd")]), path, least=3)
    assert {r.page_id: r.record_type for r in warc.read(spark, path).collect()} == {
        1: "response", 2: "response", 3: "revisit", 4: "response"
    }


def test_false_magic_and_other_members_are_passed_over(spark, tmp_path):
    """Members of other content, and a magic inside of stored data, are no records."""
    head = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://f\r\n"
    block = b"HTTP/1.0 200 OK\r\n\r\n" + b"\x1f\x8b\x08 no member \x1f\x8b\x08\x00\x00\x00"
    record = head + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    data = gzip.compress(b"not an archive") + gzip.compress(record, compresslevel=0) + b"\0\0" + gzip.compress(record)
    (tmp_path / "foreign.warc.gz").write_bytes(data)
    for size in (16, 64, 1 << 20):
        got = warc.read(spark, str(tmp_path), size=size).collect()
        assert [(r.url, r.page_id, r.payload_digest) for r in got] == [("http://f", None, sha(block[19:]))] * 2


@pytest.mark.parametrize("broken", ["cut", "flipped", "digest"])
def test_damaged_records_are_errors(spark, tmp_path, broken):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + random.Random(1).randbytes(5_000)
    digest = b"A" * 32 if broken == "digest" else sha(block[19:]).encode()
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n" % (digest, len(block))
    data = bytearray(gzip.compress(record + block + b"\r\n\r\n"))
    if broken == "cut":
        data = data[:-900]
    if broken == "flipped":
        data[-6] ^= 255
    (tmp_path / "a.warc.gz").write_bytes(bytes(data))
    with pytest.raises(PySparkException, match="Damaged"):
        warc.read(spark, str(tmp_path)).collect()


def test_a_member_of_more_than_16_mib_is_padded():
    """Its last byte is not zero, so the writer's byte comes on top, and both readers pass it."""
    row = {"page_id": 1, "key": 0, "url": None, "payload": b"z" * (17 << 20), "digest": sha(b"z" * (17 << 20)), "original": None}
    packed = warc.record(row, "2020-01-01T00:00:00Z")
    assert packed[-1] != 0
    assert len(gzip.decompress(packed + b"\0" + packed + b"\0")) > 2 * (17 << 20)
    data = packed + b"\0" + packed + b"\0"
    got = list(warc.members(lambda at, n: data[at : at + n], 0, len(data)))
    assert [warc.parsed(x)["payload_bytes"] for x in got] == [17 << 20] * 2
