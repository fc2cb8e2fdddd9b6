"""WARC archives: pages as records of gzip members, and a splittable reader of such archives.

Written by Spark's own text writer: a record is a row of raw bytes, and what the writer puts
after each row is the zero byte that ends a gzip member of less than 16 MiB anyway; behind a
larger one it is padding, which readers of gzip pass over. So archives go to any store that Spark
writes to, and its commit protocol takes care of tasks that are run again.

Read by byte ranges: a task looks for the magic of a gzip member in its range, takes a place for
a record only if it decodes to a WARC header, reads on to the end of that record, beyond the
range if need be, and so owns exactly the records that start in it. False magics inside of
compressed data decode to nothing. Not told apart from a record: one that lies uncompressed in
the payload of another which starts in an earlier range; text payloads cannot hold one, as the
magic is not UTF-8.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.llm.common import joined_to_groups, only, saved, whole_text
from tillscope.session import scratch_path

#: Fixed values of the two formats: the magic with the only method there is, and the names.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of an archive that one task scans, of a read, and of the records handed on at once.
RANGE, STEP, BATCH = 8 << 20, 1 << 16, 4 << 20
#: Payloads of fewer bytes are always written whole.
LEAST = 0

ROW = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, key: int) -> str:
    """The name of a record: that of its page, and the number of its row."""
    return f"<urn:page:{'' if page_id is None else page_id}:{key}>"


def page_of(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+):\d+>", name or "")
    return int(found[1]) if found else None


def as_uri(url: str) -> str:
    """Blanks and control characters, which would break a header, as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(row: dict, date: str) -> bytes:
    """A page as a gzip member: a response, or a revisit that has the headers of HTTP only."""
    payload = row["payload"]
    revisit = row["original"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(row["page_id"], row["key"])),
        ("WARC-Date", date),
        ("WARC-Target-URI", as_uri(row["url"]) if row["url"] is not None else None),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(row["original"]["page_id"], row["original"]["key"]) if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = pa.array([payload_digest(p.as_py()) for p in batch["payload"]], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, "digest"])


def planned(pages: DataFrame, least: int = LEAST, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(key, page_id, url, payload, digest, original) of every page.

    Of pages with equal payloads of at least `least` bytes, that with the largest page_id is the
    original; the others have its page_id and key in `original`, which is NULL otherwise. Of
    equal pages with equal ids the last row is, and a NULL id comes before every other.
    """
    rows = only(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(whole_text("html"), "UTF-8").alias("payload"),
    )
    # Written, as the number of a row must be the same when its page is read again.
    rows = saved(rows.mapInArrow(_digests, "key long, page_id long, url string, payload binary, digest string"), "pages")
    long_enough = F.octet_length("payload") >= least
    groups = rows.filter(long_enough).groupBy("digest").agg(
        F.max(F.struct("page_id", "key")).alias("original"), F.count(F.lit(1)).alias("n")
    )
    groups = saved(groups.filter("n > 1"), "repeated")
    small = ["digest", "key"]
    revisits = joined_to_groups(rows.filter(long_enough).select(*small), groups, "digest", rows.count())
    revisits = saved(revisits.filter("key <> original.key").select("key", "original"), "revisits")
    return rows.join(revisits, "key", "left")


def write(pages: DataFrame, path: str, *, least: int = LEAST, date: datetime | None = None) -> None:
    """Every page as a record in archives below `path`; see `planned`."""
    when = (date or datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                packed = [record(row, when) for row in batch.slice(at, 64).to_pylist()]
                # The writer puts the last byte of a member back, which is zero below 16 MiB.
                packed = [p[:-1] if p.endswith(b"\0") else p for p in packed]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["member"])

    rows = planned(pages, least).mapInArrow(members, "member binary")
    rows.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


class Damaged(ValueError):
    """A record that begins as one and cannot be read to its end."""


Read = Callable[[int, int], bytes]


def begins_record(read: Read, at: int) -> bool:
    """Whether the bytes at `at` decode to the beginning of a record."""
    unpack, out, place = zlib.decompressobj(31), b"", at
    while len(out) < len(b"WARC/") and (chunk := read(place, 512)):
        try:
            out += unpack.decompress(chunk, len(b"WARC/") - len(out))
        except zlib.error:
            return False
        if unpack.eof or not b"WARC/".startswith(out):
            break
        place += len(chunk)
    return out == b"WARC/"


def member(read: Read, at: int) -> tuple[int, bytes] | None:
    """Where the member at `at` ends, and what it holds; None if it is no WARC record."""
    if not begins_record(read, at):
        return None
    unpack, out, place = zlib.decompressobj(31), bytearray(), at
    while not unpack.eof:
        chunk = read(place, STEP)
        if not chunk:
            raise Damaged(f"record at byte {at} is cut off")
        try:
            out += unpack.decompress(chunk)
        except zlib.error as error:
            raise Damaged(f"record at byte {at}: {error}") from error
        place += len(chunk)
    return place - len(unpack.unused_data), bytes(out)


def members(read: Read, start: int, end: int) -> Iterator[bytes]:
    """The records that start in [start, end)."""
    at = start
    while at < end:
        block = read(at, min(STEP, end - at + len(MAGIC) - 1))
        found = block.find(MAGIC)
        if found < 0:
            at += max(1, len(block) - len(MAGIC) + 1)
            continue
        at += found
        got = member(read, at)
        if got is None:
            at += 1
        else:
            at, content = got
            yield content


def fields_of(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parsed(content: bytes) -> dict:
    """The columns of a record. The digest of a payload that is there is computed again."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = fields_of(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields.get("warc-type")
    size = int(fields_of(http).get("content-length", len(payload)))
    if kind == "response":
        if len(payload) != size or (stated and payload_digest(payload) != stated):
            raise Damaged(f"the payload of {fields.get('warc-record-id')} is not what its headers say")
        stated = stated or payload_digest(payload)
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": stated,
        "payload": payload if kind == "response" else None,
    }


def reader_of(path: str, buffer: int = 1 << 20) -> tuple[Read, Callable[[], None]]:
    """Reads of (place, bytes) in a file of a local or remote store, over a buffer; its close."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    store, inner = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    file = store.open_input_file(inner)
    size, held, base = file.size(), b"", 0

    def read(at: int, n: int) -> bytes:
        nonlocal held, base
        n = max(0, min(n, size - at))
        if not base <= at <= at + n <= base + len(held):
            held, base = file.read_at(max(n, min(buffer, size - at)), at), at
        return held[at - base : at - base + n]

    return read, file.close


def byte_ranges(spark, path: str, size: int = RANGE) -> DataFrame:
    """(path, start, end) of ranges that cover every archive below `path`, each in a task of its
    own as far as possible. Only names and lengths of the files are read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").filter("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(size))).alias("start"))
    n = files.agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 1
    ranges = ranges.select("path", "start", F.least(F.col("start") + size, F.col("length")).alias("end"))
    return ranges.repartition(int(n))


def read(spark, path: str, *, payload: bool = True, size: int = RANGE) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of every
    record of the archives below `path`.

    `refers_to` is the page_id of the response that a revisit stands for; bytes and digest are
    those of the whole payload, which itself is NULL for a revisit. A record that begins and
    cannot be read, or whose payload is not the stated one, is an error. `payload=False` leaves
    the payload out, though it is still checked.
    """
    names = [c.split()[0] for c in ROW.split(", ")]
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names += ["payload"] * payload

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in names]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                get, close = reader_of(r["path"])
                held, held_bytes = [], 0
                for content in members(get, r["start"], r["end"]):
                    held.append(parsed(content))
                    held_bytes += len(held[-1]["payload"] or b"") * payload + 500
                    if held_bytes > BATCH:
                        yield batch_of(held)
                        held, held_bytes = [], 0
                close()
                if held:
                    yield batch_of(held)

    return byte_ranges(spark, path, size).mapInArrow(scan, ROW + ", payload binary" * payload)


def round_trip(pages: DataFrame) -> DataFrame:
    """The records of the pages after they have been written to archives in the shared folder.

    NULL texts are empty payloads, NULL urls have no header. Repeated rows are records of their
    own. An empty table gives archives without records.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path, payload=False)
