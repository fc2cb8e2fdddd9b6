"""Byte-level BPE as a streaming transducer with bounded lookahead.

A prefix of a word is settled once enough of what follows it has been read: a merge further to
the right can reach left only through a chain of merges, each of lower priority than the one
before and each taking in the token on its left. `sufficient_lookahead` follows all such chains
of a merge list and gives the number of bytes after which no later byte changes a token. The
transducer keeps a buffer of that many bytes and a little, whatever the length of the text.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope.llm.common import only

#: Fixed value: the published pattern that cuts a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose tokens are remembered by a worker, and the most bytes of such a word.
REMEMBERED, SHORT = 500_000, 64
#: Words or tokens that are handled at a time; characters of a text cut into words at once.
STEP, LONG = 1 << 15, 1 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable bytes of Latin-1
    stand for themselves, the others for the letters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def sufficient_lookahead(rules: list[tuple[bytes, bytes]]) -> int:
    """Bytes after the end of a prefix that decide all of its tokens but those they touch.

    reach[t]: how far left of the end of what has been read the token t can begin while what
    comes later still decides whether t is there. A rule (u, v) whose v is undecided leaves u
    and uv undecided, |u| further left; if its u is undecided, so is uv. Rules are taken by
    priority, since a merge is never undone by one of lower priority.
    """
    reach: dict[bytes, int] = {}
    most = 1
    for u, v in rules:
        far_v = reach.get(v, len(v))
        merged = u + v
        far = max(far_v + len(u), reach.get(u, len(u)), len(merged))
        reach[u] = max(reach.get(u, len(u)), far_v + len(u))
        reach[merged] = max(reach.get(merged, 0), far)
        most = max(most, far)
    return most


class Remembered(dict):
    """Tokens by word, computed when first asked for; emptied when it has grown too large."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        if len(raw) > SHORT:
            return b"".join(self.model.stream(raw))
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids = pack(self.model.merge(raw))
        return ids


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


class Model:
    """A vocabulary with its merge list, from a file in the JSON form of public tokenizers."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        ids = {raw(token): i for token, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        rules = [(raw(u), raw(v)) for u, v in merges]
        self.bytes_of = {i: token for token, i in ids.items()}
        self.first = [ids[bytes([b])] for b in range(256)]
        self.rank = {ids[u] << 32 | ids[v]: rank for rank, (u, v) in enumerate(rules)}
        self.made = [ids[u + v] for u, v in rules]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: text.encode() for text, i in self.special.items()}
        self.lookahead = sufficient_lookahead(rules)

    @classmethod
    def of(cls, state: dict) -> Model:
        """A model over this state itself, so what a task remembers serves the next one."""
        model = cls.__new__(cls)
        model.__dict__ = state
        return model

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "find", "cut")}

    def ready(self) -> Model:
        """With the parts that a worker makes for itself."""
        if "known" not in self.__dict__:
            self.known = Remembered(self)
            self.find = regex.compile(WORDS)
            longest_first = sorted(self.special, key=len, reverse=True)
            self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        return self

    def merge(self, raw: bytes) -> list[int]:
        """Tokens of a short piece: the pair of highest priority, leftmost first, until none is left."""
        first, rank, made, none = self.first, self.rank, self.made, len(self.made)
        ids = [first[b] for b in raw]
        ranks = [rank.get(u << 32 | v, none) for u, v in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = made[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] << 32 | ids[i], none)
        return ids

    def stream(self, raw: bytes) -> Iterator[bytes]:
        """Tokens of a word of any length, packed, each emitted once it is settled."""
        step = max(self.lookahead, 256)
        at, end = 0, 0
        held = b""
        while end < len(raw):
            more = raw[end : end + step]
            end += len(more)
            held += more
            ids = self.merge(held)
            if end == len(raw):
                yield pack(ids)
                return
            settled, n = len(held) - self.lookahead, 0
            for n, i in enumerate(ids):
                at += len(self.bytes_of[i])
                if at > settled:
                    at -= len(self.bytes_of[i])
                    break
            yield pack(ids[:n])
            held, at = held[at:], 0

    def encode(self, text: str) -> bytes:
        """Token ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.cut.split(text) if self.cut else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(pack([self.special[part]]))
                continue
            words = iter(self.find.findall(part)) if len(part) <= LONG else (m.group() for m in self.find.finditer(part))
            while piece := b"".join(map(self.known.__getitem__, islice(words, STEP))):
                out.append(piece)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of packed token ids; ids of no token add nothing, stray bytes become U+FFFD."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        numbers, get = np.frombuffer(ids, "<u4"), self.bytes_of.get
        out = []
        for at in range(0, len(numbers), STEP):
            raw = b"".join([get(i, b"") for i in numbers[at : at + STEP].tolist()])
            out.append(state.decode(raw))
        out.append(state.decode(b"", True))
        return "".join(out)


def _per_row(rows: DataFrame, model: Model, take: str, give: str, kind: T.DataType, work) -> DataFrame:
    """Every row with one more column, computed from another in batches of Arrow."""
    # Bounded: a vocabulary of some MB, in plain dicts and lists. A broadcast pickles classes by
    # name, and executors need not have this package.
    shared = rows.sparkSession.sparkContext.broadcast(model.__getstate__())
    drawn = T.StructType([*rows.schema, T.StructField(give, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()
    place, names = rows.columns.index(take), [*rows.columns, give]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of(shared.value).ready()
        for batch in batches:
            made = pa.array([work(own, v.as_py()) for v in batch.column(place)], arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=names)

    return rows.mapInArrow(run, drawn)


def encode(docs: DataFrame, path: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, ids BINARY, n_tokens) of every row: packed little-endian unsigned 32-bit ids.

    NULL is encoded as the empty text, which has no tokens. Texts of special tokens become
    these tokens. Repeated rows stay, an empty table gives an empty result.
    """
    rows = only(docs, doc_id=id_col, text=text_col)
    made = _per_row(rows, Model(path), "text", "ids", T.BinaryType(), lambda m, t: m.encode(t or ""))
    return made.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """The rows of `encode` with their text again, in a column `decoded`."""
    return _per_row(tokens, Model(path), "ids", "decoded", T.StringType(), lambda m, t: m.decode(t or b""))
