import os
import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillscope.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.Model(PATH).ready()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(7)
    letters = "abcdefghijklmnop aaeettiinn  .,'\n\t-_=!? 0123456789éß中文\U0001f600́‍  \x1c\x00"
    yield from ["", " ", "  a", "a  ", "it's we'll I'D", "x<|endoftext|> y<|endoftext|>", "\r\n\r\n x", "= " * 50]
    for size in (1, 5, 40, 400):
        for _ in range(60):
            yield "".join(rng.choice(letters) for _ in range(size))
    for unit in ("a", "ab", "the", "=", "-=", "thethe", "é", "中"):
        yield unit * 5000
    for _ in range(4):
        yield "".join(rng.choice("theinandoresat") for _ in range(6000))
        yield "".join(rng.choice("-=*#_.") for _ in range(6000))
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for _ in range(60):
        yield "".join(rng.choice(points) for _ in range(200))


def test_equals_the_library(model, library):
    for text in texts():
        ids = library.encode(text, add_special_tokens=False).ids
        packed = model.encode(text)
        assert packed == bpe.pack(ids), text[:80]
        assert model.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_the_decoder_accepts_any_ids(model, library):
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(30)]
        assert model.decode(bpe.pack(ids)) == library.decode(ids, skip_special_tokens=False)


def test_the_stream_holds_a_bounded_buffer(model):
    assert model.lookahead < 4096
    longest, merge = [], model.merge
    try:
        model.merge = lambda raw: longest.append(len(raw)) or merge(raw)
        assert b"".join(model.stream(b"theinandoresat" * 4000))
    finally:
        del model.merge
    assert max(longest) <= 2 * model.lookahead + 512


def test_rows(spark):
    rows = [(1, "It is so.", "x"), (None, "twice", "y"), (None, "twice", "y"), (2, None, None), (3, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, ids STRING")
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in back) == sorted((i or 0, t or "") for i, t, _ in rows)
    assert {r.n_tokens for r in back if r.doc_id in (2, 3)} == {0}
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0


def test_workers_need_no_copy_of_the_package(tmp_path):
    """The query in another folder, with workers whose path does not lead to the package."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from tillscope.llm import bpe
from tillscope.session import build_session
spark = build_session("elsewhere", "local[2]", spark__checkpoint__dir={str(tmp_path)!r})
docs = spark.createDataFrame([(i, f"text {{i}}") for i in range(50)], "doc_id BIGINT, text STRING")
def importable(batches):
    import importlib.util
    yield from batches
    if importlib.util.find_spec("tillscope"):
        raise AssertionError("the test shows nothing: the package is on the path of the workers")
docs.mapInArrow(importable, docs.schema).count()
rows = bpe.decode(bpe.encode(docs.repartition(8), {PATH!r}), {PATH!r}).collect()
assert sorted(r.decoded for r in rows) == sorted(f"text {{i}}" for i in range(50))
"""
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME")}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
