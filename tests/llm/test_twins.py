"""Registered queries against their SQL twins in another engine, value by value."""

import math

import duckdb
import pytest

from tillscope.llm.queries import QUERIES
from tillscope.llm.twins import SQL_TWINS

TABLES = "documents pages benchmark labels".split()


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", list(SQL_TWINS))
def test_query_equals_twin(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    relation = con.sql(SQL_TWINS[name])
    assert sorted(relation.columns) == columns
    got = sorted(map(tuple, result.select(*columns).collect()), key=repr)
    expected = sorted(map(tuple, relation.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)
    assert len(got) == len(expected)
    wrong = [(g, e) for g, e in zip(got, expected) if not all(map(same, g, e))]
    assert not wrong, wrong[:3]


def test_license_twin_finds_wrapped_notices(spark, tmp_path):
    """Every template, wrapped at several widths and with other words around and inside."""
    import textwrap

    from tillscope.llm.licenses import TEMPLATES

    texts = [textwrap.fill(text, width) for _, text in TEMPLATES for width in (20, 40, 60)]
    texts += [f"calm words\n{t}\nand more of them" for t in texts] + [t.replace(" of ", " of\nsome ") for t in texts]
    texts += [t[: len(t) // 2] for t in texts[:20]] + [None, "", "mit\nlicense"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    result = QUERIES["op2_license_scan"](spark, str(tmp_path))
    columns = sorted(result.columns)
    got = sorted(map(tuple, result.select(*columns).collect()), key=repr)
    twin = con.sql(SQL_TWINS["op2_license_scan"]).select(*columns).fetchall()
    expected = sorted(map(tuple, twin), key=repr)
    assert len(got) == len(expected) == len(texts)
    assert not [(g, e) for g, e in zip(got, expected) if not all(map(same, g, e))]
    assert sum(1 for r in got if r[columns.index("labels")]) >= 3 * len(TEMPLATES)
