"""Every registered query against its SQL twin in another engine, value by value."""

import datetime
import math

import duckdb
import pytest

from tillscope.registered import QUERIES, SQL_TWINS

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def twin_engine(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield con
    con.close()


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "nan")
    if isinstance(value, datetime.datetime):
        return (2, value.isoformat())
    return (2, repr(value))


def _sorted(rows):
    return sorted(rows, key=lambda row: [_key(v) for v in row])


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL_TWINS)


def _family(kind):
    kind = kind.upper()
    if kind.startswith("DECIMAL") or kind == "HUGEINT":
        return kind
    return {
        "LONG": "BIGINT", "VARCHAR": "STRING", "INT": "INTEGER", "TIMESTAMP_NTZ": "TIMESTAMP",
    }.get(kind, kind)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, sf_dir, twin_engine, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    got = [tuple(r) for r in result.select(*columns).collect()]
    relation = twin_engine.sql(SQL_TWINS[name])
    types = dict(zip(relation.columns, [_family(str(t)) for t in relation.types]))
    assert {c: _family(t) for c, t in result.dtypes} == types
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(row[i] for i in order) for row in relation.fetchall()]
    assert len(got) == len(expected)
    assert got, "a query without rows shows nothing"
    got, expected = _sorted(got), _sorted(expected)
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not wrong, wrong[:5]
