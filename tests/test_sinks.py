from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillscope import session
from tillscope.sinks import append_lines, write_all, write_csv, write_jdbc
from tillscope.sinks.files import flags_as_ints, layout_columns, lines_of
from tillscope.sources import files

AWKWARD = ["plain", "a,b", 'say "x"', "back\\slash", "end\\", '\\"', None, " padded ", "Ünïcode"]


def test_csv_is_replaced_and_read_back(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame(
        [(i, "en", "EU", t, t, t, i % 2 == 0) for i, t in enumerate(AWKWARD)],
        "geoname_id LONG, locale_code STRING, continent_code STRING, continent_name STRING,"
        "country_iso_code STRING, country_name STRING, is_in_e BOOLEAN",
    )
    write_csv(spark.range(3), path)
    write_csv(flags_as_ints(rows.withColumn("extra", F.lit(1))), path, rows.columns)
    back = files.read_countries(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_files_roll_by_lines(spark, tmp_path):
    lines = spark.range(0, 95, 1, 1).select(F.col("id").cast("string").alias("value"))
    append_lines(lines, str(tmp_path / "out"), max_records_per_file=10)
    sizes = sorted(
        len(p.read_text().splitlines()) for p in (tmp_path / "out").glob("part-*")
    )
    assert sizes == [5] + [10] * 9


def _dated(spark):
    return spark.range(100).select(
        F.col("id").cast("string").alias("value"),
        F.expr("TIMESTAMP_NTZ'2010-12-30 23:00:00' + make_dt_interval(CAST(id % 4 AS INT))").alias(
            "event_ts"
        ),
    )


@pytest.mark.parametrize("gather", [False, True])
def test_append_by_date(spark, tmp_path, gather):
    path = tmp_path / "out"
    for _ in range(2):
        append_lines(_dated(spark), str(path), "dt", gather=gather)
    days = sorted(p.name for p in path.glob("dt=*"))
    assert days == ["dt=2010-12-30", "dt=2010-12-31", "dt=2011-01-01", "dt=2011-01-02"]
    assert spark.read.text(str(path)).count() == 200
    assert spark.read.text(str(path)).where("dt = '2011-01-01'").count() == 50


def test_append_by_year_month_day(spark, tmp_path):
    path = tmp_path / "out"
    append_lines(_dated(spark), str(path), "ymd", gather=True)
    assert (path / "year=2011" / "month=01" / "day=02").is_dir()


def test_unknown_layout():
    with pytest.raises(ValueError, match="layout"):
        layout_columns("weekly")


def test_lines_of(spark):
    rows = spark.createDataFrame([("a", None, 1.5)], "x STRING, y STRING, z DOUBLE")
    assert lines_of(rows, "x", "y", "z").first().value == "a,,1.5"


def test_write_all_computes_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    rows = spark.range(0, 50, 1, 2).mapInPandas(counted, "id LONG")
    write_all(
        rows,
        lambda df: write_csv(df, str(tmp_path / "a")),
        lambda df: write_csv(df, str(tmp_path / "b")),
        lambda df: df.count(),
    )
    assert runs.value == 50
    assert not rows.is_cached
    for name in ("a", "b"):
        assert spark.read.csv(str(tmp_path / name)).count() == 50


class _Writer:
    def __init__(self, calls):
        self.calls = calls

    def option(self, key, value):
        self.calls[key] = value
        return self

    def jdbc(self, url, table, mode, properties):
        self.calls.update(url=url, table=table, mode=mode, properties=properties)


def test_jdbc_options():
    """What the writer is told; no database is started here."""
    calls = {}
    frame = type("Frame", (), {"write": _Writer(calls)})()
    write_jdbc(frame, "jdbc:x://host/db", "table51", properties={"user": "u"}, connections=3)
    assert calls == {
        "numPartitions": 3, "batchsize": 10_000, "truncate": False, "url": "jdbc:x://host/db",
        "table": "table51", "mode": "overwrite", "properties": {"user": "u"},
    }


class _Conf:
    def __init__(self, **values):
        self.conf = self
        self.values = {k.replace("__", "."): v for k, v in values.items()}

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert one.startswith(f"{shared}/") and one != two
    cluster = _Conf(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert session.scratch_path(cluster, "x").startswith("hdfs:///shared/tillscope/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(_Conf(spark__master="yarn"), "x")
    local = session.scratch_path(_Conf(spark__master="local[2]"), "x")
    assert Path(local).parent.parent.is_dir()
