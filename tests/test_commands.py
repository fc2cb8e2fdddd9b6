"""The command line, from generated lines to written reports."""

import argparse

import pytest

from tillscope.__main__ import _sink, main, parse_arguments
from tillscope.plans import reports
from tillscope.sources import files
from tillscope.streaming import LineSink


def test_sink_arguments():
    assert _sink("dt=/a/b,20000") == LineSink("/a/b", "dt", 20000)
    assert _sink("flat=s3a://x/y") == LineSink("s3a://x/y", "flat", 0)
    for wrong in ("week=/a", "dt=", "/a/b"):
        with pytest.raises(argparse.ArgumentTypeError):
            _sink(wrong)


def test_jdbc_arguments():
    args = parse_arguments(
        ["report", "p", "c", "b", "o", "--jdbc-url", "jdbc:x", "--jdbc-property", "user=u=v"]
    )
    assert args.jdbc_url == "jdbc:x" and dict(args.jdbc_property) == {"user": "u=v"}


def test_generate_ingest_report(spark, tmp_path):
    main(["generate", f"{tmp_path}/lines", "3000", "10", "12"], spark)
    main(
        [
            "ingest", f"{tmp_path}/lines", "--purchases", "--rejects", f"{tmp_path}/rejects", "--sink", f"dt={tmp_path}/product,20000",
            "--sink", f"flat={tmp_path}/raw", "--checkpoint", f"{tmp_path}/checkpoint",
            "--rejects", f"{tmp_path}/rejects", "--date-index", "2",
        ],
        spark,
    )
    assert spark.read.text(f"{tmp_path}/raw").count() == 3000
    (tmp_path / "names.csv").write_text('1,en,EU,Europe,AA,"Aland, East",0\n2,en,EU,Europe,BB,B,1\n')
    (tmp_path / "blocks.csv").write_text(
        "".join(f"{o}.0.0.0/8,{1 + o % 3},1,,0,0\n" for o in range(200))
    )
    inputs = [f"{tmp_path}/product", f"{tmp_path}/names.csv", f"{tmp_path}/blocks.csv"]
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    main(["report", *inputs, f"{tmp_path}/out", "--partitioned"], spark)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held

    purchases = files.read_purchases(spark, inputs[0], partitioned=True)
    assert purchases.count() == 3000
    countries = files.read_countries(spark, inputs[1])
    blocks = files.read_blocks(spark, inputs[2])
    expected = {
        "top_categories": reports.top_categories(purchases),
        "top_products": reports.top_products(purchases),
        "top_products_per_category": reports.top_products_per_category(purchases),
        "top_ips": reports.top_ips(purchases),
        "top_ip_countries": reports.top_ip_countries(purchases, blocks, countries).select(
            "sump", "ip", "country_name"
        ),
        "top_countries": reports.top_countries(purchases, blocks, countries),
    }
    for name, frame in expected.items():
        written = spark.read.schema(frame.schema).option("escape", "\\").csv(f"{tmp_path}/out/{name}")
        rows = sorted(map(tuple, frame.collect()))
        assert rows and sorted(map(tuple, written.collect())) == rows, name


@pytest.mark.parametrize("match", ["all", "longest"])
def test_shared_aggregates_give_the_same_reports(spark, match):
    rows = [(f"p{i % 7}", 1.25 * i, f"c{i % 3}", f"10.{i % 2}.0.{i % 9}") for i in range(200)]
    # One address written in two ways.
    rows += [("p1", 5000.0, "c1", " 10.0.0.1"), ("p1", 4000.5, None, "10.0.0.1")]
    purchases = spark.createDataFrame(rows, "name STRING, price DOUBLE, category STRING, ip STRING")
    blocks = spark.createDataFrame(
        [("10.0.0.0/8", 1), ("10.1.0.0/16", 2)], "network STRING, geoname_id LONG"
    )
    countries = spark.createDataFrame([(1, "A"), (2, "B")], "geoname_id LONG, country_name STRING")
    shared = reports.all_reports(purchases, blocks, countries, match=match)
    try:
        alone = {
            "top_categories": reports.top_categories(purchases),
            "top_products": reports.top_products(purchases),
            "top_products_per_category": reports.top_products_per_category(purchases),
            "top_ips": reports.top_ips(purchases),
            "top_ip_countries": reports.top_ip_countries(
                purchases, blocks, countries, match=match
            ),
            "top_countries": reports.top_countries(purchases, blocks, countries, match=match),
        }
        assert set(alone) == set(shared.frames)
        for name, frame in alone.items():
            assert shared.frames[name].collect() == frame.collect(), name
    finally:
        shared.release()
