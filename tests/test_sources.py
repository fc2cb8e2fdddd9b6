import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillscope.sources import catalog, files, synthetic

LINES = [
    "lamp, 18.25, 2021-03-04 09:08:07.125, home, 81.2.69.142",
    '17" bezel,75.5,2021-03-05 23:00:01,"parts",89.160.20.112',
    "mug,3.1,2021-03-06 00:00:59.7,,175.16.199.9",
    "pen,0.5,2021-03-06 00:00:59.000,parts,1.2.3.4,more,fields",
]
BAD = [
    "product4,500.0",
    "product5,cheap,2021-03-06 00:00:59.000,parts,1.2.3.4",
    "product6,0.5,yesterday,parts,1.2.3.4",
    "product7,cheap,2021-03-06 00:00:59.000,parts,1.2.3.4,more",
]


def _write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_purchase_lines(spark, tmp_path):
    path = _write(tmp_path / "in.txt", LINES + BAD)
    rows = {r.name: r for r in files.read_purchases(spark, path).collect()}
    assert set(rows) == {"lamp", '17" bezel', "mug", "pen"}
    assert tuple(rows["lamp"]) == (
        "lamp", 18.25, datetime.datetime(2021, 3, 4, 9, 8, 7, 125000), "home",
        "81.2.69.142",
    )
    assert rows['17" bezel'].category == '"parts"'  # no quoting in purchase lines
    assert rows["mug"].category == ""
    assert rows["mug"].ts == datetime.datetime(2021, 3, 6, 0, 0, 59, 700000)
    assert rows["pen"].ip == "1.2.3.4"


def test_every_query_sees_the_same_lines(spark, tmp_path):
    """Column pruning must not let a line with a bad price back in."""
    path = _write(tmp_path / "in.txt", LINES + BAD)
    purchases = files.read_purchases(spark, path)
    assert purchases.count() == 4
    assert purchases.select("name").distinct().count() == 4
    assert purchases.groupBy("category").count().agg(F.sum("count")).first()[0] == 4


def test_rejected_lines_are_kept_on_request(spark, tmp_path):
    path = _write(tmp_path / "in.txt", LINES + BAD)
    rows = files.read_purchases(spark, path, keep_rejected=True)
    rejected = [r.rejected_line for r in rows.collect() if r.rejected_line is not None]
    assert sorted(rejected) == sorted(BAD)
    assert rows.count() == 8
    assert rows.where("rejected_line IS NOT NULL AND price IS NOT NULL").count() == 0


def test_strict_reading_fails(spark, tmp_path):
    good = _write(tmp_path / "good.txt", LINES)
    assert files.read_purchases(spark, good, strict=True).count() == 4
    for i, line in enumerate(BAD):
        bad = _write(tmp_path / f"bad{i}.txt", [LINES[0], line])
        with pytest.raises(PySparkException, match="not a purchase: product"):
            files.read_purchases(spark, bad, strict=True).select("name").collect()


def test_country_names(spark, tmp_path):
    path = _write(
        tmp_path / "names.csv",
        [
            "11,en,XA,Alpha,QA,Quay,0",
            '12,en,XB,Beta,QB,"Queen Bay",0',
            '13,en,XC,"Gamma Land",QC,"Cove, Cape, and Cay",0',
            "14,en,XB,Beta,,,0",
            '15,en,XC,"Gamma Land",QD,"a \\"b\\" \\\\c",1',
            "16,en,XD,Delta,QE,Ødal,1",
        ],
    )
    rows = {r.geoname_id: r for r in files.read_countries(spark, path).collect()}
    assert rows[11].country_name == "Quay" and rows[11].is_in_e is False
    assert rows[12].country_name == "Queen Bay"
    assert rows[13].country_name == "Cove, Cape, and Cay"
    assert rows[14].country_name is None and rows[14].country_iso_code is None
    assert rows[15].country_name == 'a "b" \\c' and rows[15].is_in_e is True
    assert rows[16].country_name == "Ødal"


def test_blocks(spark, tmp_path):
    path = _write(
        tmp_path / "blocks.csv", ["9.8.0.0/21,515,717,,1,0", "5.0.0.9/8,,3,4,1,1"]
    )
    rows = {r.network: r for r in files.read_blocks(spark, path).collect()}
    assert tuple(rows["9.8.0.0/21"])[1:] == (
        515, 717, None, True, False, 21, 151519232, 151521279,
    )
    assert rows["5.0.0.9/8"].geoname_id is None
    assert rows["5.0.0.9/8"].is_satellite_provider is True
    assert rows["5.0.0.9/8"].start_ip == 5 << 24


BAD_BLOCKS = ["6.0.0.0/8,abc,3,4,1,1", "7.0.0.0/8,1,2", "8.0.0.0/8,1,2,3,0,0,9", "9.0.0.0/8,1,2,3,x,0"]


def test_bad_lines_of_reference_tables(spark, tmp_path):
    good = ["5.0.0.0/8,,3,4,1,1", '"4.0.0.0/8",7,,,0,0', "no network,1,2,3,0,0"]
    path = _write(tmp_path / "blocks.csv", [*good, *BAD_BLOCKS])
    rows = files.read_blocks(spark, path).collect()
    assert sorted(r.network for r in rows) == ["4.0.0.0/8", "5.0.0.0/8", "no network"]
    kept = files.read_blocks(spark, path, keep_rejected=True)
    assert sorted(r.rejected_line for r in kept.collect() if r.rejected_line) == sorted(BAD_BLOCKS)
    # Whatever columns a query takes, the same lines are good.
    assert kept.select("rejected_line").where("rejected_line IS NOT NULL").count() == 4
    assert kept.where("rejected_line IS NULL").select("network").count() == 3
    assert kept.where("rejected_line IS NOT NULL AND (network IS NOT NULL OR geoname_id IS NOT NULL)").count() == 0
    assert files.read_blocks(spark, path).select("network").count() == 3
    assert files.read_blocks(spark, path).count() == 3
    with pytest.raises(PySparkException, match="7.0.0.0/8,1,2"):
        files.read_blocks(spark, _write(tmp_path / "short.csv", [*good, BAD_BLOCKS[1]]), strict=True).select("network").collect()
    assert files.read_blocks(spark, _write(tmp_path / "good.csv", good), strict=True).count() == 3
    names = _write(tmp_path / "names.csv", ['1,en,AS,Asia,QA,"Quay, Old",0', "x1,en,AS,Asia,QB,Quay,0", "2,en,AS"])
    kept = files.read_countries(spark, names, keep_rejected=True).collect()
    assert [r.country_name for r in kept if r.rejected_line is None] == ["Quay, Old"]
    assert sorted(r.rejected_line for r in kept if r.rejected_line) == ["2,en,AS", "x1,en,AS,Asia,QB,Quay,0"]


def _dated(tmp_path):
    for day in ("2010-10-14", "2010-10-15", "2010-11-02"):
        _write(
            tmp_path / f"dt={day}" / "part.txt",
            [f"p{i},1.5,{day} 00:00:0{i},c{i % 2},1.2.3.4" for i in range(5)],
        )
    return str(tmp_path)


def test_partitions_are_found_and_pruned(spark, tmp_path):
    purchases = files.read_purchases(spark, _dated(tmp_path), partitioned=True)
    assert dict(purchases.dtypes)["dt"] == "string"
    assert purchases.count() == 15
    late = purchases.where("dt > '2010-10-14'")
    assert late.count() == 10
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert len(late.inputFiles()) == 3  # files of the source, before pruning
    assert late.select(F.input_file_name()).distinct().count() == 2


def test_catalog_table_finds_new_days(spark, tmp_path):
    path = _dated(tmp_path)
    catalog.create_purchase_table(spark, "purchase_days", path)
    try:
        assert spark.table("purchase_days").count() == 15
        _write(tmp_path / "dt=2011-01-01" / "part.txt", ["p,2.5,2011-01-01 00:00:00,c,1.2.3.4"])
        catalog.refresh_partitions(spark, "purchase_days")
        rows = spark.sql("SELECT * FROM purchase_days WHERE dt = '2011-01-01'").collect()
        assert len(rows) == 1 and rows[0].price == 2.5
        assert spark.sql("SHOW PARTITIONS purchase_days_lines").count() == 4
    finally:
        spark.sql("DROP VIEW purchase_days")
        spark.sql("DROP TABLE purchase_days_lines")


def test_preview(spark):
    assert files.preview(spark.range(100), 3).count() == 3


def test_synthetic_purchases(spark):
    rows = synthetic.synthetic_purchases(spark, 20000, products=10, categories=7, seed=1).cache()
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("name").alias("names"),
        F.countDistinct("category").alias("categories"),
        F.avg("price").alias("mean"),
        F.stddev("price").alias("sd"),
        F.sum((F.round("price", 1) != F.col("price")).cast("int")).alias("off"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
        F.countDistinct("ip").alias("ips"),
    ).first()
    assert (stats.n, stats.names, stats.categories, stats.off) == (20000, 10, 7, 0)
    assert abs(stats.mean - 500) < 0.5 and abs(stats.sd - 10) < 0.5
    assert stats["first"] < datetime.datetime(2010, 10, 15) and stats["last"].day >= 22
    assert stats.ips > 19990
    inside = rows.where("ts BETWEEN '2010-10-15' AND '2010-10-22'").count()
    assert 0.80 < inside / 20000 < 0.95
    for name, groups in (("name", 10), ("category", 7)):
        counts = [r["count"] for r in rows.groupBy(name).count().collect()]
        assert min(counts) > 0.85 * 20000 / groups


def test_synthetic_rows_do_not_depend_on_partitions(spark):
    one = synthetic.add_purchases(spark.range(0, 500, 1, 1), seed=3)
    many = synthetic.add_purchases(spark.range(0, 500, 1, 7), seed=3)
    other = synthetic.add_purchases(spark.range(0, 500, 1, 1), seed=4)
    assert sorted(one.collect()) == sorted(many.collect())
    assert sorted(one.collect()) != sorted(other.collect())
