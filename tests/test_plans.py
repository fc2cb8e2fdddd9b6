"""Physical plans: what must be in them, and what must not."""

import pytest

from tillscope.plans import reports
from tillscope.registered import QUERIES
from tillscope.sources import startables

PLAIN = [
    n
    for n in QUERIES
    if "roundtrip" not in n
    and not n.startswith("stream_")
    and n not in ("partition_pruning", "purchase_table", "rolled_files", "cached_multi_sink")
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_pair_loops(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for node in ("EvalPython", "MapInPandas", "NestedLoopJoin", "CartesianProduct"):
        assert node not in plan
    # A global sort over one partition would show up as this.
    assert "SinglePartition" not in plan or name == "preview_sales"


@pytest.mark.parametrize(
    "name",
    ["top_categories", "top_products", "top_ips", "top_ip_countries", "top_countries", "preview_sales"],
)
def test_limits_are_taken_per_task(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, sf_dir))


def test_groups_are_cut_before_the_shuffle(spark, sf_dir):
    plan = _plan(QUERIES["top_products_per_category"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Partial")


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    def columns(name):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        return plan.split("ReadSchema: struct<")[1].split(">")[0]

    assert columns("top_categories") == "l_partkey:bigint,l_suppkey:bigint"
    assert columns("top_ips") == "l_orderkey:bigint,l_extendedprice:double"


def test_addresses_are_parsed_once(spark, sf_dir):
    """No inferred filter repeats the parse below the aggregation or at the scan."""
    for name in (
        "range_filter", "geo_join_inclusive", "geo_join_strict", "top_ip_countries",
        "top_countries",
    ):
        plan = _plan(QUERIES[name](spark, sf_dir))
        assert not [
            line for line in plan.splitlines() if " Filter" in line and "substring_index" in line
        ]


def test_self_join_scans_once(spark, sf_dir):
    df = QUERIES["category_self_join"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in _plan(df)


def test_self_join_of_large_inputs_is_not_dealt_by_category_alone(spark, sf_dir):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["category_self_join"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    below = plan[plan.index("SortMergeJoin") :]
    joined = [x for x in below.splitlines() if "hashpartitioning(category" in x and "_salt" in x]
    assert len(joined) >= 2


def test_country_report_shuffles_only_countries(spark, sf_dir):
    """With small blocks no exchange of the plan carries purchases."""
    plan = _plan(QUERIES["top_countries_all"](spark, sf_dir))
    keys = [
        line.split("hashpartitioning(")[1].split("#")[0]
        for line in plan.splitlines()
        if "Exchange hashpartitioning" in line
    ]
    assert "ip" not in keys and "ip_long" not in keys


def test_building_a_country_report_starts_no_job(spark, sf_dir):
    # Opening a parquet table is a job of its own, which reads its schema.
    tables = [make(spark, sf_dir) for make in (startables.purchases, startables.blocks, startables.countries)]
    spark.sparkContext.setJobGroup("building", "no job while a report is built")
    try:
        reports.top_countries(*tables, match="all")
        reports.top_countries(*tables)
        reports.top_ip_countries(*tables)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
