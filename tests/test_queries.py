"""Every registered query against its SQL on the supplied tables."""

import os

import oracle
import pytest

from tidemark.plans import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = plan_of(frame)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan
    if name in ORACLES:
        assert oracle.compare(frame, duck, ORACLES[name]) is None
    else:
        assert frame.count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert contract.queries().keys() >= contract.oracle_sql().keys()


def test_star_reports_broadcast_and_prune(spark):
    plan = plan_of(QUERIES["sales_by_category"](spark, FOLDER))
    assert plan.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in plan
    assert "l_tax" not in plan and "p_retailprice" not in plan
    assert "partial_sum" in plan


def test_top_lists_do_not_sort_everything(spark):
    for name in ("top_products", "monthly_trend", "dq_duplicate_keys", "scd2_current"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER))


def test_load_bounds_reach_the_scan(spark):
    assert "LessThanOrEqual(o_orderdate" in plan_of(QUERIES["load_full"](spark, FOLDER))
    assert "GreaterThan(l_shipdate" in plan_of(QUERIES["load_incremental"](spark, FOLDER))


def scans(frame, table):
    lines = plan_of(frame).splitlines()
    return sum("FileScan parquet" in line and f"/{table}.parquet" in line for line in lines)


def test_joins_beyond_the_broadcast_limit_scan_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES["sales_by_category"](spark, FOLDER)
        assert scans(frame, "lineitem") == 1 and scans(frame, "orders") <= 2
        assert "BroadcastHashJoin" not in plan_of(frame)
        assert scans(QUERIES["promote_staging"](spark, FOLDER), "orders") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_pass_queries(spark):
    assert scans(QUERIES["dq_completeness"](spark, FOLDER), "lineitem") == 2  # all rows, and one partition
    assert scans(QUERIES["load_watermark"](spark, FOLDER), "orders") == 1
    assert scans(QUERIES["scd2_stats"](spark, FOLDER), "orders") == 3  # one per load
    assert scans(QUERIES["scd2_history"](spark, FOLDER), "orders") <= 2


def test_incremental_table_reads_what_it_needs(spark):
    frame = QUERIES["load_incremental_table"](spark, FOLDER)
    assert scans(frame, "lineitem") == 0 and "-base" in "".join(frame.inputFiles()) and "-delta" in "".join(frame.inputFiles())


def test_suite_scans_each_table_once(spark):
    plan = plan_of(QUERIES["dq_suite_json"](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    for table in ("orders", "events", "lineitem", "customer"):
        assert sum(f"/{table}.parquet" in line for line in scans) == 1


def test_library_stays_on_built_in_expressions():
    import pathlib

    import tidemark

    folder = pathlib.Path(tidemark.__file__).parent
    source = "\n".join(p.read_text() for p in folder.rglob("*.py") if "llm" not in p.relative_to(folder).parts)
    for word in ("udf", ".rdd", "localCheckpoint", "toPandas", "crossJoin", "F.rand(", "coalesce(1)"):
        assert word not in source
