"""Shapes of physical plans that decide whether a query scales."""

import re

import pytest
from conftest import DATA

from tablewright.operators import reconcile
from tablewright.plans.queries import QUERIES

WRITING = {"load_and_verify", "verify_target"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_scan_descriptions(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - WRITING))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for operator in ("NestedLoop", "CartesianProduct", "Python", "Pandas", "Arrow", "RDDScan"):
        assert operator not in plan
    # Only sums over whole tables end in one partition, of one row per task.
    for below in re.findall(r"Exchange SinglePartition.*\n.*?(\w+)\(", plan):
        assert below == "HashAggregate"


def test_summary_shuffles_twice_and_pushes_its_filter(spark):
    plan = plan_of(QUERIES["customer_order_summary"](spark, DATA))
    assert plan.count("Exchange hashpartitioning") <= 2
    orders = next(line for line in plan.split("\n") if "orders.parquet" in line)
    assert "EqualTo(o_orderstatus,F)" in orders and "GreaterThan(o_totalprice,0.0)" in orders
    assert "o_orderpriority" not in orders


def test_summary_of_large_tables_groups_orders_before_the_join(spark, no_broadcast):
    plan = plan_of(QUERIES["customer_order_summary"](spark, DATA))
    join = plan.index("SortMergeJoin [c_custkey")
    partial = plan.index("partial_count(o_orderkey")
    assert join < partial, "the partial count is below the join"


@pytest.mark.parametrize(
    "name, columns",
    [
        ("source_view", {"p_partkey", "p_name", "p_brand"}),
        ("agg_count_star", {"lang"}),
        ("check_unique", {"l_orderkey", "l_linenumber"}),
        ("recon_missing_keys", {"o_orderkey"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, DATA))
    first = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert {column.split("#")[0] for column in first.split(",")} == columns


def test_tables_bucketed_by_the_key_are_reconciled_without_a_shuffle(spark):
    df = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    for name in ("bucketed_one", "bucketed_two"):
        df.write.bucketBy(4, "k").mode("overwrite").saveAsTable(name)
    report = reconcile.report(spark.table("bucketed_one"), spark.table("bucketed_two"), "k")
    assert "Exchange hashpartitioning" not in plan_of(report)
    assert report.first().overall_status == "PASS"
