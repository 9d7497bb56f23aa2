"""The plans that matter at scale."""

import os

import pytest

from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def plan(spark, name):
    """The plan before adaptive execution, without broadcasts, as it looks on tables of any size."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("incremental_extract", "GreaterThan(ts,"),
        ("backfill_extract", "GreaterThanOrEqual(ts,"),
        ("in_list_filter", "In(event_type, [purchase,view])"),
        ("positive_filter", "GreaterThan(c_acctbal,0.0)"),
        ("expect_or_drop", "GreaterThan(value,0.0)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("daily_metrics", "event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double"),
        ("value_counts_type", "event_type:string"),
        ("dedupe_any", "user_id:bigint"),
        ("event_date", "event_id:bigint,ts:timestamp_ntz"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, name)


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("duration_flag", 0),
        ("search_rows", 0),
        ("fact_table", 0),
        ("union_batches", 0),
        ("schema_evolve", 0),
        ("daily_metrics", 1),
        ("dedupe_latest", 1),
        ("dedupe_version", 1),
        ("scd1_latest", 1),
        ("scd2_history", 1),
        ("expect_report", 1),
        ("preview", 0),
    ],
)
def test_no_more_shuffles_than_needed(spark, name, shuffles):
    assert plan(spark, name).count("Exchange ") == shuffles


def test_facts_are_summed_before_the_joins(spark):
    text = plan(spark, "top_creators")
    assert text.index("SortMergeJoin") < text.index("partial_count")
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_top_n_does_not_sort_everything(spark):
    for name in ("top_creators", "preview", "top_suppliers"):
        assert "TakeOrderedAndProject" in plan(spark, name)


def test_no_python_in_any_plan(spark):
    for name in ("star_join", "tier_distribution", "scd2_history", "search_rows", "rescue_malformed"):
        text = plan(spark, name)
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
