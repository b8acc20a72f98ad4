"""Plan shapes that must hold whatever the data size."""

import pytest

from __spark_entry__ import queries
from moorline.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Queries that run jobs of their own before they return their plan.
EAGER = {
    "dependency_levels", "dependency_closure", "dependency_cycles", "indexed_upsert", "versioned_publish", "registered_partitions", "indexed_lookup", "bucketed_star_join", "breakdown_rollup", "partition_upsert", "counted_write", "lookup_publish", "landing_job",
    "multi_source_job", "multi_source_breakdown", "table_verification", "profiled_count", "stage_counts", "shared_stage_counts",
}


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_python_no_nested_loops(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for operator in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct", "MapInPandas", "Window "):
        assert operator not in text


def test_no_broadcast_without_a_size(spark):
    """With automatic broadcast off nothing is broadcast: no hint is left in the plans."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("lookup_join", "star_join", "keyed_upsert", "skip_published", "stage_chain"):
            assert "Broadcast" not in plan(queries()[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name, filters", [
    ("conjunctive_filter", ["EqualTo(o_orderstatus,F)", "EqualTo(o_orderpriority,1-URGENT)"]),
    ("star_derived", ["EqualTo(c_mktsegment,BUILDING)"]),
    ("date_window", ["GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)", "LessThan(o_orderdate,1996-02-01T00:00)"]),
    ("templated_sql", ["EqualTo(o_orderstatus,F)", "GreaterThan(o_totalprice,100000.5)"]),
])
def test_filters_reach_the_scan(spark, name, filters):
    text = plan(queries()[name](spark, FOLDER))
    for one in filters:
        assert one in text


def test_columns_are_pruned(spark):
    text = plan(queries()["grouped_agg_having"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_partition_filter_prunes_folders(spark):
    text = plan(queries()["catalog_scan"](spark, FOLDER))
    assert "biz_dt" in text and "Filter" not in text.replace("DataFilters", "").replace("PushedFilters", "").replace("PartitionFilters", "")


@pytest.mark.parametrize("name, exchanges", [
    ("latest_per_key", 1), ("change_detection", 1), ("partition_breakdown", 1), ("status_split_union", 0), ("top_n", 0),
    ("settings_with_defaults", 1), ("run_log_duration", 1), ("child_records", 1),
])
def test_shuffles(spark, name, exchanges):
    assert plan(queries()[name](spark, FOLDER)).count("Exchange ") == exchanges


@pytest.mark.parametrize("name", ["latest_per_key", "change_detection", "run_log_duration", "settings_with_defaults", "partition_breakdown"])
def test_aggregates_before_the_shuffle(spark, name):
    assert "partial_" in plan(queries()[name](spark, FOLDER))


def test_flat_documents_build_no_arrays(spark):
    assert "collect_list" not in plan(queries()["flattened_params"](spark, FOLDER))


def test_changes_sort_each_load_once(spark):
    text = plan(queries()["change_detection"](spark, FOLDER))
    assert text.count("Sort [") == text.count("Exchange hashpartitioning") == 1
