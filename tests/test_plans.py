"""What the physical plans must and must not hold."""

import pytest

from tablespan.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plans(spark):
    """The initial physical plan of each registered query, worked out once."""
    # The tree form cuts long lists of filters short unless told otherwise.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return {
            name: query(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
            for name, query in QUERIES.items()
        }
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_pairs_everything_or_runs_python_by_row(plans, name):
    plan = plans[name]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroups"):
        assert bad not in plan


@pytest.mark.parametrize(
    "name, parts",
    [
        ("scan_branch_union", ["GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)", "EqualTo(o_orderstatus,F)"]),
        ("scan_file_list", ["GreaterThan(o_totalprice,400000.0)", "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>"]),
        ("struct_filter_deep", ["EqualTo(c_nationkey,2)"]),
        ("filter_mix", ["In(o_orderpriority", "Or(StringStartsWith(o_orderpriority,1)", "Not(EqualTo(o_orderstatus,P))"]),
        ("asof_version", ["LessThan(o_orderdate,1997-01-01T00:00)"]),
        ("asof_timestamp", ["LessThanOrEqual(ts,2024-01-15T12:00)", "partial_max_by"]),
        ("table_function_sql", ["GreaterThanOrEqual(o_orderdate,1999-01-01T00:00)"]),
        ("topk", ["TakeOrderedAndProject"]),
        ("fn_centroids", ["partial_avg"]),
        ("diff_of_frames", ["partial_sum"]),
    ],
)
def test_filters_columns_and_partial_work_reach_the_scan(plans, name, parts):
    for part in parts:
        assert part in plans[name]


def test_skipped_branches_are_not_in_the_plan(plans):
    plan = plans["branch_skipping"]
    assert plan.count("FileScan parquet") == 1
    assert "1997-01-01" in plan and "1998-01-01" in plan and "1996-01-01" not in plan


@pytest.mark.parametrize("name", ["scan_branch_union", "branch_skipping"])
def test_branches_of_one_file_read_it_once(plans, name):
    assert plans[name].count("FileScan parquet") == 1


def test_python_appears_only_where_nothing_else_will_do(plans):
    marks = ("Python", "MapInArrow")
    users = {name for name, plan in plans.items() if any(mark in plan for mark in marks)}
    assert users == {
        "scan_text_branch",
        "agg_user_grouped",
        "agg_user_many_groups",
        "agg_user_empty",
        "agg_user_ungrouped",
        "table_function_analyzed",
        "table_function_analyzed_narrow",
        "table_function_lateral",
        "table_function_lateral_wide",
        "table_function_over_table",
        "table_function_over_frame",
    }


def test_statistics_neither_copy_nor_sort_rows(plans):
    for name in ("column_statistics_exact", "column_statistics_nulls", "column_statistics_approx"):
        assert "Expand" not in plans[name] and "Sort [" not in plans[name]


@pytest.mark.parametrize("name", ["scan_planned_files", "scan_manifest"])
def test_planned_files_are_one_read(plans, name):
    assert plans[name].count("FileScan parquet") == 1 and "Union" not in plans[name]
