"""The physical plans keep the shape that scales."""

import re

import pytest

from rigwatch.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("stream_", "train_metrics", "feature_importance"))))
def test_no_cross_join_and_no_python_workers(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|MapInPandas|FlatMapGroupsInPandas", text)


@pytest.mark.parametrize("name, scans", [
    ("hop_window_stats", 1), ("anomaly_status", 1), ("overall_health", 1), ("cycle_features", 1),
    ("cycle_rollup", 1), ("cycle_change", 1), ("sync_seconds", 1), ("sensor_corr", 1)])
def test_tables_are_read_once(spark, name, scans):
    df = QUERIES[name](spark, SF_DIR)
    assert plan(df).count("FileScan") == scans


@pytest.mark.parametrize("name", ["hop_window_stats", "latest_value", "tumbling_stats", "cycle_features",
                                  "sample_counts", "heatmap", "completeness", "newest_labels"])
def test_aggregations_do_not_sort_their_input(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, SF_DIR))


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["cycle_features"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text


def test_time_range_reaches_the_scan(spark):
    text = plan(QUERIES["recent_range"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,[^\]]*LessThanOrEqual\(ts,", text)


def test_partition_filter_reaches_the_archive(spark):
    text = plan(QUERIES["archive_scan"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*sensor", text)


def test_outliers_do_not_shuffle_readings(spark):
    text = plan(QUERIES["zscore_outliers"](spark, SF_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_days_reach_the_scan(spark):
    text = plan(QUERIES["cycle_sql"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts,[^\]]*LessThan\(ts,", text)


def test_latest_value_reads_once(spark):
    text = plan(QUERIES["latest_value"](spark, SF_DIR))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_outer_join_is_one_shuffle(spark):
    text = plan(QUERIES["outer_join_sensors"](spark, SF_DIR))
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
