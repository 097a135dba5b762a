"""Queries stay right when a third of the readings share one sensor, cycle and hour."""

import pytest

import __spark_entry__ as entry
from tests import skewed
from tests.oracle import connect, differences

NAMES = ["hop_window_stats", "hop_window_per_cycle", "anomaly_status", "state_timeline", "overall_health", "latest_value",
         "raw_vs_smooth", "threshold_tuning", "early_warning", "zscore_outliers", "tumbling_stats", "window_samples",
         "sync_seconds", "forward_fill", "rolling_mean", "upsample", "wide_matrix", "sample_times", "cycle_features",
         "labelled_inner", "archive_scan", "stream_hop_stats", "stream_dedup"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return skewed.write("/root/testdata/sf0.01", str(tmp_path_factory.mktemp("skewed")))


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_the_tables_are_skewed(con):
    n, most = con.execute("""
        SELECT sum(n), max(n) FROM (SELECT user_id, (event_id + user_id + 14) % 17, date_trunc('hour', ts), count(*) AS n
                                    FROM events GROUP BY ALL)""").fetchone()
    assert most > n / 3 - 1


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql_on_skewed_tables(spark, folder, con, name):
    got = entry.queries()[name](spark, folder).toPandas()
    assert differences(got, con.execute(entry.oracle_sql()[name]).df()) == []
