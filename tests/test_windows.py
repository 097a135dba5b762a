from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rigwatch.operators import windows

T0 = datetime(2024, 1, 1)
SCHEMA = "sensor string, cycle int, value double, ts timestamp_ntz, sample_idx int"


def frame(spark, rows):
    return spark.createDataFrame(
        [(s, 0, v, T0 + timedelta(seconds=t) if t is not None else None, n) for n, (s, t, v) in enumerate(rows)], SCHEMA)


def rows(df):
    return {(r.sensor, r.window_start): r for r in df.collect()}


def test_single_sample_has_null_spread_and_six_windows(spark):
    got = rows(windows.hop_stats(frame(spark, [("PS1", 5, 7.0)])))
    assert len(got) == 6
    for r in got.values():
        assert (r.avg_value, r.max_value, r.min_value, r.range_value, r.sample_count) == (7.0, 7.0, 7.0, 0.0, 1)
        assert r.stddev_value is None
    assert min(k[1] for k in got) == T0 - timedelta(seconds=50)


def test_null_time_is_dropped_and_null_value_not_counted(spark):
    data = frame(spark, [("PS1", None, 1.0), ("PS1", 0, None), ("PS1", 1, 4.0), ("TS1", 0, None)])
    for build in (windows.hop_stats, windows.hop_stats_direct):
        got = rows(build(data))
        assert got["PS1", T0].sample_count == 1 and got["PS1", T0].avg_value == 4.0
        assert got["TS1", T0].sample_count == 0 and got["TS1", T0].avg_value is None


def test_spread_is_stable_for_large_offsets(spark):
    values = [1e9 + x for x in (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)]
    data = frame(spark, [("PS1", 7 * n, v) for n, v in enumerate(values)])
    got = rows(windows.hop_stats(data))["PS1", T0]
    assert got.stddev_value == pytest.approx(np.std(values, ddof=1), rel=1e-6)


def test_uneven_slide_falls_back(spark):
    data = frame(spark, [("PS1", t, float(t)) for t in range(0, 60, 3)])
    size, slide = timedelta(seconds=25), timedelta(seconds=10)
    assert sorted(windows.hop_stats(data, size, slide).collect()) == \
        sorted(windows.hop_stats_direct(data, size, slide).collect())


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["PS1", "TS1"]), st.integers(0, 400), st.floats(-500, 500)), min_size=1, max_size=60))
def test_bucketed_equals_direct_and_bounds_hold(spark, sample):
    data = frame(spark, sample)
    a, b = rows(windows.hop_stats(data)), rows(windows.hop_stats_direct(data))
    assert a.keys() == b.keys()
    for key, r in a.items():
        other = b[key]
        assert r.sample_count == other.sample_count
        assert r.min_value <= r.avg_value + 1e-9 and r.avg_value <= r.max_value + 1e-9 and r.range_value >= 0
        for c in ("avg_value", "max_value", "min_value", "range_value", "stddev_value"):
            assert (r[c] is None) == (other[c] is None)
            if r[c] is not None:
                assert r[c] == pytest.approx(other[c], abs=1e-6)


def test_hot_sensor_against_pandas(spark):
    """A third of all readings belong to one sensor and one window."""
    rng = np.random.default_rng(1)
    n = 6000
    pdf = pd.DataFrame({
        "sensor": np.where(np.arange(n) % 3 == 0, "PS1", rng.choice(["TS1", "TS2", "FS1"], n)),
        "cycle": 0, "value": rng.normal(100, 5, n), "sample_idx": np.arange(n, dtype="int32"),
        "ts": pd.Timestamp(T0) + pd.to_timedelta(np.where(np.arange(n) % 3 == 0, 3, rng.integers(0, 600, n)), unit="s")})
    data = spark.createDataFrame(pdf).repartition(8).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = rows(windows.hop_stats(data))
    hot = pdf[pdf.sensor == "PS1"].value
    for back in range(6):
        r = got["PS1", T0 - timedelta(seconds=10 * back)]
        assert r.sample_count == len(hot)
        assert r.stddev_value == pytest.approx(hot.std())


def test_tumbling_and_samples(spark):
    data = frame(spark, [("PS1", 0.1 * n, float(n)) for n in range(25)]).repartition(5)
    stats = {r.window_start: r for r in windows.tumbling_stats(data).collect()}
    first = stats[T0]
    assert (first.sample_count, first.first_sample_idx, first.last_sample_idx) == (10, 0, 9)
    whole = windows.window_samples(data).filter(F.col("window_start") == T0).collect()
    assert [list(p["values"]) for p in whole] == [[float(x) for x in range(10)]]
    record = windows.tumbling_record(data).filter(F.col("window_start") == T0).first()
    assert (record.sample_count, record.avg_value, record["values"]) == (10, 4.5, [float(x) for x in range(10)])
