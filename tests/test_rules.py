from datetime import datetime, timedelta

import pytest

from rigwatch.operators import monitoring, rules
from rigwatch.functions.columns import HEALTH_BANDS, band
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
SCHEMA = ("sensor string, window_start timestamp_ntz, window_end timestamp_ntz, avg_value double, "
          "max_value double, min_value double, range_value double")


def stats(spark, rows):
    return spark.createDataFrame(
        [(s, T0 + timedelta(seconds=t), T0 + timedelta(seconds=t + 60), float(a), float(hi),
          float(lo), float(hi - lo)) for s, t, a, hi, lo in rows], SCHEMA)


def fired(spark, *rows, rule_set=rules.DEFAULT_RULES):
    return sorted((r.sensor, r.type) for r in rules.anomaly_events(stats(spark, rows), rule_set).collect())


def test_thresholds_are_strict(spark):
    assert fired(spark, ("PS1", 0, 260, 300.0, 250.0), ("TS1", 0, 90, 100.0, 99.0), ("PS3", 0, 100, 150.0, 100.0)) == []
    assert fired(spark, ("PS1", 0, 260, 300.01, 250.02), ("TS1", 0, 90, 100.01, 99.0), ("PS3", 0, 100, 150.01, 100.0)) == \
        [("PS1", "high_pressure"), ("PS3", "pressure_spike"), ("TS1", "high_temperature")]


def test_only_the_first_sensor_of_a_kind_has_level_rules(spark):
    assert fired(spark, ("PS2", 0, 390, 400.0, 390.0), ("TS2", 0, 190, 200.0, 190.0)) == []


def test_null_statistics_do_not_fire(spark):
    df = spark.createDataFrame([("PS1", T0, T0, None, None, None, None)], SCHEMA)
    assert rules.anomaly_events(df).count() == 0
    assert rules.sensor_health(df).first().health == 100


def test_nominal_profile(spark):
    got = fired(spark, ("PS4", 0, 161.0, 181.0, 150.0), ("TS3", 0, 61.0, 62.0, 60.0), ("PS5", 0, 160.0, 180.0, 150.0),
                rule_set=rules.NOMINAL_RULES)
    assert got == [("PS4", "high_pressure"), ("PS4", "pressure_spike"), ("TS3", "high_temperature")]


def test_status_series_and_health(spark):
    df = stats(spark, [("PS1", 0, 280, 320.0, 200.0), ("PS2", 0, 280, 320.0, 200.0), ("TS1", 0, 10, 20, 5),
                       ("FS1", 0, 999, 999, 0)])
    status = {(r.sensor, r.type): r.status for r in rules.anomaly_status(df).collect()}
    assert status == {("PS1", "high_pressure"): 1, ("PS1", "pressure_spike"): 1, ("PS2", "high_pressure"): 0,
                      ("PS2", "pressure_spike"): 1, ("TS1", "high_temperature"): 0}
    health = {r.sensor: r.health for r in rules.sensor_health(df).collect()}
    assert health == {"PS1": 70, "PS2": 90, "TS1": 100, "FS1": 100}


def test_health_never_below_zero(spark):
    heavy = [rules.Rule(f"t{n}", "PS.*", "max_value", 1.0, 20) for n in range(7)]
    assert rules.sensor_health(stats(spark, [("PS1", 0, 5, 5, 5)]), heavy).first().health == 0


def test_empty_input_defaults(spark):
    empty = stats(spark, [])
    assert tuple(monitoring.overall_health(rules.sensor_health(empty)).first()) == (100.0, "green")
    assert tuple(monitoring.active_anomalies(rules.anomaly_status(empty)).first()) == (0, "green")


def test_current_values_come_from_the_last_window(spark):
    df = stats(spark, [("PS1", 10, 100, 110, 100), ("PS1", 0, 280, 320, 200)])
    assert monitoring.active_anomalies(rules.anomaly_status(df)).first().active == 0
    assert monitoring.overall_health(rules.sensor_health(df)).first().health == 100.0


@pytest.mark.parametrize("value, colour", [(-5, "red"), (79.9, "red"), (80, "orange"), (90, "green"), (100, "green"), (None, None)])
def test_bands(spark, value, colour):
    df = spark.createDataFrame([(None if value is None else float(value),)], "v double")
    assert df.select(band("v", HEALTH_BANDS)).first()[0] == colour


def test_patterns_match_whole_names(spark):
    df = spark.createDataFrame([("PS1",), ("PS11",), ("XPS1",), ("TS1",)], "sensor string")
    def names(p):
        return sorted(r.sensor for r in df.filter(rules.matches(p)).collect())
    assert names("PS1") == ["PS1"]
    assert names("PS.*") == ["PS1", "PS11"]
    assert names("PS1|TS1") == ["PS1", "TS1"]


def test_wide_detector_first_match_wins(spark):
    df = spark.createDataFrame([(301.0, 101.0, 60.0), (10.0, 101.0, 60.0), (10.0, 10.0, 51.0), (300.0, 100.0, 50.0), (None, None, 51.0)],
                               "PS1_avg double, temperature_mean double, pressure_range double")
    assert [r.anomaly_type for r in rules.wide_anomalies(df).collect()] == \
        ["high_pressure", "high_temperature", "pressure_range_anomaly", "pressure_range_anomaly"]


def test_subtract_series(spark):
    a = spark.createDataFrame([("PS1", 1, 5.0), ("PS2", 1, 7.0)], "sensor string, window_start int, value double")
    b = spark.createDataFrame([("PS1", 1, 2.0), ("PS1", 2, 2.0)], "sensor string, window_start int, value double")
    assert [tuple(r) for r in monitoring.subtract_series(a, b).collect()] == [("PS1", 1, 3.0)]


def test_threshold_tuning_unlabelled_and_empty(spark):
    df = stats(spark, [("PS1", 0, 280, 320, 300)]).withColumn("cycle", F.lit(1))
    labels = spark.createDataFrame([(1, 100)], "cycle int, label_cooler int")
    got = {(r.type, r.factor): r for r in rules.threshold_tuning(df, labels, factors=(1.0, 1.2)).collect()}
    assert got["high_pressure", 1.0].false_alarms == 1 and got["high_pressure", 1.2].false_alarms == 0
    assert got["high_temperature", 1.0].false_alarm_rate is None
