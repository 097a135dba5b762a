import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rigwatch.sources import bus, files, messages
from rigwatch.schemas import SENSOR_NAMES

GOOD = {"sensor": "PS1", "cycle": 0, "sample_idx": 100, "value": 151.19,
        "timestamp": "2025-11-08T14:30:45.123456", "sampling_rate_hz": 100}


def sent(spark, *bodies):
    rows = [(bytearray(b if isinstance(b, bytes) else json.dumps(b).encode()), n) for n, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "value binary, offset long")


def test_reading_shapes(spark):
    drifted = {"sensor": "PS1", "val": 1.0, "cycle": 0, "idx": 3, "ts": 1.0}
    result = {"sensor": "PS1", "avg_value": 3.0, "window_start": "2025-11-08T14:30:00"}
    label = {"cycle": 1, "label_cooler": 3, "timestamp": 1.7e9}
    no_time = {**GOOD, "timestamp": "noon"}
    valid, rejected = messages.split_valid(messages.parse_readings(
        sent(spark, GOOD, drifted, result, label, b"{broken", no_time), keep_bus_columns=True))
    (row,) = valid.collect()
    assert (row.sensor, row.cycle, row.sample_idx, row.value, row.offset) == ("PS1", 0, 100, 151.19, 0)
    assert row.ts == datetime(2025, 11, 8, 14, 30, 45, 123456)
    assert {r.offset: r.reason for r in rejected.collect()} == {
        1: "no value", 2: "no value", 3: "no sensor", 4: "no sensor", 5: "no event time"}


def test_body_is_decoded_once(spark):
    valid, _ = messages.split_valid(messages.parse_readings(sent(spark, GOOD)))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_null_fields_left_out_of_envelope(spark):
    df = spark.createDataFrame([("PS1", 1.0, None)], "sensor string, avg_value double, stddev_value double")
    body = json.loads(messages.envelope(df, "sensor").first().value)
    assert body == {"sensor": "PS1", "avg_value": 1.0}


def test_labels_and_stats_decode(spark):
    label = {"cycle": 4, "label_cooler": 3, "label_valve": 100, "label_pump": 0, "label_accumulator": 130,
             "label_stable": 1, "timestamp": 12.5}
    assert tuple(messages.parse_labels(sent(spark, label)).first()) == (4, 3, 100, 0, 130, 1, 12.5)
    stats = {"sensor": "PS1", "window_start": "2025-11-08T14:30:00.000Z", "avg_value": 2.0, "sample_count": 3}
    row = messages.parse_window_stats(sent(spark, stats)).first()
    assert row.sample_count == 3 and row.stddev_value is None and row.window_start == datetime(2025, 11, 8, 14, 30)


def test_device_events(spark):
    ok = {"device_id": "d", "cycle_index": 0, "event_time": "2025-01-01T00:00:00Z", "cooler_efficiency_pct": 40,
          "features": {"a": 1, "b": None, "c": "x"}, "unknown": 3}
    bodies = [ok, {**ok, "cycle_index": -1}, {**ok, "event_time": "soon"}, {k: v for k, v in ok.items() if k != "device_id"}]
    got = messages.device_events(sent(spark, *bodies)).collect()
    assert [r.problem for r in got] == [None, "cycle_index negative", "event_time not a date-time", "device_id missing"]
    assert got[0].features == {"a": "1", "b": None, "c": "x"}


@pytest.mark.parametrize("split_bytes", ["64", "1000", "100000000"])
def test_line_numbers_over_many_splits(spark, out, split_bytes):
    for name, count in (("PS1", 700), ("TS1", 35)):
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.writelines(f"{n}\t{n}.5\t{-n}\n" for n in range(count))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = files.numbered_lines(spark, out)
        assert lines.filter(F.col("line") != F.split("value", "\t")[0].cast("long")).count() == 0
        assert lines.count() == 735
        readings = files.read_matrices(spark, out)
        assert readings.count() == 735 * 3
        row = readings.filter("sensor = 'PS1' AND cycle = 123 AND sample_idx = 1").first()
        assert (row.value, row.sampling_rate_hz) == (123.5, 100)
        assert {r.sensor: r.cycles for r in files.count_cycles(spark, out).collect()} == {"PS1": 700, "TS1": 35}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_label_file(spark, out):
    path = os.path.join(out, "profile.txt")
    with open(path, "w") as f:
        f.write("3\t100\t0\t130\t1\n 20.0  90 1 115 0 \n3 100 0\n100 73 2 90 0\n")
    got = {r.cycle: tuple(r)[1:] for r in files.read_label_file(spark, path).collect()}
    assert got == {0: (3, 100, 0, 130, 1), 1: (20, 90, 1, 115, 0), 3: (100, 73, 2, 90, 0)}
    one_based = files.read_label_file(spark, path, cycle_offset=1)
    assert sorted(r.cycle for r in one_based.collect()) == [1, 2, 4]
    assert files.malformed_label_lines(spark.read.text(path)).count() == 1


def test_scan_filters_prune_partitions(spark, out):
    spark.range(20).selectExpr("id % 4 AS part", "id AS v").write.partitionBy("part").parquet(out + "/t")
    df = files.scan_parquet(spark, out + "/t", {"part": 2, "v": 6})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "EqualTo(v,6)" in plan
    assert [r.v for r in df.collect()] == [6]


def test_fallback_location(spark, out):
    spark.range(3).write.parquet(out + "/local")
    assert files.scan_with_fallback(spark, [out + "/none", out + "/local"]).count() == 3
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [out + "/none"])


def test_mapped_csv(spark, out):
    with open(out + "/x.csv", "w") as f:
        f.write("device_id,cycle_index,event_time,cooler_efficiency,pressure1,pressure2,temperature_cooler_out\n"
                "d1,3,2025-01-01T00:00:00Z,47.5,1,2,\n")
    row = files.read_mapped_csv(spark, out + "/x.csv").first()
    assert (row.device_id, row.cycle_index, row.cooler_efficiency_pct, row.temperature_cooler_out_C) == ("d1", 3, 47.5, None)


@pytest.mark.parametrize("start, end", [(-1, 2), (3, 3), (5, 2), (0, 11)])
def test_cycle_range_is_checked(spark, start, end):
    with pytest.raises(ValueError):
        files.cycle_range(spark.range(10).withColumnRenamed("id", "cycle"), start, end, 10)


def test_cycle_draws_repeat_and_are_reproducible(spark):
    data = spark.range(5).selectExpr("CAST(id AS INT) AS cycle")
    a = sorted(tuple(r) for r in files.sample_cycles(data, 50, 5).collect())
    assert a == sorted(tuple(r) for r in files.sample_cycles(data, 50, 5).collect())
    assert len(a) == 50 and {c for c, _ in a} == set(range(5))


def test_bus_options():
    options = bus.bus_options("host:9092", bus.SENSOR_TOPICS, fail_on_data_loss=False)
    assert options["subscribe"].count(",") == 16 and options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in options
    assert bus.bus_options("host:9092", pattern="x.*", max_per_trigger=500)["maxOffsetsPerTrigger"] == "500"
    with pytest.raises(ValueError):
        bus.bus_options("host:9092")


def test_topic_pattern_leaves_out_results_and_labels():
    import re
    pattern = re.compile(bus.sensor_pattern())
    assert all(pattern.fullmatch(t) for t in bus.SENSOR_TOPICS) and len(SENSOR_NAMES) == 17
    assert not pattern.fullmatch("hydraulic-analytics") and not pattern.fullmatch("hydraulic-labels")


def test_wide_ticks_from_matrix_files(spark, out):
    from rigwatch.operators.sync import wide_ticks

    for name, rate in (("PS1", 100), ("FS1", 10), ("TS1", 1)):
        with open(f"{out}/{name}.txt", "w") as f:
            for cycle in range(3):
                f.write("\t".join(str(cycle * 1000 + n) for n in range(rate * 2)) + "\n")
    wide = wide_ticks(files.read_matrices(spark, out), ["PS1", "FS1", "TS1"])
    got = {(r.profile_id, r.tick): (r.PS1, r.FS1, r.TS1) for r in wide.collect()}
    assert len(got) == 3 * 200 and {p for p, _ in got} == {1, 2, 3}
    assert got[1, 0] == (0.0, 0.0, 0.0)
    assert got[2, 137] == (1137.0, 1013.0, 1001.0)


def test_catalog_sizes(spark):
    from rigwatch.schemas import sensor_table

    row = sensor_table(spark).agg(F.count("*").alias("n"), F.sum("samples_per_cycle").alias("samples")).first()
    assert (row.n, row.samples) == (17, 43_680)


def test_bus_time(spark):
    df = spark.createDataFrame([(1_700_000_000_123,)], "ms long")
    assert df.select(messages.bus_time(F.col("ms"))).first()[0] == datetime(2023, 11, 14, 22, 13, 20, 123000)


def test_lines_are_numbered_through_a_folder(spark, out):
    """Files follow each other in the order of their names; blank and malformed lines count; other folders start anew."""
    for folder, names in (("sensor=PS1", {"part-00001.txt": "4\t5\n\n", "part-00000.txt": "1\t2\nx\t3\n"}), ("sensor=TS1", {"part-00000.txt": "9\n"})):
        os.makedirs(f"{out}/m/{folder}")
        for name, text in names.items():
            with open(f"{out}/m/{folder}/{name}", "w") as f:
                f.write(text)
    got = files.read_matrices(spark, f"{out}/m", cycle_offset=1, folders=True)
    assert sorted((r.sensor, r.cycle, r.sample_idx, r.value, r.sampling_rate_hz) for r in got.collect() if r.value is not None) == [
        ("PS1", 1, 0, 1.0, 100), ("PS1", 1, 1, 2.0, 100), ("PS1", 2, 1, 3.0, 100), ("PS1", 3, 0, 4.0, 100), ("PS1", 3, 1, 5.0, 100), ("TS1", 1, 0, 9.0, 1)]
    assert {(r.sensor, r.cycle) for r in got.collect() if r.value is None} == {("PS1", 2), ("PS1", 4)}


def test_wide_ticks_hold_no_table_of_ticks(spark):
    """Repeated samples, values and keys that are null; no aggregation keeps a row per tick."""
    from rigwatch.operators.sync import wide_ticks

    rows = [(1, "PS1", 0, 1.0), (1, "PS1", 0, 3.0), (1, "FS1", 0, None), (1, "FS1", 1, 2.0), (1, "TS1", 1, 5.0), (None, "TS1", 0, 7.0), (2, "TS1", None, 4.0)]
    want = {}
    for cycle, sensor, at, value in rows:
        factor = {"PS1": 1, "FS1": 10, "TS1": 100}[sensor]
        for tick in [None] if at is None else range(at * factor, at * factor + factor):
            cell = want.setdefault((cycle and cycle + 1, tick), {"PS1": [], "FS1": [], "TS1": []})[sensor]
            cell += [] if value is None else [value]
    df = wide_ticks(spark.createDataFrame(rows, "cycle int, sensor string, sample_idx int, value double"), ["PS1", "FS1", "TS1"])
    got = [tuple(r) for r in df.collect()]
    assert sorted(got, key=str) == sorted(((*k, *[max(v, default=None) for v in c.values()]) for k, c in want.items()), key=str)
    assert "keys=[cycle" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "tick" not in "".join(
        line for line in plan.splitlines() if "Aggregate(keys" in line)
