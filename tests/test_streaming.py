import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rigwatch.operators import rules, sync, windows
from rigwatch.plans import inputs
from rigwatch.plans.inputs import reading_stream
from rigwatch.sources import bus, messages
from rigwatch.streaming import jobs, progress

T0 = datetime(2024, 1, 1)


def body(sensor, t, value, idx=0, cycle=0):
    return json.dumps({"sensor": sensor, "cycle": cycle, "sample_idx": idx, "value": float(value),
                       "timestamp": (T0 + timedelta(seconds=t)).isoformat(), "sampling_rate_hz": 1})


def deliver(spark, folder, bodies, offset=0):
    """Add one file of messages to a bus folder."""
    rows = [(None, bytearray(b.encode()), "hydraulic-x", 0, offset + n, T0) for n, b in enumerate(bodies)]
    from rigwatch.schemas import BUS_MESSAGE
    spark.createDataFrame(rows, BUS_MESSAGE).coalesce(1).write.mode("append").parquet(folder)


def readings(spark, folder, one_by_one=True):
    stream = bus.read_message_files(spark, folder, 1 if one_by_one else None)
    return messages.split_valid(messages.parse_readings(stream))[0]


def closed(df, end):
    return {(r.sensor, r.window_start): (r.avg_value, r.sample_count) for r in df.collect() if r.window_end <= end}


def test_batch_equals_stream_over_several_files(spark, out):
    """Out-of-order rows within the watermark over four micro-batches."""
    values = [(t, (t * 37) % 101) for t in range(0, 200, 2)]
    chunks = [values[n * 25:(n + 1) * 25] for n in range(4)]
    for n in range(3):  # the last rows of a chunk arrive with the next one, 4 s late
        chunks[n + 1][:0] = chunks[n][-2:]
        del chunks[n][-2:]
    for n, chunk in enumerate(chunks):
        deliver(spark, out + "/bus", [body("PS1", t, v) for t, v in chunk], n * 100)
    stats = jobs.hop_stats_stream(readings(spark, out + "/bus"))
    jobs.drain(jobs.to_parquet(stats, out + "/data", out + "/cp", trigger="available"))
    batch, _ = messages.split_valid(messages.parse_readings(spark.read.parquet(out + "/bus")))
    end = T0 + timedelta(seconds=188)  # newest 198 s minus the 10 s watermark
    got = closed(spark.read.parquet(out + "/data"), end)
    assert got == closed(windows.hop_stats_direct(batch), end)
    assert got.keys() == closed(windows.hop_stats(batch), end).keys()
    assert len(got) > 15


def test_rows_behind_the_watermark_are_dropped(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 5, 1.0)])
    deliver(spark, out + "/bus", [body("PS1", 500, 2.0)], 10)
    deliver(spark, out + "/bus", [body("TS1", 501, 0.0)], 20)  # late rows are judged by the watermark one batch back
    deliver(spark, out + "/bus", [body("PS1", 6, 99.0), body("PS1", 495, 4.0)], 30)
    stats = jobs.hop_stats_stream(readings(spark, out + "/bus"))
    jobs.drain(jobs.to_updates(stats, out + "/data", out + "/cp", "available"))
    state = jobs.current_state(spark, out + "/data", ["sensor", "window_start", "window_end"])
    got = {r.window_start: (r.avg_value, r.sample_count) for r in state.filter("sensor = 'PS1'").collect()}
    assert got[T0] == (1.0, 1)
    assert got[T0 + timedelta(seconds=450)] == (3.0, 2)


def test_update_log_keeps_the_newest_and_survives_a_repeat(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 1, 10.0)])
    deliver(spark, out + "/bus", [body("PS1", 2, 20.0)], 10)
    stats = jobs.hop_stats_stream(readings(spark, out + "/bus"))
    jobs.drain(jobs.to_updates(stats, out + "/data", out + "/cp", "available"))
    keys = ["sensor", "window_start", "window_end"]
    state = jobs.current_state(spark, out + "/data", keys)
    row = state.filter(F.col("window_start") == F.lit(T0)).first()
    assert (row.avg_value, row.sample_count) == (15.0, 2)
    before = sorted(state.collect())
    # A repeated batch overwrites its own folder.
    first = spark.createDataFrame(spark.read.parquet(out + "/data/batch_id=0").collect(), stats.schema)
    first.write.mode("overwrite").parquet(out + "/data/batch_id=0")
    assert sorted(jobs.current_state(spark, out + "/data", keys).collect()) == before
    jobs.compact_updates(spark, out + "/data", keys, out + "/compact")
    assert sorted(jobs.current_state(spark, out + "/compact", keys).collect()) == before


def test_restart_continues_from_the_checkpoint(spark, out):
    deliver(spark, out + "/bus", [body("PS1", t, t) for t in range(5)])
    def run():
        jobs.drain(jobs.to_updates(jobs.running_counts(readings(spark, out + "/bus")), out + "/data", out + "/cp", "available"))
        return {r.sensor: r.sample_count for r in jobs.current_state(spark, out + "/data", ["sensor"]).collect()}
    assert run() == {"PS1": 5}
    deliver(spark, out + "/bus", [body("PS1", 9, 1), body("TS1", 9, 1)], 50)
    assert run() == {"PS1": 6, "TS1": 1}


def test_archive_and_quarantine(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 1, 1), "{broken", json.dumps({"sensor": "PS1", "avg_value": 2.0})])
    stream = bus.read_message_files(spark, out + "/bus")
    jobs.drain(*jobs.archive_readings(stream, out + "/raw", out + "/bad", out + "/cp", "available"))
    assert os.path.isdir(out + "/raw/sensor=PS1")
    assert spark.read.parquet(out + "/raw").count() == 1
    bad = spark.read.parquet(out + "/bad").collect()
    assert sorted(r.reason for r in bad) == ["no sensor", "no value"]
    assert "{broken" in {r.body for r in bad} and all(r.offset is not None and r.topic for r in bad)


def test_archive_by_sensor_and_date(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 1, 1), body("PS1", 90_000, 2), body("TS1", 2, 3)])
    stream = bus.read_message_files(spark, out + "/bus")
    jobs.drain(*jobs.archive_readings(stream, out + "/raw", out + "/bad", out + "/cp", "available", ("sensor", "date")))
    assert os.path.isdir(out + "/raw/sensor=PS1/date=2024-01-02")
    assert spark.read.parquet(out + "/raw").filter("sensor = 'PS1' AND date = '2024-01-01'").first().value == 1.0


def test_documents_are_routed_by_kind(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 1, 1), json.dumps({"sensor": "PS1", "avg_value": 2.0})], 7)
    jobs.drain(jobs.to_documents(bus.read_message_files(spark, out + "/bus"), out + "/docs", out + "/cp", "available"))
    got = {r.kind: (r.kafka_offset, r.kafka_timestamp) for r in spark.read.parquet(out + "/docs").collect()}
    assert got == {"raw": (7, "2024-01-01T00:00:00.000"), "analytics": (8, "2024-01-01T00:00:00.000")}


def test_replays_are_dropped(spark, out):
    deliver(spark, out + "/bus", [body("PS1", n, n, n) for n in range(5)] * 2)
    once = jobs.drop_replays(jobs.watermarked(readings(spark, out + "/bus")))
    jobs.drain(jobs.to_parquet(once, out + "/data", out + "/cp", trigger="available"))
    assert spark.read.schema(once.schema).parquet(out + "/data").count() == 5


@pytest.mark.parametrize("mode", ["append", "update"])
def test_synchronised_stream_equals_batch(spark, out, mode):
    rows = [body(s, t / 4, t + n, t) for t in range(200) for n, s in enumerate(("PS1", "FS1", "TS1"))]
    deliver(spark, out + "/bus", rows[:300])
    deliver(spark, out + "/bus", rows[300:], 1000)
    wide = sync.sync_stream(jobs.watermarked(readings(spark, out + "/bus")))
    keys = ["window_start", "window_end", "cycle"]
    if mode == "append":
        jobs.drain(jobs.to_parquet(wide, out + "/data", out + "/cp", trigger="available"))
        got = spark.read.parquet(out + "/data")
    else:
        jobs.drain(jobs.to_updates(wide, out + "/data", out + "/cp", "available"))
        got = jobs.current_state(spark, out + "/data", keys)
    batch, _ = messages.split_valid(messages.parse_readings(spark.read.parquet(out + "/bus")))
    want = sync.sync_table(batch, stats=("avg", "min", "max"))
    columns = [*keys, "PS1_avg", "FS1_max", "TS1_min"]
    end = T0 + timedelta(seconds=39)
    a = sorted(tuple(r) for r in got.select(columns).collect() if r.window_end <= end)
    b = sorted(tuple(r) for r in want.select(columns).collect() if r.window_end <= end)
    assert a == b and len(a) >= 38


def test_alert_stream(spark, out):
    deliver(spark, out + "/bus", [body("PS1", 1, 310), body("PS1", 2, 200), body("PS1", 300, 200)])
    found = jobs.alerts(jobs.hop_stats_stream(readings(spark, out + "/bus")))
    jobs.drain(jobs.to_parquet(found, out + "/data", out + "/cp", trigger="available"))
    got = spark.read.parquet(out + "/data").filter(F.col("window_start") == F.lit(T0))
    assert sorted(r.type for r in got.collect()) == ["high_pressure", "pressure_spike"]


def test_progress_table_and_stop(spark, out):
    recorder = progress.ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        deliver(spark, out + "/bus", [body("PS1", n, n) for n in range(4)])
        query = jobs.to_parquet(readings(spark, out + "/bus"), out + "/data", out + "/cp", ["sensor"], "1 second")
        query.processAllAvailable()
        table = progress.progress_table(spark, query)
        assert table.agg(F.sum("input_rows")).first()[0] == 4
        jobs.stop_all(spark)
        assert not query.isActive
        assert recorder.table(spark).columns == table.columns
        held = recorder.table(spark).count()
        assert recorder.save(spark, out + "/metrics") >= held and recorder.table(spark).count() == 0
        assert recorder.save(spark, out + "/metrics") == 0 or held >= 0
    finally:
        spark.streams.removeListener(recorder)


def test_console_sink_starts(spark, out, capfd):
    deliver(spark, out + "/bus", [body("PS1", 1, 1)])
    query = jobs.to_console(readings(spark, out + "/bus"), out + "/cp", "1 second")
    query.processAllAvailable()
    query.stop()


def test_time_partitions(spark, out):
    deliver(spark, out + "/bus", [body("PS1", t, 1) for t in (1, 3700, 9000)])
    stats = jobs.hop_stats_stream(readings(spark, out + "/bus"))
    jobs.drain(jobs.to_time_partitions(stats, out + "/data", out + "/cp", "available"))
    assert {d for d in os.listdir(out + "/data") if d.startswith("date")} == {"date=2023-12-31", "date=2024-01-01"}
    assert os.path.isdir(out + "/data/date=2024-01-01/hour=1")


def test_status_stream_over_given_tables_is_never_above_batch(spark, out):
    sf = "/root/testdata/sf0.001"
    stats = jobs.hop_stats_stream(reading_stream(spark, sf), inputs.SIZE, inputs.SLIDE)
    status = rules.anomaly_status(stats)
    jobs.drain(jobs.to_parquet(status, out + "/data", out + "/cp", trigger="available"))
    batch = rules.anomaly_status(windows.hop_stats(inputs.readings(spark, sf), inputs.SIZE, inputs.SLIDE))
    assert 0 < spark.read.parquet(out + "/data").count() <= batch.count()
