import os
from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rigwatch.operators import ordered, rules, sync, windows
from rigwatch.sources import messages
from rigwatch.streaming import jobs, progress, tables, transitions
from tests.test_streaming import T0, body, deliver, readings


def files_below(folder):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(folder) for f in names)


def test_keyed_table_stays_small_and_repeats(spark, out):
    schema = StructType().add("k", "integer").add("n", "integer").add("at", "timestamp")
    table = tables.KeyedTable(spark, out + "/t", ["k"], schema, every=5)
    counts = []
    for n in range(50):
        rows = [(k, n, T0 + timedelta(minutes=n)) for k in {n % 7, (n * 3) % 7, 100 + n // 10}] + [(None, n, T0)]
        for _ in range(2 if n % 6 == 4 else 1):  # some batches are repeated, also after a snapshot
            if not table.covers(n):
                table.put(spark.createDataFrame(rows, schema).coalesce(1), n)
            table.settle(n)
        counts.append(files_below(out + "/t"))
    got = {r.k: r.n for r in table.read().collect()}
    want = {}
    for n in range(50):
        for k in (n % 7, (n * 3) % 7, 100 + n // 10, None):
            want[k] = n
    assert got == want
    assert max(counts[25:]) <= max(counts[5:25])


def test_final_rows_leave_the_state(spark, out):
    schema = StructType().add("k", "integer").add("at", "timestamp")
    table = tables.KeyedTable(spark, out + "/t", ["k"], schema, every=2, final="at", keep=timedelta(minutes=3))
    for n in range(12):
        table.put(spark.createDataFrame([(n, T0 + timedelta(minutes=n))], schema), n)
        table.settle(n)
    assert sorted(r.k for r in table.read().collect()) == list(range(12))
    assert min(r.k for r in table.open_rows().collect()) == 8


def chunks(values, parts):
    step = len(values) // parts
    return [values[n * step:(n + 1) * step if n < parts - 1 else None] for n in range(parts)]


def test_one_job_makes_windows_alerts_and_current_state(spark, out):
    values = [(t, 400.0 if 60 <= t < 64 else float(t % 40)) for t in range(0, 180, 3)]
    for n, chunk in enumerate(chunks(values, 5)):
        deliver(spark, out + "/bus", [body("PS1", t, v) for t, v in chunk] + [body("TS1", chunk[-1][0], 150.0 if n == 2 else 20.0)], n * 100)
    stats = jobs.hop_stats_stream(readings(spark, out + "/bus"))
    made = tables.WindowTables(spark, stats, out + "/out", every=2, keep=timedelta(minutes=1))
    jobs.drain(made.start(out + "/cp", "available"))
    batch, _ = messages.split_valid(messages.parse_readings(spark.read.parquet(out + "/bus")))
    want = windows.hop_stats_direct(batch)
    key = lambda r: (r.sensor, r.window_start, r.max_value, r.sample_count)
    assert sorted(map(key, made.windows.read().collect())) == sorted(map(key, want.collect()))
    once = [(r.sensor, r.window_start, r.type) for r in made.alerts.read().collect()]
    assert sorted(once) == sorted((r.sensor, r.window_start, r.type) for r in rules.anomaly_events(want).collect())
    assert len(once) == len(set(once)) > 6
    newest = {r.sensor: r.window_end for r in want.groupBy("sensor").agg(F.max("window_end").alias("window_end")).collect()}
    assert {r.sensor: r.window_end for r in made.current.read().collect()} == newest


def test_repeated_batch_raises_no_second_alert(spark, out):
    stats = windows.hop_stats_direct(spark.createDataFrame([("PS1", T0, 400.0)], "sensor string, ts timestamp, value double"))
    made = tables.WindowTables(spark, stats, out + "/out", every=2)
    for n in (0, 0, 1, 1, 2, 2, 2):
        made.write(stats, n)
    assert made.alerts.read().count() == stats.count()
    made.write(stats.limit(0), 3)
    assert made.alerts.read().count() == stats.count()


def status_rows(spark, rows):
    return spark.createDataFrame([(s, t, T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 1), v) for s, t, m, v in rows],
                                 "sensor string, type string, window_start timestamp, window_end timestamp, status int")


def run_transitions(spark, out, batches, stale=timedelta(minutes=5)):
    for batch in batches:
        df = status_rows(spark, batch).coalesce(1)
        df.write.mode("append").parquet(out + "/in")
        stream = spark.readStream.schema(df.schema).parquet(out + "/in")
        with jobs.state_in_rocksdb(spark):
            changes = transitions.status_transitions(stream.withWatermark("window_end", "10 seconds"), stale)
            jobs.drain(jobs.to_parquet(changes, out + "/data", out + "/cp", (), "available"))
    return sorted((r.sensor, r.type, r.changed_at, r.state, r.previous) for r in spark.read.parquet(out + "/data").collect())


def test_transitions_are_rows_of_change(spark, out):
    at = lambda m: T0 + timedelta(minutes=m)
    got = run_transitions(spark, out, [
        [("PS1", "p", 2, 0), ("PS1", "p", 0, 0), ("PS1", "p", 1, 1)],          # out of order inside a batch
        [("PS1", "p", 3, 0), ("PS1", "p", 4, 0), ("TS1", "t", 3, 1)],
        [("PS1", "p", 20, 0), ("PS1", "p", 21, 1)],                             # silent for 15 minutes
        [("TS1", "t", 60, 1)],                                                  # moves the watermark
        [("TS1", "t", 61, 1)],
    ])
    assert got == [
        ("PS1", "p", at(0), "normal", None), ("PS1", "p", at(1), "raised", "normal"), ("PS1", "p", at(2), "normal", "raised"),
        ("PS1", "p", at(10), "stale", "normal"), ("PS1", "p", at(20), "normal", "stale"), ("PS1", "p", at(21), "raised", "normal"),
        ("PS1", "p", at(27), "stale", "raised"),
        ("TS1", "t", at(3), "raised", None), ("TS1", "t", at(9), "stale", "raised"), ("TS1", "t", at(60), "raised", "stale")]


def test_carried_values_over_batches_and_a_repeat(spark, out):
    rows = [(c, T0 + timedelta(hours=h), float((h * 7 + (c or 5)) % 11) if h % 4 else None, float(h) if h % 5 == 0 else None)
            for h in range(40) for c in (1, 2, None)]
    schema = "cycle int, window_start timestamp, fast double, slow double"
    df = spark.createDataFrame(rows, schema)
    made = tables.CarriedColumns(spark, df, out + "/o", ["cycle"], "window_start", ["slow"], "fast", 3600.0, every=2)
    for n in range(5):
        part = df.where((F.col("window_start") >= F.lit(T0 + timedelta(hours=8 * n))) & (F.col("window_start") < F.lit(T0 + timedelta(hours=8 * n + 8))))
        made.write(part, n)
        if n in (1, 2):
            made.write(part, n)  # repeated, once before and once after a snapshot
    filled = ordered.forward_fill(df, ["cycle"], "window_start", ["slow"])
    want = ordered.rate_of_change(filled, ["cycle"], "window_start", "fast", "fast_rate", 3600.0)
    want = ordered.rolling_mean(want, ["cycle"], "window_start", "fast", "fast_rolling", 6)
    key = lambda r: str((r.cycle, r.window_start, r.slow_interpolated, r.fast_rate, r.fast_rolling))
    assert sorted(map(key, made.read().collect())) == sorted(map(key, want.collect()))


def test_aligned_with_gaps_ties_and_null_keys(spark):
    rows = [("A", 1, 0, 1.0, 0), ("A", 1, 10, 2.0, 1), ("A", 1, 10, 3.0, 2), ("B", 1, 5, 7.0, 3), ("B", 1, 10, 8.0, 4), ("B", 1, 10, 9.0, 5),
            ("A", None, 3, 4.0, 6), ("B", None, 1, 5.0, 7), ("A", 2, 90_000, 6.0, 8), ("C", 2, 3, 1.5, 9)]
    df = spark.createDataFrame([(s, c, T0 + timedelta(seconds=t), v, o) for s, c, t, v, o in rows],
                               "sensor string, cycle int, ts timestamp, value double, offset long")
    got = {(r.cycle, r.offset): (r.A, r.B, r.C) for r in sync.aligned(df, "A", ["B", "C"]).collect()}
    assert got == {(1, 0): (1.0, None, None), (1, 1): (2.0, 9.0, None), (1, 2): (3.0, 9.0, None), (None, 6): (4.0, 5.0, None),
                   (2, 8): (6.0, None, 1.5)}


def test_forward_fill_keeps_every_row(spark):
    rows = [(None, T0, 1.0), (None, T0 + timedelta(days=2), None), (1, None, 5.0), (1, None, None), (1, T0, None)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v double")
    got = sorted(str((r.k, r.t, r.v_interpolated)) for r in ordered.forward_fill(df, ["k"], "t", ["v"]).collect())
    assert got == sorted(str(x) for x in [(None, T0, 1.0), (None, T0 + timedelta(days=2), 1.0), (1, None, 5.0), (1, None, None), (1, T0, None)])


def test_sync_record_arrays(spark):
    rows = [("PS1", 0, n, float(n)) for n in (2, 0, 1)] + [("TS1", 0, 0, 9.0)]
    df = spark.createDataFrame([(s, c, i, v, T0) for s, c, i, v in rows], "sensor string, cycle int, sample_idx int, value double, ts timestamp")
    row = sync.sync_record(df).first()
    assert (row.PS1_values, row.PS1_avg, row.PS1_std, row.PS1_count, row.second_in_cycle) == ([0.0, 1.0, 2.0], 1.0, 1.0, 3, 0)
    assert (row.TS1_values, row.TS1_std, row.FS1_values, row.FS1_avg, row.FS1_count) == ([9.0], None, [], None, 0)


def test_metrics_are_appended_while_queries_run(spark, out):
    for n in range(4):
        deliver(spark, out + "/bus", [body("PS1", 60 * n + t, 1.0) for t in range(5)] + ["{broken"], n * 10)
    deliver(spark, out + "/bus", [body("PS1", 1, 9.0)], 90)  # behind the watermark
    recorder = progress.ProgressRecorder(spark, out + "/metrics", every=2)
    spark.streams.addListener(recorder)
    try:
        from rigwatch.sources import bus
        made = jobs.archive_readings(bus.read_message_files(spark, out + "/bus", 1), out + "/raw", out + "/q", out + "/cp", "available")
        stats = jobs.to_updates(jobs.hop_stats_stream(readings(spark, out + "/bus")), out + "/s", out + "/cp-s", "available")
        jobs.drain(*made, stats)
        recorder.wait(*made, stats)
    finally:
        spark.streams.removeListener(recorder)
    rows = spark.read.parquet(out + "/metrics").collect()
    counted = [(r.read, r.valid, r.rejected) for r in rows if r.read]
    assert sorted(counted) == [(1, 1, 0)] + [(6, 5, 1)] * 4
    assert sum(r.late or 0 for r in rows) > 0
    assert recorder.save(spark, out + "/metrics") == 0


def test_stray_stamp_does_not_make_one_huge_row(spark):
    from rigwatch.operators import monitoring
    df = spark.createDataFrame([("PS1", T0, 1.0), ("PS1", T0 - timedelta(days=30), 1.0)], "sensor string, ts timestamp, value double")
    rate = monitoring.message_rate(df)
    assert rate.count() == 30 * 1440 + 1
    assert rate.agg(F.sum("messages")).first()[0] == 2
