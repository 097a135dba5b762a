"""Streaming jobs run over what is there, with their result tables read back."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from rigwatch.functions.columns import fixed
from rigwatch.operators import rules, sync
from rigwatch.plans import inputs as i
from rigwatch.plans.inputs import r, with_ctes
from rigwatch.plans.monitoring import _HOP_SQL, DOUBLES, rounded
from rigwatch.plans.registry import query
from rigwatch.schemas import LABEL_NAMES, SENSOR_NAMES, SENSORS, TOP_RATE_HZ
from rigwatch.session import scratch_path
from rigwatch.streaming import jobs, progress, tables, transitions

DELAY = timedelta(seconds=10)
# Append mode emits a window once the watermark has passed its end.
_CLOSED = "window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 SECOND FROM readings)"


def _paths(spark, label: str) -> tuple[str, str]:
    base = scratch_path(spark, label)
    return f"{base}/data", f"{base}/checkpoint"


def _appended(spark, df, label: str, partition_by=()):
    data, checkpoint = _paths(spark, label)
    jobs.drain(jobs.to_parquet(df, data, checkpoint, partition_by, "available"))
    return spark.read.schema(df.schema).parquet(data)


def _stats(spark, sf):
    return jobs.hop_stats_stream(i.reading_stream(spark, sf), i.SIZE, i.SLIDE, DELAY)


@query("stream_hop_stats", _HOP_SQL + f" WHERE {_CLOSED}")
def stream_hop_stats(spark, sf):
    return rounded(i.plain_times(_appended(spark, _stats(spark, sf), "hops")), *DOUBLES)


@query("stream_hop_updates", _HOP_SQL)
def stream_hop_updates(spark, sf):
    data, checkpoint = _paths(spark, "updates")
    jobs.drain(jobs.to_updates(_stats(spark, sf), data, checkpoint, "available"))
    state = jobs.current_state(spark, data, ["sensor", "window_start", "window_end"])
    return rounded(i.plain_times(state), *DOUBLES)


@query("stream_alerts", with_ctes(i.EVENTS, select=f"""
SELECT sensor, window_start, window_end, type, max_value FROM raised WHERE {_CLOSED}"""))
def stream_alerts(spark, sf):
    found = _appended(spark, jobs.alerts(_stats(spark, sf)), "alerts")
    return i.plain_times(found).select("sensor", "window_start", "window_end", "type", "max_value")


@query("stream_status", with_ctes(i.STATUS, select=f"SELECT * FROM status WHERE {_CLOSED}"))
def stream_status(spark, sf):
    return i.plain_times(_appended(spark, rules.anomaly_status(_stats(spark, sf)), "status"))


_CUT = "TIMESTAMP '2024-01-16 00:00:00'"


@query("stream_late_rows", _HOP_SQL.replace("FROM events", f"FROM events WHERE ts >= {_CUT}") + f" WHERE {_CLOSED}")
def stream_late_rows(spark, sf):
    """Statistics over two runs of a job: the rows before the cut come after the others and are too late."""
    base = scratch_path(spark, "late")
    events = spark.read.schema(i.EVENT_COLUMNS).parquet(f"{sf}/events.parquet")
    late = F.col("ts") < F.expr(_CUT.replace("TIMESTAMP ", "timestamp_ntz"))
    for part in (events.where(~late), events.where(late)):
        part.write.mode("append").parquet(f"{base}/in")
        stats = jobs.hop_stats_stream(i.readings_of(spark.readStream.schema(events.schema).parquet(f"{base}/in")), i.SIZE, i.SLIDE, DELAY)
        jobs.drain(jobs.to_parquet(stats, f"{base}/data", f"{base}/checkpoint", (), "available"))
    return rounded(i.plain_times(spark.read.schema(stats.schema).parquet(f"{base}/data")), *DOUBLES)


_SYNC = [f"{s}_{k}" for s in SENSOR_NAMES for k in ("avg", "min", "max")]


@query("stream_sync", with_ctes(i.READINGS, i.sync_cte(("avg", "min", "max")), select="SELECT window_start, window_end, cycle, "
       + ", ".join(f'{r(chr(34) + c + chr(34))} AS "{c}"' for c in _SYNC) + f" FROM sync WHERE {_CLOSED}"))
def stream_sync(spark, sf):
    wide = sync.sync_stream(jobs.watermarked(i.reading_stream(spark, sf), DELAY), i.RIG_WIDTH)
    return rounded(i.plain_times(_appended(spark, wide, "sync")), *_SYNC)


@query("stream_time_partitions", with_ctes(i.HOP, select=f"""
SELECT date_trunc('day', window_start)::TIMESTAMP AS date, CAST(hour(window_start) AS INT) AS hour, count(*) AS windows
FROM hop WHERE {_CLOSED} GROUP BY 1, 2"""))
def stream_time_partitions(spark, sf):
    data, checkpoint = _paths(spark, "by-time")
    jobs.drain(jobs.to_time_partitions(_stats(spark, sf), data, checkpoint, "available"))
    counted = spark.read.parquet(data).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("windows"))
    return i.day_as_time(counted, "date")


@query("stream_raw_archive", with_ctes(i.READINGS, select="""
SELECT sensor, cycle, CAST("offset" AS INT) AS sample_idx, value, ts FROM readings WHERE "offset" % 10 < 7"""))
def stream_raw_archive(spark, sf):
    base = scratch_path(spark, "archive")
    messages = i.messages_of(i.reading_stream(spark, sf))
    jobs.drain(*jobs.archive_readings(messages, f"{base}/raw", f"{base}/quarantine", f"{base}/checkpoints", "available"))
    return i.plain_times(spark.read.parquet(f"{base}/raw")).select("sensor", "cycle", "sample_idx", "value", "ts")


@query("stream_quarantine", with_ctes(i.READINGS, select="""
SELECT "offset", 'hydraulic-' || sensor AS topic, CAST("offset" % 8 AS INT) AS partition,
       CASE WHEN "offset" % 10 = 9 THEN '{broken' END AS broken_body,
       CASE WHEN "offset" % 10 = 9 THEN 'no sensor' ELSE 'no value' END AS reason
FROM readings WHERE "offset" % 10 >= 7"""))
def stream_quarantine(spark, sf):
    """What the archive turns away, with the message as it came."""
    base = scratch_path(spark, "archive")
    messages = i.messages_of(i.reading_stream(spark, sf))
    jobs.drain(*jobs.archive_readings(messages, f"{base}/raw", f"{base}/quarantine", f"{base}/checkpoints", "available"))
    broken = F.when(F.col("offset") % 10 == 9, F.col("body")).alias("broken_body")
    return spark.read.parquet(f"{base}/quarantine").select("offset", "topic", "partition", broken, "reason")


@query("stream_label_archive", with_ctes(i.LABELS, select="SELECT * FROM labelled"))
def stream_label_archive(spark, sf):
    source = i.table_stream(spark, sf, "customer", i.CUSTOMER_COLUMNS)
    sent = i.labels_of(source).select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    data, checkpoint = _paths(spark, "labels")
    jobs.drain(jobs.archive_labels(sent, data, checkpoint, "available"))
    return spark.read.parquet(data).select("cycle", *LABEL_NAMES)


@query("stream_documents", with_ctes(i.READINGS, select="""
SELECT "offset" AS kafka_offset, CAST("offset" % 8 AS INT) AS kafka_partition,
       CASE WHEN "offset" % 10 = 8 THEN 'analytics' ELSE 'raw' END AS kind FROM readings"""))
def stream_documents(spark, sf):
    data, checkpoint = _paths(spark, "documents")
    jobs.drain(jobs.to_documents(i.messages_of(i.reading_stream(spark, sf)), data, checkpoint, "available"))
    return spark.read.parquet(data).select("kafka_offset", "kafka_partition", "kind")


@query("stream_counts", with_ctes(i.READINGS, select="""
SELECT sensor, count(*) AS sample_count, max(ts) AS last_update FROM readings GROUP BY sensor"""))
def stream_counts(spark, sf):
    data, checkpoint = _paths(spark, "counts")
    jobs.drain(jobs.to_updates(jobs.running_counts(i.reading_stream(spark, sf)), data, checkpoint, "available"))
    return i.plain_times(jobs.current_state(spark, data, ["sensor"]))


@query("stream_gauges", with_ctes(i.READINGS, select="""
SELECT sensor, max_by(value, struct_pack(t := ts, o := "offset")) AS value, count(*) AS sample_count, max(ts) AS last_update
FROM readings GROUP BY sensor"""))
def stream_gauges(spark, sf):
    data, checkpoint = _paths(spark, "gauges")
    jobs.drain(jobs.publish_gauges(i.reading_stream(spark, sf), data, checkpoint, "available"))
    return i.plain_times(jobs.current_state(spark, data, ["sensor"]))


@query("stream_dedup", with_ctes(i.READINGS, select='SELECT sensor, cycle, "offset", ts, value FROM readings'))
def stream_dedup(spark, sf):
    """Every reading delivered twice, archived once."""
    twice = i.reading_stream(spark, sf).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    once = jobs.drop_replays(jobs.watermarked(twice, DELAY), ["sensor", "cycle", "offset"])
    return i.plain_times(_appended(spark, once.drop("delivery"), "once")).select("sensor", "cycle", "offset", "ts", "value")


@query("stream_health", with_ctes(i.HEALTH, select=f"""
SELECT sensor, {r('avg(health)')} AS health FROM scores WHERE {_CLOSED} GROUP BY sensor"""))
def stream_health(spark, sf):
    scores = _appended(spark, rules.sensor_health(_stats(spark, sf)), "health")
    return scores.groupBy("sensor").agg(fixed(F.avg("health")).alias("health"))


@query("stream_outer_join", with_ctes(i.READINGS, i.sync_cte(("avg",)), select="SELECT window_start, window_end, cycle, "
       + ", ".join(f'{r(chr(34) + s + "_avg" + chr(34))} AS "{s}_avg"' for s in SENSOR_NAMES) + f" FROM sync WHERE {_CLOSED}"))
def stream_outer_join(spark, sf):
    """Streams of three sampling rates in full outer joins; most windows have silent sensors."""
    joined = sync.join_sensor_streams(jobs.watermarked(i.reading_stream(spark, sf), DELAY), i.RIG_WIDTH)
    return rounded(i.plain_times(_appended(spark, joined, "outer")), *[f"{s}_avg" for s in SENSOR_NAMES])


def _in_parts(spark, sf: str, folder: str, parts: int):
    """The events, delivered in ``parts`` spans of time: after each the stream of all readings so far, to be drained."""
    events = spark.read.schema(i.EVENT_COLUMNS).parquet(f"{sf}/events.parquet")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / parts
    for n in range(parts):
        span = events.where(F.col("ts") >= F.lit(first + n * step).cast("timestamp_ntz"))
        if n < parts - 1:
            span = span.where(F.col("ts") < F.lit(first + (n + 1) * step).cast("timestamp_ntz"))
        span.write.mode("append").parquet(folder)
        yield i.readings_of(spark.readStream.schema(events.schema).parquet(folder))


_STALE = timedelta(minutes=150)
_SHORT = timedelta(hours=2)


@query("stream_status_transitions", with_ctes(i.STATUS.replace(i.hops(), i.hops(2)), f"""
seen AS (
  SELECT *, lag(status) OVER w AS before, lag(window_end) OVER w AS before_end, lead(window_end) OVER w AS next_end
  FROM (SELECT * FROM status WHERE {_CLOSED}) WHERE window_end <= (SELECT max(window_end) - INTERVAL 10 SECOND FROM status WHERE {_CLOSED})
  WINDOW w AS (PARTITION BY sensor, type ORDER BY window_start))""", f"""
named AS (
  SELECT *, CASE status WHEN 1 THEN 'raised' ELSE 'normal' END AS now,
         CASE WHEN window_end - before_end > INTERVAL 150 MINUTE THEN 'stale'
              WHEN before = 1 THEN 'raised' WHEN before = 0 THEN 'normal' END AS earlier
  FROM seen)""", select=f"""
SELECT sensor, type, window_start AS changed_at, now AS state, earlier AS previous FROM named WHERE now IS DISTINCT FROM earlier
UNION ALL
SELECT sensor, type, window_end + INTERVAL 150 MINUTE, 'stale', now FROM named
WHERE coalesce(next_end, (SELECT max(window_end) - INTERVAL 10 SECOND FROM status WHERE {_CLOSED})) - window_end > INTERVAL 150 MINUTE"""))
def stream_status_transitions(spark, sf):
    """Statistics arrive in three runs of two jobs: one that closes windows, one that follows their status."""
    base = scratch_path(spark, "transitions")
    for readings in _in_parts(spark, sf, f"{base}/in", 3):
        stats = jobs.hop_stats_stream(readings, _SHORT, i.SLIDE, DELAY)
        jobs.drain(jobs.to_parquet(stats, f"{base}/stats", f"{base}/checkpoint-1", (), "available"))
        table = spark.readStream.schema(stats.schema).parquet(f"{base}/stats")
        jobs.drain(jobs.publish_transitions(table, f"{base}/data", f"{base}/checkpoint-2", _STALE, DELAY, "available"))
    return i.plain_times(spark.read.schema(transitions.SCHEMA).parquet(f"{base}/data"))


def _tables(spark, sf):
    """The tables of one stateful query, after four runs of it."""
    base = scratch_path(spark, "tables")
    for readings in _in_parts(spark, sf, f"{base}/in", 4):
        stats = jobs.hop_stats_stream(readings, i.SIZE, i.SLIDE, DELAY)
        made = tables.WindowTables(spark, stats, f"{base}/out", every=3)
        jobs.drain(made.start(f"{base}/checkpoint", "available"))
    return made


@query("stream_table_windows", _HOP_SQL)
def stream_table_windows(spark, sf):
    kept = _tables(spark, sf).windows.read().drop("alerted", "new_alerts")
    return rounded(i.plain_times(kept), *DOUBLES)


@query("stream_table_alerts", with_ctes(i.EVENTS, select="SELECT sensor, window_start, window_end, type FROM raised"))
def stream_table_alerts(spark, sf):
    """Every alert once, however often its window was updated."""
    return i.plain_times(_tables(spark, sf).alerts.read()).select("sensor", "window_start", "window_end", "type")


_SLOW = [s.sensor for s in SENSORS if s.rate_hz < TOP_RATE_HZ]


@query("stream_carried", with_ctes(i.RIG, i.sync_cte(("avg",)), select=f"""
SELECT window_start, cycle, {r('"PS1_avg"')} AS "PS1_avg",
       {", ".join(f'{r(f"last_value({chr(34)}{s}_avg{chr(34)} IGNORE NULLS) OVER w")} AS "{s}_avg_interpolated"' for s in _SLOW)},
       {r('("PS1_avg" - lag("PS1_avg") OVER (PARTITION BY cycle ORDER BY window_start)) / 21600.0')} AS "PS1_avg_rate",
       {r('avg("PS1_avg") OVER (PARTITION BY cycle ORDER BY window_start ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')} AS "PS1_avg_rolling"
FROM sync WHERE {_CLOSED} WINDOW w AS (PARTITION BY cycle ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def stream_carried(spark, sf):
    """Fill, rate and rolling mean over five runs of a stream of window records."""
    base = scratch_path(spark, "carried")
    for readings in _in_parts(spark, sf, f"{base}/in", 5):
        wide = sync.sync_stream(jobs.watermarked(i.by_days(readings), DELAY), i.RIG_WIDTH, ("avg", "count"))
        wide = wide.select("window_start", "window_end", "cycle", *[f"{s}_avg" for s in SENSOR_NAMES])
        made = tables.CarriedColumns(spark, wide, f"{base}/out", ["cycle"], "window_start", [f"{s}_avg" for s in _SLOW], "PS1_avg",
                                     i.RIG_WIDTH.total_seconds(), every=3)
        jobs.drain(made.start(f"{base}/checkpoint", "available"))
    names = ["PS1_avg", *[f"{s}_avg_interpolated" for s in _SLOW], "PS1_avg_rate", "PS1_avg_rolling"]
    return rounded(i.plain_times(made.read()), *names).select("window_start", "cycle", *names)


@query("stream_metrics", with_ctes(i.READINGS, select="""
SELECT count(*) AS read, count(*) FILTER (WHERE "offset" % 10 < 7) AS valid, count(*) FILTER (WHERE "offset" % 10 >= 7) AS rejected,
       count(*) AS input_rows, 3::BIGINT AS batches
FROM readings"""))
def stream_metrics(spark, sf):
    """Counters of the raw archive over three runs, from the table that grows beside them."""
    base = scratch_path(spark, "metrics")
    recorder = progress.ProgressRecorder(spark, f"{base}/metrics", every=2)
    spark.streams.addListener(recorder)
    try:
        for readings in _in_parts(spark, sf, f"{base}/in", 3):
            raw, quarantine = jobs.archive_readings(i.messages_of(readings), f"{base}/raw", f"{base}/quarantine", f"{base}/checkpoints", "available")
            jobs.drain(raw, quarantine)
            recorder.wait(raw, quarantine)
    finally:
        spark.streams.removeListener(recorder)
    seen = spark.read.schema(progress.METRICS).parquet(f"{base}/metrics").where("read IS NOT NULL AND input_rows > 0")
    return seen.agg(*[F.sum(c).alias(c) for c in ("read", "valid", "rejected", "input_rows")], F.count(F.lit(1)).alias("batches"))
