"""Synchronised records, derived features and ordered operators."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.functions.columns import fixed, mean_of, sample_time, second_in_cycle
from rigwatch.operators import features, monitoring, ordered, outliers, rules, sync, windows
from rigwatch.plans import inputs as i
from rigwatch.plans.inputs import r, with_ctes
from rigwatch.plans.monitoring import rounded
from rigwatch.plans.registry import query
from rigwatch.schemas import PRESSURE, SENSOR_NAMES, SENSORS, TOP_RATE_HZ
from rigwatch.session import materialise

BUCKET = "time_bucket(INTERVAL {h} HOUR, ts, TIMESTAMP '1970-01-01')"


@query("tumbling_stats", with_ctes(i.INDEXED, select=f"""
SELECT cycle, sensor, window_start, window_start + INTERVAL 1 HOUR AS window_end,
       {r('avg_value')} AS avg_value, max_value, min_value, {r('stddev_value')} AS stddev_value,
       sample_count, first_sample_idx, last_sample_idx
FROM (SELECT cycle, sensor, {BUCKET.format(h=1)} AS window_start, avg(value) AS avg_value, max(value) AS max_value,
             min(value) AS min_value, stddev_samp(value) AS stddev_value, count(value) AS sample_count,
             min(sample_idx) AS first_sample_idx, max(sample_idx) AS last_sample_idx
      FROM indexed GROUP BY ALL)"""))
def tumbling_stats(spark, sf):
    return rounded(windows.tumbling_stats(i.indexed_readings(spark, sf), i.WIDTH), "avg_value", "stddev_value")


@query("window_samples", with_ctes(i.INDEXED, select=f"""
SELECT cycle, sensor, {BUCKET.format(h=240)} AS window_start, {BUCKET.format(h=240)} + INTERVAL 240 HOUR AS window_end,
       string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY sample_idx) AS samples
FROM indexed GROUP BY ALL"""))
def window_samples(spark, sf):
    arrays = windows.window_samples(i.indexed_readings(spark, sf), timedelta(hours=240))
    cents = F.transform("values", lambda v: F.round(v * 100).cast("long").cast("string"))
    return arrays.withColumn("samples", F.array_join(cents, ",")).drop("values")


@query("tumbling_record", with_ctes(i.INDEXED, select=f"""
SELECT cycle, sensor, {BUCKET.format(h=240)} AS window_start, {BUCKET.format(h=240)} + INTERVAL 240 HOUR AS window_end,
       {r('avg(value)')} AS avg_value, max(value) AS max_value, min(value) AS min_value,
       {r('stddev_samp(value)')} AS stddev_value, count(value) AS sample_count,
       string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY sample_idx) AS samples
FROM indexed GROUP BY ALL"""))
def tumbling_record(spark, sf):
    record = windows.tumbling_record(i.indexed_readings(spark, sf), timedelta(hours=240))
    cents = F.transform("values", lambda v: F.round(v * 100).cast("long").cast("string"))
    return rounded(record.withColumn("samples", F.array_join(cents, ",")).drop("values"), "avg_value", "stddev_value")


def _sync(spark: SparkSession, sf: str, **options) -> DataFrame:
    return sync.sync_table(i.rig_readings(spark, sf), i.RIG_WIDTH, **options)


_SYNC_COLUMNS = [f"{s}_{k}" for s in SENSOR_NAMES for k in sync.STATS]


@query("sync_seconds", with_ctes(i.RIG, i.sync_cte(), select="SELECT window_start, window_end, cycle, " + ", ".join(
    f'{r(chr(34) + c + chr(34))} AS "{c}"' for c in _SYNC_COLUMNS) + " FROM sync"))
def sync_seconds(spark, sf):
    return rounded(_sync(spark, sf).withColumns(
        {f"{s}_count": F.col(f"{s}_count").cast("double") for s in SENSOR_NAMES}), *_SYNC_COLUMNS)


_RIG_INDEXED = i.RIG + """,
indexed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cycle, sensor ORDER BY ts, "offset") - 1 AS INT) AS sample_idx
  FROM readings)"""
_RECORD = (_RIG_INDEXED, i.sync_cte(), f"""
arrays AS (
  SELECT {BUCKET.format(h=6)} AS window_start, cycle, CAST(min(sample_idx // sampling_rate_hz) AS INT) AS second_in_cycle,
         {", ".join(f"""string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY sample_idx)
           FILTER (WHERE sensor = '{s}') AS "{s}_values" """ for s in SENSOR_NAMES)}
  FROM indexed GROUP BY ALL)""", i.family_cte().replace("FROM sync", "FROM sync JOIN arrays USING (window_start, cycle)"))


@query("sync_record", with_ctes(*_RECORD, select="SELECT window_start, window_end, cycle, second_in_cycle, "
       + ", ".join(f"""coalesce("{s}_values", '') AS "{s}_values", """ + ", ".join(
           f'{r(chr(34) + s + "_" + k + chr(34))} AS "{s}_{k}"' for k in ("avg", "min", "max", "std"))
           + f', coalesce("{s}_count", 0) AS "{s}_count"' for s in SENSOR_NAMES)
       + f""", {r('pressure_mean')} AS pressure_mean,
  {r('(pressure_mean - lag(pressure_mean) OVER (PARTITION BY cycle ORDER BY window_start)) / 21600.0')} AS pressure_rate_of_change
FROM family"""))
def sync_record(spark, sf):
    """Sample arrays of all sensors side by side, with their statistics and the change of the pressure mean."""
    indexed = ordered.with_index(i.rig_readings(spark, sf), ["cycle", "sensor"], "ts", "offset")
    record = materialise(sync.sync_record(indexed, i.RIG_WIDTH).withColumn("pressure_mean", mean_of([f"{p}_avg" for p in PRESSURE])), "records")
    # The change needs three columns only; it comes back to the wide rows by their key.
    rates = materialise(ordered.rate_of_change(record.select("window_start", "cycle", "pressure_mean"), ["cycle"], "window_start",
                                               "pressure_mean", "pressure_rate_of_change", i.RIG_WIDTH.total_seconds(), i.BLOCK)
                        .select("window_start", "cycle", "pressure_rate_of_change"), "rates")
    cents = {f"{s}_values": F.array_join(F.transform(f"{s}_values", lambda v: F.round(v * 100).cast("long").cast("string")), ",")
             for s in SENSOR_NAMES}
    whole = record.join(rates, ["window_start", "cycle"]).withColumns(cents)
    whole = whole.withColumns({f"{s}_count": F.col(f"{s}_count").cast("long") for s in SENSOR_NAMES})
    return rounded(whole, "pressure_mean", "pressure_rate_of_change",
                   *[f"{s}_{k}" for s in SENSOR_NAMES for k in ("avg", "min", "max", "std")])


_OTHERS = [s for s in SENSOR_NAMES if s != "PS1"]


@query("aligned_sensors", with_ctes(i.RIG, *[f"""
{s.lower()} AS (SELECT cycle, ts, max_by(value, "offset") AS "{s}" FROM readings WHERE sensor = '{s}' GROUP BY cycle, ts)""" for s in _OTHERS],
    select='SELECT b.cycle, b.ts, b."offset", b.value AS "PS1", ' + ", ".join(f'{s.lower()}."{s}"' for s in _OTHERS)
    + " FROM (SELECT * FROM readings WHERE sensor = 'PS1') b "
    + " ".join(f"ASOF LEFT JOIN {s.lower()} ON b.cycle = {s.lower()}.cycle AND b.ts >= {s.lower()}.ts" for s in _OTHERS)))
def aligned_sensors(spark, sf):
    """Each reading of the first pressure sensor beside what all others showed at that time."""
    return sync.aligned(i.rig_readings(spark, sf), "PS1", _OTHERS, block=i.BLOCK)


def _families(spark: SparkSession, sf: str, where: str = "true") -> DataFrame:
    readings = i.rig_readings(spark, sf).where(where)
    return features.family_features(sync.sync_table(readings, i.RIG_WIDTH, stats=("avg", "min", "max", "std")))


_FAMILY = (i.RIG, i.sync_cte(("avg", "min", "max", "std")), i.family_cte())
_FAMILY_COLUMNS = ["pressure_mean", "pressure_std", "temperature_mean", "flow_mean", "pressure_range"]


@query("family_features", with_ctes(*_FAMILY, select="SELECT window_start, cycle, " + ", ".join(
    f"{r(c)} AS {c}" for c in _FAMILY_COLUMNS) + " FROM family"))
def family_features(spark, sf):
    return rounded(_families(spark, sf), *_FAMILY_COLUMNS).select("window_start", "cycle", *_FAMILY_COLUMNS)


_CROSS = ["pressure_temperature_ratio", "flow_pressure_product", "efficiency_index", "hydraulic_efficiency"]


@query("cross_features", with_ctes(*_FAMILY, select=f"""
SELECT window_start, cycle, {r('pressure_mean / (temperature_mean + 1e-6)')} AS pressure_temperature_ratio,
       {r('flow_mean * pressure_mean')} AS flow_pressure_product,
       {r('"SE_avg" * "CE_avg" / 100.0')} AS efficiency_index,
       {r('flow_mean * pressure_mean * 1.6667 / nullif("EPS1_avg", 0)')} AS hydraulic_efficiency
FROM family"""))
def cross_features(spark, sf):
    return rounded(features.cross_features(_families(spark, sf), 1.6667), *_CROSS).select(
        "window_start", "cycle", *_CROSS)


@query("wide_anomalies", with_ctes(*_FAMILY, select=f"""
SELECT window_start, cycle, {r('"PS1_avg"')} AS "PS1_avg", {r('temperature_mean')} AS temperature_mean,
       {r('pressure_range')} AS pressure_range,
       CASE WHEN "PS1_avg" > 300 THEN 'high_pressure' WHEN temperature_mean > 100 THEN 'high_temperature'
            ELSE 'pressure_range_anomaly' END AS anomaly_type
FROM family WHERE "PS1_avg" > 300 OR temperature_mean > 100 OR pressure_range > 50"""))
def wide_anomalies(spark, sf):
    found = rules.wide_anomalies(_families(spark, sf))
    return rounded(found, "PS1_avg", "temperature_mean", "pressure_range").select(
        "window_start", "cycle", "PS1_avg", "temperature_mean", "pressure_range", "anomaly_type")


_SLOW = [s.sensor for s in SENSORS if s.rate_hz < TOP_RATE_HZ]


@query("forward_fill", with_ctes(i.RIG, i.sync_cte(("avg",), hours=1), select=f"""
SELECT window_start, cycle, {r('"PS1_avg"')} AS "PS1_avg",
       {", ".join(f'{r(f"last_value({chr(34)}{s}_avg{chr(34)} IGNORE NULLS) OVER w")} AS "{s}_avg_interpolated"' for s in _SLOW)}
FROM sync WINDOW w AS (PARTITION BY cycle ORDER BY window_start
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def forward_fill(spark, sf):
    """All slow sensors filled up to the fast ones."""
    wide = materialise(sync.sync_table(i.rig_readings(spark, sf), timedelta(hours=1), ("avg",)), "seconds")
    filled = ordered.forward_fill(wide, ["cycle"], "window_start", [f"{s}_avg" for s in _SLOW], block=i.BLOCK)
    names = ["PS1_avg", *[f"{s}_avg_interpolated" for s in _SLOW]]
    return rounded(filled, *names).select("window_start", "cycle", *names)


_RATE = "(pressure_mean - lag(pressure_mean) OVER (PARTITION BY cycle ORDER BY window_start))"


@query("rate_of_change", with_ctes(*_FAMILY, select=f"""
SELECT window_start, cycle, {r('pressure_mean')} AS pressure_mean, {r(_RATE + ' / 21600.0')} AS pressure_rate_of_change
FROM family"""))
def rate_of_change(spark, sf):
    base = _families(spark, sf).select("window_start", "cycle", "pressure_mean")
    rated = ordered.rate_of_change(base, ["cycle"], "window_start", "pressure_mean", "pressure_rate_of_change",
                                   seconds=i.RIG_WIDTH.total_seconds(), block=i.BLOCK)
    return rounded(rated, "pressure_mean", "pressure_rate_of_change")


@query("sudden_changes", with_ctes(*_FAMILY, select=f"""
SELECT window_start, cycle, {r('change')} AS change
FROM (SELECT window_start, cycle, {_RATE} AS change FROM family) WHERE abs(change) > 20"""))
def sudden_changes(spark, sf):
    base = _families(spark, sf).select("window_start", "cycle", "pressure_mean")
    rated = ordered.rate_of_change(base, ["cycle"], "window_start", "pressure_mean", "change", block=i.BLOCK)
    return rounded(outliers.sudden_changes(rated, "change", 20.0), "change").select("window_start", "cycle", "change")


@query("rolling_mean", with_ctes(*_FAMILY, select=f"""
SELECT window_start, cycle, {r('pressure_mean')} AS pressure_mean,
       {r('avg(pressure_mean) OVER (PARTITION BY cycle ORDER BY window_start ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)')}
         AS pressure_rolling_mean
FROM family"""))
def rolling_mean(spark, sf):
    base = _families(spark, sf).select("window_start", "cycle", "pressure_mean")
    rolled = ordered.rolling_mean(base, ["cycle"], "window_start", "pressure_mean", "pressure_rolling_mean", 6, i.BLOCK)
    return rounded(rolled, "pressure_mean", "pressure_rolling_mean")


_PAIRS = [("PS1_avg", "TS1_avg"), ("VS1_avg", "TS1_avg"), ("EPS1_avg", "FS1_avg")]


@query("sensor_corr", with_ctes(i.RIG, i.sync_cte(("avg",)), select="SELECT cycle, " + ", ".join(
    f'{r(f"""corr("{a}", "{b}")""")} AS "corr_{a}_{b}"' for a, b in _PAIRS) + " FROM sync GROUP BY cycle"))
def sensor_corr(spark, sf):
    names = [f"corr_{a}_{b}" for a, b in _PAIRS]
    return rounded(monitoring.correlations(_sync(spark, sf, stats=("avg",)), _PAIRS, ["cycle"]), *names)


@query("sensor_pair_corr", with_ctes(i.RIG, i.sync_cte(("avg",)), select=" UNION ALL ".join(f"""
SELECT cycle, '{a}_avg' AS a, '{b}_avg' AS b, {r(f'corr("{a}_avg", "{b}_avg")')} AS correlation, count(*) FILTER (WHERE "{a}_avg" + "{b}_avg" IS NOT NULL) AS n
FROM sync GROUP BY cycle""" for k, a in enumerate(SENSOR_NAMES) for b in SENSOR_NAMES[k + 1:])))
def sensor_pair_corr(spark, sf):
    """All pairs of sensors, per cycle."""
    return rounded(monitoring.pair_correlations(_sync(spark, sf, stats=("avg",)), [f"{s}_avg" for s in SENSOR_NAMES], ["cycle"]), "correlation")


@query("outer_join_sensors", with_ctes(i.RIG, *[f"""
{s.lower()} AS (SELECT {BUCKET.format(h=1)} AS window_start, cycle, avg(value) AS "{s}_avg" FROM readings
       WHERE sensor = '{s}' GROUP BY ALL)""" for s in SENSOR_NAMES], select="SELECT window_start, cycle, "
       + ", ".join(f'{r(chr(34) + s + "_avg" + chr(34))} AS "{s}_avg"' for s in SENSOR_NAMES)
       + f" FROM {SENSOR_NAMES[0].lower()} " + " ".join(f"FULL JOIN {s.lower()} USING (window_start, cycle)" for s in SENSOR_NAMES[1:])))
def outer_join_sensors(spark, sf):
    each = materialise(windows.hop_stats(i.rig_readings(spark, sf), i.WIDTH, i.WIDTH, ("cycle", "sensor")), "stats")
    frames = [each.filter(F.col("sensor") == s).select("window_start", "cycle", F.col("avg_value").alias(f"{s}_avg"))
              for s in SENSOR_NAMES]
    return rounded(sync.join_sensor_windows(frames), *[f"{s}_avg" for s in SENSOR_NAMES])


@query("union_pivot", with_ctes(i.RIG, i.sync_cte(("avg",), hours=6), select="SELECT window_start, window_end, cycle, "
       + ", ".join(f'{r(chr(34) + s + "_avg" + chr(34))} AS "{s}_avg"' for s in SENSOR_NAMES) + " FROM sync"))
def union_pivot(spark, sf):
    # Separate sources become one scan: the folders differ, the table is read once.
    wide = sync.sync_table(i.rig_readings(spark, sf).filter(F.col("sampling_rate_hz").isin(100, 10, 1)), i.RIG_WIDTH, ("avg",))
    return rounded(wide, *[f"{s}_avg" for s in SENSOR_NAMES])


_TICKS = """ticks AS (
  SELECT cycle, sensor, value, sample_idx * f + k AS tick
  FROM (SELECT *, 100 // sampling_rate_hz AS f FROM indexed), range(100) t(k) WHERE k < f)"""


@query("upsample", with_ctes(i.INDEXED, _TICKS, select=f"""
SELECT cycle, sensor, count(*) AS ticks, CAST(min(tick) AS INT) AS first_tick, CAST(max(tick) AS INT) AS last_tick,
       {r('sum(value)', 4)} AS total, {r('sum(value * tick)', 2)} AS weighted
FROM ticks GROUP BY cycle, sensor"""))
def upsample(spark, sf):
    return sync.upsample(i.indexed_readings(spark, sf)).groupBy("cycle", "sensor").agg(
        F.count(F.lit(1)).alias("ticks"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"),
        fixed(F.sum("value"), 4).alias("total"), fixed(F.sum(F.col("value") * F.col("tick")), 2).alias("weighted"))


@query("wide_matrix", with_ctes(i.INDEXED, _TICKS, select="SELECT cycle + 1 AS profile_id, count(DISTINCT tick) AS ticks, "
       + ", ".join(f"""count(*) FILTER (WHERE sensor = '{s}') AS "{s}_ticks",
         {r(f"sum(value) FILTER (WHERE sensor = '{s}')", 4)} AS "{s}_total" """ for s in SENSOR_NAMES)
       + " FROM ticks GROUP BY cycle"))
def wide_matrix(spark, sf):
    wide = sync.wide_ticks(i.indexed_readings(spark, sf))
    return wide.groupBy("profile_id").agg(
        F.count(F.lit(1)).alias("ticks"),
        *[c for s in SENSOR_NAMES
          for c in (F.count(s).alias(f"{s}_ticks"), fixed(F.sum(s), 4).alias(f"{s}_total"))])


@query("sample_times", with_ctes(i.INDEXED, select="""
SELECT cycle, sensor, sample_idx,
       TIMESTAMP '2024-01-01' + to_microseconds(cycle::BIGINT * 60000000 + sample_idx::BIGINT * (1000000 // sampling_rate_hz)) AS event_time,
       CAST(sample_idx // sampling_rate_hz AS INT) AS second_in_cycle
FROM indexed"""))
def sample_times(spark, sf):
    base = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.col("cycle") * F.lit(timedelta(seconds=60))
    return i.indexed_readings(spark, sf).select(
        "cycle", "sensor", "sample_idx",
        sample_time(base, F.col("sample_idx"), F.col("sampling_rate_hz")).cast("timestamp_ntz").alias("event_time"),
        second_in_cycle(F.col("sample_idx"), F.col("sampling_rate_hz")).alias("second_in_cycle"))
