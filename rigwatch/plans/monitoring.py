"""Window statistics, anomaly rules and dashboard queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.functions.columns import RAW_STALE_BANDS, fixed
from rigwatch.operators import monitoring as m
from rigwatch.operators import outliers, rules, windows
from rigwatch.operators.ordered import newest
from rigwatch.plans import inputs as i
from rigwatch.plans.inputs import r, with_ctes
from rigwatch.plans.registry import query
from rigwatch.schemas import TEMPERATURE
from rigwatch.session import materialise

DOUBLES = ("avg_value", "max_value", "min_value", "stddev_value", "range_value")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: fixed(c) for c in columns})


def stats(spark: SparkSession, sf: str) -> DataFrame:
    return windows.hop_stats(i.readings(spark, sf), i.SIZE, i.SLIDE)


_HOP_SELECT = "SELECT {keys}, window_start, window_end, " + ", ".join(
    f"{r(c)} AS {c}" for c in DOUBLES) + ", sample_count FROM hop"
_HOP_SQL = with_ctes(i.HOP, select=_HOP_SELECT.format(keys="sensor"))


@query("hop_window_stats", _HOP_SQL)
def hop_window_stats(spark, sf):
    return rounded(stats(spark, sf), *DOUBLES)


@query("hop_window_direct", _HOP_SQL)
def hop_window_direct(spark, sf):
    return rounded(windows.hop_stats_direct(i.readings(spark, sf), i.SIZE, i.SLIDE), *DOUBLES)


@query("hop_window_long", with_ctes(i.READINGS, i.hops(30, 3), select=_HOP_SELECT.format(keys="sensor")))
def hop_window_long(spark, sf):
    return rounded(windows.hop_stats(i.readings(spark, sf), timedelta(hours=30), timedelta(hours=3)), *DOUBLES)


@query("hop_window_per_cycle", with_ctes(i.READINGS, i.hops(keys="cycle, sensor"),
                                         select=_HOP_SELECT.format(keys="cycle, sensor")))
def hop_window_per_cycle(spark, sf):
    return rounded(windows.hop_stats(i.readings(spark, sf), i.SIZE, i.SLIDE, ("cycle", "sensor")), *DOUBLES)


# Rules ------------------------------------------------------------------

def events(spark, sf):
    return rules.anomaly_events(stats(spark, sf))


def status(spark, sf):
    return rules.anomaly_status(stats(spark, sf))


def health(spark, sf):
    return rules.sensor_health(stats(spark, sf))


@query("anomaly_events", with_ctes(i.EVENTS, select=f"""
SELECT sensor, window_start, window_end, type, {r('max_value')} AS max_value, {r('range_value')} AS range_value
FROM raised"""))
def anomaly_events(spark, sf):
    return rounded(events(spark, sf), "max_value", "range_value").select(
        "sensor", "window_start", "window_end", "type", "max_value", "range_value")


@query("anomaly_events_nominal", with_ctes(i.HOP, select="""
SELECT sensor, window_start, window_end, type FROM hop,
  (VALUES ('high_pressure'), ('pressure_spike'), ('high_temperature')) t(type)
WHERE (type = 'high_pressure' AND sensor LIKE 'PS%' AND avg_value > 160)
   OR (type = 'pressure_spike' AND sensor LIKE 'PS%' AND max_value > 180)
   OR (type = 'high_temperature' AND sensor LIKE 'TS%' AND avg_value > 60)"""))
def anomaly_events_nominal(spark, sf):
    return rules.anomaly_events(stats(spark, sf), rules.NOMINAL_RULES).select(
        "sensor", "window_start", "window_end", "type")


@query("anomaly_status", with_ctes(i.STATUS, select="SELECT * FROM status"))
def anomaly_status(spark, sf):
    return status(spark, sf)


@query("sensor_health", with_ctes(i.HEALTH, select="SELECT * FROM scores"))
def sensor_health(spark, sf):
    return health(spark, sf)


@query("overall_health", with_ctes(i.HEALTH, select=f"""
SELECT {r('health')} AS health,
       CASE WHEN health >= 90 THEN 'green' WHEN health >= 80 THEN 'orange' ELSE 'red' END AS status
FROM (SELECT coalesce(avg(h), 100.0) AS health
      FROM (SELECT sensor, max_by(health, window_end) AS h FROM scores GROUP BY sensor))"""))
def overall_health(spark, sf):
    return rounded(m.overall_health(health(spark, sf)), "health")


@query("active_anomalies", with_ctes(i.STATUS, select="""
SELECT active, CASE WHEN active >= 1 THEN 'red' ELSE 'green' END AS status
FROM (SELECT CAST(coalesce(sum(s), 0) AS BIGINT) AS active
      FROM (SELECT sensor, type, max_by(status, window_end) AS s FROM status GROUP BY sensor, type))"""))
def active_anomalies(spark, sf):
    return m.active_anomalies(status(spark, sf))


@query("anomaly_trend", with_ctes(i.STATUS, select="""
SELECT window_start, CAST(sum(status) AS BIGINT) AS active FROM status GROUP BY window_start"""))
def anomaly_trend(spark, sf):
    return m.anomaly_trend(status(spark, sf))


@query("anomaly_counters", with_ctes(i.EVENTS, select="""
SELECT sensor, type, count(*) AS total FROM raised GROUP BY sensor, type"""))
def anomaly_counters(spark, sf):
    return m.anomaly_counters(events(spark, sf))


@query("anomaly_by_type", with_ctes(i.EVENTS, select="SELECT type, count(*) AS total FROM raised GROUP BY type"))
def anomaly_by_type(spark, sf):
    return m.by_type(m.anomaly_counters(events(spark, sf)))


@query("top_offenders", with_ctes(i.EVENTS, select="""
SELECT sensor, count(*) AS total FROM raised GROUP BY sensor ORDER BY total DESC, sensor LIMIT 5"""))
def top_offenders(spark, sf):
    return m.top_offenders(m.anomaly_counters(events(spark, sf)))


@query("hourly_increase", with_ctes(i.EVENTS, select="""
SELECT count(*) AS total FROM raised
WHERE window_end > TIMESTAMP '2024-01-31' - INTERVAL 6 HOUR AND window_end <= TIMESTAMP '2024-01-31'"""))
def hourly_increase(spark, sf):
    return m.increase(events(spark, sf), i.AS_OF, timedelta(hours=6))


@query("state_timeline", with_ctes(i.STATUS, select="""
SELECT sensor, type, status, min(window_start) AS window_start, max(window_end) AS window_end, count(*) AS n_rows
FROM (SELECT *, sum(changed) OVER (PARTITION BY sensor, type ORDER BY window_start) AS run
      FROM (SELECT *, CASE WHEN status IS NOT DISTINCT FROM
                     lag(status) OVER (PARTITION BY sensor, type ORDER BY window_start) THEN 0 ELSE 1 END AS changed
            FROM status WHERE sensor LIKE 'PS%' AND type IN ('high_pressure', 'pressure_spike')))
GROUP BY sensor, type, run, status"""))
def state_timeline(spark, sf):
    return m.state_timeline(status(spark, sf), "PS.*", "high_pressure|pressure_spike")


@query("temperature_timeline", with_ctes(i.STATUS, select="""
SELECT sensor, type, status, min(window_start) AS window_start, max(window_end) AS window_end, count(*) AS n_rows
FROM (SELECT *, sum(changed) OVER (PARTITION BY sensor, type ORDER BY window_start) AS run
      FROM (SELECT *, CASE WHEN status IS NOT DISTINCT FROM
                     lag(status) OVER (PARTITION BY sensor, type ORDER BY window_start) THEN 0 ELSE 1 END AS changed
            FROM status WHERE sensor LIKE 'TS%' AND type = 'high_temperature'))
GROUP BY sensor, type, run, status"""))
def temperature_timeline(spark, sf):
    return m.state_timeline(status(spark, sf), "TS.*", "high_temperature")


@query("anomaly_by_hour", with_ctes(i.EVENTS, select="""
SELECT CAST(hour(window_start) AS INT) AS hour, type, count(*) AS total FROM raised GROUP BY 1, 2"""))
def anomaly_by_hour(spark, sf):
    return m.anomalies_by_hour(events(spark, sf))


@query("anomaly_by_day", with_ctes(i.EVENTS, """daily AS (
  SELECT date_trunc('day', window_start)::TIMESTAMP AS day, type, count(*) AS total FROM raised GROUP BY 1, 2)""", select="""
SELECT coalesce(d.day, b.day + INTERVAL 1 DAY) AS day, coalesce(d.type, b.type) AS type, coalesce(d.total, 0) AS total,
       coalesce(d.total, 0) - coalesce(b.total, 0) AS change
FROM daily d FULL JOIN daily b ON b.day = d.day - INTERVAL 1 DAY AND b.type = d.type"""))
def anomaly_by_day(spark, sf):
    return i.day_as_time(m.anomalies_by_day(events(spark, sf)))


@query("health_trend", with_ctes(i.HEALTH, select=f"""
SELECT date_trunc('day', window_start)::TIMESTAMP AS day, sensor, {r('avg(health)')} AS health, min(health) AS worst
FROM scores GROUP BY 1, 2"""))
def health_trend(spark, sf):
    return i.day_as_time(rounded(m.health_trend(health(spark, sf)), "health"))


_FACTORS = (0.8, 0.85, 0.9, 0.95, 1.0, 1.05, 1.1, 1.15, 1.2)


@query("threshold_tuning", with_ctes(i.READINGS, i.hops(keys="cycle, sensor"), i.LABELS, f"""
per_window AS (SELECT h.*, label_cooler = 100 AS healthy FROM hop h JOIN labelled USING (cycle)),
rule AS (SELECT * FROM (VALUES ('high_pressure', 'PS1', 300.0), ('high_temperature', 'TS1', 100.0),
                               ('pressure_spike', 'PS', 50.0)) r(type, stem, threshold)),
step AS (SELECT unnest([{', '.join(map(str, _FACTORS))}])::DOUBLE AS factor)""", select=f"""
SELECT type, factor, healthy_windows, false_alarms, fault_alarms,
       {r('false_alarms / nullif(healthy_windows, 0)')} AS false_alarm_rate
FROM (SELECT type, factor,
        count(*) FILTER (WHERE healthy) AS healthy_windows,
        count(*) FILTER (WHERE healthy AND fired) AS false_alarms,
        count(*) FILTER (WHERE NOT healthy AND fired) AS fault_alarms
      FROM (SELECT type, factor, healthy,
                   CASE WHEN type = 'pressure_spike' THEN range_value ELSE max_value END
                     > threshold::DOUBLE * factor AS fired
            FROM per_window JOIN rule ON starts_with(sensor, stem) CROSS JOIN step)
      GROUP BY type, factor)"""))
def threshold_tuning(spark, sf):
    per_cycle = windows.hop_stats(i.readings(spark, sf), i.SIZE, i.SLIDE, ("cycle", "sensor"))
    return rounded(rules.threshold_tuning(per_cycle, i.labels(spark, sf), factors=_FACTORS), "false_alarm_rate")


@query("early_warning", with_ctes(i.EVENTS, """
usual AS (SELECT sensor, avg(stddev_value) AS usual_stddev FROM hop GROUP BY sensor)""", select=f"""
SELECT h.sensor, h.window_start, {r('h.stddev_value')} AS stddev_value, {r('usual_stddev')} AS usual_stddev,
       CAST(coalesce(min(date_diff('hour', h.window_start, e.window_start)), 0) AS INT) AS windows_ahead,
       count(e.window_start) > 0 AS followed
FROM hop h JOIN usual USING (sensor)
LEFT JOIN raised e ON e.sensor = h.sensor AND e.window_start > h.window_start
                  AND e.window_start <= h.window_start + INTERVAL 6 HOUR
WHERE h.stddev_value > 2 * usual_stddev
GROUP BY h.sensor, h.window_start, h.stddev_value, usual_stddev"""))
def early_warning(spark, sf):
    s = materialise(stats(spark, sf), "stats")  # used three times below
    warned = outliers.early_warnings(s, rules.anomaly_events(s), i.SLIDE).na.fill(0, ["windows_ahead"])
    return rounded(warned, "stddev_value", "usual_stddev")


# Raw series and gauges ----------------------------------------------------

@query("latest_value", with_ctes(i.READINGS, select=f"""
SELECT sensor, ts, cycle, value FROM readings
QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY ts DESC, "offset" DESC) = 1"""))
def latest_value(spark, sf):
    return m.latest_value(i.readings(spark, sf))


@query("latest_window_stats", with_ctes(i.HOP, select=_HOP_SELECT.format(keys="sensor") + """
QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY window_end DESC) = 1"""))
def latest_window_stats(spark, sf):
    return rounded(m.latest_stats(stats(spark, sf)), *DOUBLES)


@query("sample_counts", with_ctes(i.READINGS, select="""
SELECT sensor, count(*) AS sample_count FROM readings GROUP BY sensor"""))
def sample_counts(spark, sf):
    return m.sample_counts(i.readings(spark, sf))


def _totals_sql(source: str, time: str, steps: tuple[int, int]) -> str:
    return f"""
SELECT messages, last_update, {r('age')} AS seconds_ago,
       CASE WHEN age >= {steps[1]} THEN 'red' WHEN age >= {steps[0]} THEN 'orange' ELSE 'green' END AS status
FROM (SELECT count(*) AS messages, max({time}) AS last_update,
             epoch_us(TIMESTAMP '2024-01-31') / 1e6 - epoch_us(max({time})) / 1e6 AS age FROM {source})"""


@query("message_totals", with_ctes(i.READINGS, select=_totals_sql("readings", "ts", (5, 30))))
def message_totals(spark, sf):
    return rounded(m.totals(i.readings(spark, sf), i.AS_OF, bands=RAW_STALE_BANDS), "seconds_ago")


@query("analytics_totals", with_ctes(i.HOP, select=_totals_sql("hop", "window_start", (10, 30))))
def analytics_totals(spark, sf):
    return rounded(m.totals(stats(spark, sf), i.AS_OF, "window_start"), "seconds_ago")


def _counted(columns: str, count: str) -> str:
    """Counts per hour, and all hours from the first to the last one."""
    return f"""counted AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, {columns} {count} AS n FROM readings GROUP BY ALL),
hours AS (SELECT unnest(generate_series(min(window_start), max(window_start), INTERVAL 1 HOUR)) AS window_start FROM counted)"""


@query("message_rate", with_ctes(i.READINGS, _counted("", "count(*)"), select=f"""
SELECT window_start, messages, {r('messages / 3600.0')} AS per_second,
       CASE WHEN messages / 3600.0 >= 1 THEN 'green' ELSE 'red' END AS status
FROM (SELECT window_start, coalesce(n, 0) AS messages FROM hours LEFT JOIN counted USING (window_start))"""))
def message_rate(spark, sf):
    return rounded(m.message_rate(i.readings(spark, sf), timedelta(hours=1)), "per_second")


@query("recent_range", with_ctes(i.READINGS, select="""
SELECT sensor, cycle, ts, value, "offset" FROM readings
WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 5 DAY AND ts <= TIMESTAMP '2024-01-31'"""))
def recent_range(spark, sf):
    return m.since(i.readings(spark, sf), i.AS_OF, timedelta(days=5)).select("sensor", "cycle", "ts", "value", "offset")


@query("family_series", with_ctes(i.READINGS, select="""
SELECT sensor, CASE WHEN sensor LIKE 'TS%' THEN 'temperature' ELSE 'flow' END AS family, ts, value, "offset"
FROM readings WHERE sensor LIKE 'TS%' OR sensor LIKE 'FS%'"""))
def family_series(spark, sf):
    return m.family_series(i.readings(spark, sf), ["temperature", "flow"]).select(
        "sensor", "family", "ts", "value", "offset")


@query("sensor_selection", with_ctes(i.READINGS, select="""
SELECT sensor, ts, value, "offset" FROM readings WHERE regexp_full_match(sensor, 'PS[12]|CE|SE')"""))
def sensor_selection(spark, sf):
    return i.readings(spark, sf).filter(rules.matches("PS[12]|CE|SE")).select("sensor", "ts", "value", "offset")


@query("heatmap", with_ctes(i.READINGS, select="""
SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS window_start, sensor,
       CAST(floor(value / 10) * 10 AS DOUBLE) AS bucket_start, count(*) AS n
FROM readings WHERE sensor IN ('PS1', 'PS2', 'PS3', 'PS4') GROUP BY 1, 2, 3"""))
def heatmap(spark, sf):
    chosen = i.readings(spark, sf).filter(F.col("sensor").isin("PS1", "PS2", "PS3", "PS4"))
    return m.heatmap(chosen, timedelta(hours=1))


@query("smooth_heatmap", with_ctes(i.HOP, select="""
SELECT time_bucket(INTERVAL 3 HOUR, window_end, TIMESTAMP '1970-01-01') AS window_start, sensor,
       CAST(floor(avg_value / 10) * 10 AS DOUBLE) AS bucket_start, count(*) AS n
FROM hop WHERE sensor = 'PS1' GROUP BY 1, 2, 3"""))
def smooth_heatmap(spark, sf):
    ps1 = windows.hop_stats(i.readings(spark, sf).filter("sensor = 'PS1'"), i.SIZE, i.SLIDE)
    return m.heatmap(ps1, timedelta(hours=3), time_col="window_end", value="avg_value")


@query("completeness", with_ctes(i.READINGS, _counted("sensor,", "count(value)"), f"""sent AS (
  SELECT h.window_start, s.sensor, coalesce(n, 0) AS received
  FROM hours h CROSS JOIN (SELECT unnest([{i._NAMES}]) AS sensor) s
  LEFT JOIN counted c ON c.window_start = h.window_start AND c.sensor = s.sensor)""", select=f"""
SELECT window_start, sensor, received, expected, {r('received / expected', 9)} AS completeness
FROM (SELECT *, CAST(CASE WHEN sensor LIKE 'PS%' OR sensor = 'EPS1' THEN 100 WHEN sensor LIKE 'FS%' THEN 10 ELSE 1 END * 3600 AS BIGINT) AS expected
      FROM sent)"""))
def completeness(spark, sf):
    return m.completeness(i.readings(spark, sf), timedelta(hours=1)).withColumn(
        "completeness", fixed("completeness", 9))


@query("raw_vs_smooth", with_ctes(i.HOP, select=f"""
SELECT r.sensor, r.ts, r."offset", r.value, b AS smooth_end, {r('h.avg_value')} AS smooth_value
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS b FROM readings WHERE sensor = 'PS1') r
LEFT JOIN hop h ON h.sensor = r.sensor AND h.window_end = r.b"""))
def raw_vs_smooth(spark, sf):
    ps1 = i.readings(spark, sf).filter("sensor = 'PS1'")
    joined = m.raw_vs_smooth(ps1, windows.hop_stats(ps1, i.SIZE, i.SLIDE), i.SLIDE)
    return rounded(joined, "smooth_value").select("sensor", "ts", "offset", "value", "smooth_end", "smooth_value")


@query("volatility_band", with_ctes(i.HOP, select=f"""
SELECT sensor, window_start, min_value, {r('avg_value')} AS avg_value, max_value FROM hop WHERE sensor LIKE 'PS%'"""))
def volatility_band(spark, sf):
    return rounded(m.volatility_band(stats(spark, sf)), "avg_value")


@query("stability", with_ctes(i.HOP, select=f"""
SELECT sensor, window_start, {r('stddev_value')} AS stddev_value FROM hop"""))
def stability(spark, sf):
    return rounded(m.stability(stats(spark, sf)), "stddev_value")


@query("range_series", with_ctes(i.HOP, select=f"""
SELECT sensor, window_start, {r('max_value - min_value')} AS volatility FROM hop WHERE sensor IN ('PS1', 'PS2')"""))
def range_series(spark, sf):
    return rounded(m.range_series(stats(spark, sf), ["PS1", "PS2"]), "volatility")


@query("power_vs_flow", with_ctes(i.HOP, select=f"""
SELECT window_start, {r("max(avg_value) FILTER (WHERE sensor = 'EPS1')")} AS motor_power,
       {r("max(avg_value * 100) FILTER (WHERE sensor = 'FS1')")} AS flow_x100
FROM hop WHERE sensor IN ('EPS1', 'FS1') GROUP BY window_start"""))
def power_vs_flow(spark, sf):
    return rounded(m.side_by_side(stats(spark, sf), {"motor_power": ("EPS1", 1), "flow_x100": ("FS1", 100)}),
                   "motor_power", "flow_x100")


@query("temperature_vs_cooling", with_ctes(i.HOP, select=f"""
SELECT window_start, {r("max(avg_value) FILTER (WHERE sensor = 'TS1')")} AS oil_temperature,
       {r("max(avg_value) FILTER (WHERE sensor = 'CE')")} AS cooling_efficiency
FROM hop WHERE sensor IN ('TS1', 'CE') GROUP BY window_start"""))
def temperature_vs_cooling(spark, sf):
    return rounded(m.side_by_side(stats(spark, sf), {"oil_temperature": ("TS1", 1), "cooling_efficiency": ("CE", 1)}),
                   "oil_temperature", "cooling_efficiency")


@query("family_spread", with_ctes(i.HOP, select=f"""
SELECT window_start, family, sensors, {r('spread')} AS spread
FROM (SELECT window_start, family, count(*) AS sensors, max(avg_value) - min(avg_value) AS spread
      FROM (SELECT *, CASE WHEN sensor LIKE 'PS%' THEN 'pressure' WHEN sensor LIKE 'TS%' THEN 'temperature'
                           WHEN sensor LIKE 'FS%' THEN 'flow' WHEN sensor IN ('CE', 'CP', 'SE') THEN 'virtual'
                           WHEN sensor = 'VS1' THEN 'vibration' ELSE 'power' END AS family FROM hop)
      GROUP BY 1, 2) WHERE sensors > 1"""))
def family_spread(spark, sf):
    return rounded(m.family_spread(stats(spark, sf)), "spread")


_VITAL = """CASE WHEN current >= 180 THEN 'red' WHEN current >= 150 THEN 'orange' ELSE 'green' END AS status"""


@query("vitals_raw", with_ctes(i.READINGS, select=f"""
SELECT sensor, current, {_VITAL} FROM (
  SELECT sensor, max_by(value, struct_pack(t := ts, o := "offset")) AS current FROM readings
  WHERE sensor IN ('PS1', 'TS1', 'FS1', 'EPS1', 'TS2', 'TS3', 'TS4') GROUP BY sensor)"""))
def vitals_raw(spark, sf):
    return m.vitals(m.latest_value(i.readings(spark, sf)), ["PS1", "FS1", "EPS1", *TEMPERATURE], "value")


@query("vitals_smooth", with_ctes(i.HOP, select=f"""
SELECT sensor, {r('current')} AS current, {_VITAL} FROM (
  SELECT sensor, max_by(avg_value, window_end) AS current FROM hop WHERE sensor IN ('PS1', 'TS1') GROUP BY sensor)"""))
def vitals_smooth(spark, sf):
    return rounded(m.vitals(m.latest_stats(stats(spark, sf)), ["PS1", "TS1"], "avg_value"), "current")


@query("newest_records", with_ctes(i.READINGS, select="""
SELECT sensor, cycle, ts, value, "offset" FROM readings ORDER BY ts DESC, "offset" DESC LIMIT 2"""))
def newest_records(spark, sf):
    return newest(i.readings(spark, sf), ["ts", "offset"]).select("sensor", "cycle", "ts", "value", "offset")


@query("row_counts", with_ctes(i.READINGS, i.LABELS, select="""
SELECT 'readings' AS source, count(*) AS n FROM readings UNION ALL SELECT 'labels', count(*) FROM labelled"""))
def row_counts(spark, sf):
    def count(df, name):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n")
    return count(i.readings(spark, sf), "readings").unionByName(count(i.labels(spark, sf), "labels"))


@query("zscore_outliers", with_ctes(i.READINGS, """
spread AS (SELECT sensor, avg(value) AS mean, stddev_samp(value) AS std FROM readings GROUP BY sensor)""", select=f"""
SELECT sensor, cycle, ts, "offset", value, {r('(value - mean) / std')} AS zscore
FROM readings JOIN spread USING (sensor) WHERE abs((value - mean) / std) > 3"""))
def zscore_outliers(spark, sf):
    return rounded(outliers.zscores(i.readings(spark, sf)), "zscore").select(
        "sensor", "cycle", "ts", "offset", "value", "zscore")


