"""The questions an operator dashboard asks, over readings, window statistics and status."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.functions.columns import (
    ACTIVE_BANDS, ALIVE_BANDS, ANALYTICS_STALE_BANDS, HEALTH_BANDS, VITAL_BANDS, band, micros, span,
)
from rigwatch.operators.ordered import latest_by, merge_runs, newest_first
from rigwatch.operators.rules import matches
from rigwatch.schemas import SENSOR_NAMES, family_of, rate_of


GRID_ROWS = 10_000  # windows of a grid that are made from one row


# Readings ---------------------------------------------------------------

def gauges(readings: DataFrame, time_col: str = "ts", tie: str = "offset") -> DataFrame:
    """Last reading and sample count of each sensor, in one read and one hash aggregation."""
    newest = newest_first(time_col, tie)
    return readings.groupBy("sensor").agg(
        *[F.max_by(c, newest).alias(c) for c in (time_col, "cycle", "value")], F.count(F.lit(1)).alias("samples"))


def latest_value(readings: DataFrame, time_col: str = "ts", tie: str = "offset") -> DataFrame:
    """Last reading of each sensor by event time."""
    return gauges(readings, time_col, tie).drop("samples")


def sample_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("sensor").agg(F.count(F.lit(1)).alias("sample_count"))


def totals(df: DataFrame, as_of: datetime, time_col: str = "ts", keys: Sequence[str] = (),
           bands: list = ANALYTICS_STALE_BANDS) -> DataFrame:
    """Message total, time of the last one and its age at ``as_of``."""
    age = (micros(F.lit(as_of)) - micros(F.col("last_update"))) / 1_000_000.0
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("messages"), F.max(time_col).alias("last_update"))
        .withColumn("seconds_ago", age)
        .withColumn("status", band("seconds_ago", bands))
    )


def _windows(counts: DataFrame, width: timedelta, start: str = "window_start") -> DataFrame:
    """All windows from the first to the last one in ``counts``, made in blocks that tasks share: an early stray stamp stretches the grid."""
    step = round(width.total_seconds() * 1_000_000)
    ends = counts.agg(F.min(start).alias("_first"), F.max(start).alias("_last")).filter("_first IS NOT NULL")
    total = F.floor((micros(F.col("_last")) - micros(F.col("_first"))) / F.lit(step))
    blocks = ends.select("_first", total.alias("_total"), F.explode(F.sequence(F.lit(0).cast("long"), F.floor(total / GRID_ROWS))).alias("_block"))
    number = F.explode(F.sequence(F.col("_block") * GRID_ROWS, F.least("_total", F.col("_block") * GRID_ROWS + (GRID_ROWS - 1)))).alias("_n")
    return blocks.repartition("_block").select("_first", number).select((F.col("_first") + F.col("_n") * F.lit(width)).alias(start))


def message_rate(df: DataFrame, width: timedelta = timedelta(minutes=1), time_col: str = "ts") -> DataFrame:
    """Messages per second in tumbling windows (exact counts, no extrapolation), silent windows as 0."""
    counts = (df.groupBy(F.window(time_col, span(width))).agg(F.count(F.lit(1)).alias("messages"))
              .select(F.col("window.start").alias("window_start"), "messages"))
    return (
        _windows(counts, width).join(counts, "window_start", "left").na.fill(0, ["messages"])
        .withColumn("per_second", F.col("messages") / width.total_seconds())
        .withColumn("status", band("per_second", ALIVE_BANDS))
    )


def since(df: DataFrame, as_of: datetime, back: timedelta, time_col: str = "ts") -> DataFrame:
    """Rows in the time range (as_of - back, as_of]; constant bounds reach the scan."""
    return df.filter((F.col(time_col) > F.lit(as_of - back)) & (F.col(time_col) <= F.lit(as_of)))


def family_series(readings: DataFrame, families: Sequence[str]) -> DataFrame:
    """Raw series of whole sensor families."""
    return readings.withColumn("family", family_of("sensor")).filter(F.col("family").isin(list(families)))


def heatmap(df: DataFrame, width: timedelta = timedelta(seconds=10), bucket: float = 10.0,
            time_col: str = "ts", value: str = "value", keys: Sequence[str] = ("sensor",)) -> DataFrame:
    """Number of values per time bucket and value bucket."""
    return (
        df.groupBy(F.window(time_col, span(width)), *keys,
                   (F.floor(F.col(value) / bucket) * bucket).cast("double").alias("bucket_start"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), *keys, "bucket_start", "n")
    )


def completeness(readings: DataFrame, width: timedelta = timedelta(minutes=1), time_col: str = "ts") -> DataFrame:
    """Received against expected samples (rate times window length); a silent sensor has received 0.

    The grid has a row per window and known sensor; sensors that are not known are kept with what they sent.
    """
    counts = (readings.groupBy(F.window(time_col, span(width)), "sensor").agg(F.count("value").alias("received"))
              .select(F.col("window.start").alias("window_start"), "sensor", "received"))
    grid = _windows(counts, width).select("window_start", F.explode(F.array(*[F.lit(s) for s in SENSOR_NAMES])).alias("sensor"))
    return (
        grid.join(counts, ["window_start", "sensor"], "full_outer").na.fill(0, ["received"])
        .withColumn("expected", (rate_of("sensor") * F.lit(width.total_seconds())).cast("long"))
        .withColumn("completeness", F.col("received") / F.col("expected"))
    )


def raw_vs_smooth(readings: DataFrame, stats: DataFrame, slide: timedelta, time_col: str = "ts") -> DataFrame:
    """Each reading beside the newest window mean closed at its time.

    The last closed window ends at the reading's slide bucket, so the as-of
    lookup is an equality join that skew handling can split.
    """
    closed = stats.select("sensor", F.col("window_end").alias("_bucket"), F.col("avg_value").alias("smooth_value"))
    return (
        readings.withColumn("_bucket", F.window(time_col, span(slide)).start)
        .join(closed, ["sensor", "_bucket"], "left")
        .withColumnRenamed("_bucket", "smooth_end")
    )


# Window statistics --------------------------------------------------------

def latest_stats(stats: DataFrame) -> DataFrame:
    """Statistics of the last window per sensor."""
    columns = [c for c in stats.columns if c != "sensor"]
    return latest_by(stats, ["sensor"], F.col("window_end"), columns)


def volatility_band(stats: DataFrame, sensors: str = "PS.*") -> DataFrame:
    return stats.filter(matches(sensors)).select(
        "sensor", "window_start", "min_value", "avg_value", "max_value")


def stability(stats: DataFrame, sensors: str = ".*") -> DataFrame:
    chosen = stats if sensors == ".*" else stats.filter(matches(sensors))
    return chosen.select("sensor", "window_start", "stddev_value")


def range_series(stats: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Maximum minus minimum of the chosen sensors; both come from one row, so nothing is joined."""
    return stats.filter(F.col("sensor").isin(list(sensors))).select(
        "sensor", "window_start", (F.col("max_value") - F.col("min_value")).alias("volatility"))


def subtract_series(left: DataFrame, right: DataFrame, on: Sequence[str] = ("sensor", "window_start")) -> DataFrame:
    """Difference of two separately kept series (column ``value``), matched one to one."""
    a = left.select(*on, F.col("value").alias("_left"))
    b = right.select(*on, F.col("value").alias("_right"))
    return a.join(b, list(on)).select(*on, (F.col("_left") - F.col("_right")).alias("value"))


def side_by_side(stats: DataFrame, series: dict[str, tuple[str, float]]) -> DataFrame:
    """Window means of several sensors in one row: name -> (sensor, scale factor)."""
    wanted = sorted({sensor for sensor, _ in series.values()})
    cells = [
        F.max(F.when(F.col("sensor") == sensor, F.col("avg_value") * F.lit(float(scale)))).alias(name)
        for name, (sensor, scale) in series.items()
    ]
    return stats.filter(F.col("sensor").isin(wanted)).groupBy("window_start").agg(*cells)


def family_spread(stats: DataFrame) -> DataFrame:
    """Spread of the window means inside each sensor family with more than one member."""
    return (
        stats.withColumn("family", family_of("sensor"))
        .groupBy("window_start", "family")
        .agg(F.count(F.lit(1)).alias("sensors"),
             (F.max("avg_value") - F.min("avg_value")).alias("spread"))
        .filter("sensors > 1")
    )


def correlations(sync: DataFrame, pairs: Sequence[tuple[str, str]], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of column pairs, per key group, one column per pair."""
    return sync.groupBy(*keys).agg(*[F.corr(a, b).alias(f"corr_{a}_{b}") for a, b in pairs])


def pair_correlations(sync: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair of columns, per key group: a row per pair, with the rows that have both.

    Each row gives its pairs to one aggregation, whose buffers (count, means, squared deviations and the cross
    product) are merged map-side: keys times pairs rows are shuffled, and the plan has one aggregate for any number of columns.
    """
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
             for n, a in enumerate(columns) for b in columns[n + 1:]]
    return (sync.select(*keys, F.inline(F.array(*pairs))).groupBy(*keys, "a", "b")
            .agg(F.corr("x", "y").alias("correlation"), F.count(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)).alias("n")))


def vitals(latest: DataFrame, sensors: Sequence[str], value: str) -> DataFrame:
    """Current value and colour of the chosen sensors."""
    return latest.filter(F.col("sensor").isin(list(sensors))).select(
        "sensor", F.col(value).alias("current"), band(value, VITAL_BANDS).alias("status"))


# Status, health and counters ----------------------------------------------

def overall_health(health: DataFrame) -> DataFrame:
    """Mean of the current sensor scores, 100 when there is none."""
    current = latest_by(health, ["sensor"], F.col("window_end"), ["health"])
    return current.agg(F.coalesce(F.avg("health"), F.lit(100.0)).alias("health")).withColumn(
        "status", band("health", HEALTH_BANDS))


def active_anomalies(status: DataFrame) -> DataFrame:
    """Number of status series that are 1 now, 0 when there is none."""
    current = latest_by(status, ["sensor", "type"], F.col("window_end"), ["status"])
    return current.agg(F.coalesce(F.sum("status"), F.lit(0)).cast("long").alias("active")).withColumn(
        "status", band("active", ACTIVE_BANDS))


def anomaly_trend(status: DataFrame) -> DataFrame:
    return status.groupBy("window_start").agg(F.sum("status").cast("long").alias("active"))


def anomaly_counters(events: DataFrame) -> DataFrame:
    """Distinct windows raised per sensor and type; independent of how often results are emitted."""
    windows = events.groupBy("sensor", "type", "window_start").agg(F.count(F.lit(1)).alias("emitted"))
    return windows.groupBy("sensor", "type").agg(F.count(F.lit(1)).alias("total"))


def by_type(counters: DataFrame) -> DataFrame:
    return counters.groupBy("type").agg(F.sum("total").alias("total"))


def top_offenders(counters: DataFrame, n: int = 5) -> DataFrame:
    return counters.groupBy("sensor").agg(F.sum("total").alias("total")).orderBy(
        F.col("total").desc(), "sensor").limit(n)


def increase(events: DataFrame, as_of: datetime, back: timedelta = timedelta(hours=1)) -> DataFrame:
    """Anomalies in the trailing interval, by window end (exact count)."""
    return since(events, as_of, back, "window_end").agg(F.count(F.lit(1)).alias("total"))


def state_timeline(status: DataFrame, sensors: str, types: str, block: timedelta = timedelta(days=1)) -> DataFrame:
    """Intervals of unchanged status per sensor and type."""
    chosen = status.filter(matches(sensors) & matches(types, "type"))
    return merge_runs(chosen, ["sensor", "type"], "window_start", "window_end", "status", block)


def anomalies_by_hour(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("window_start").alias("hour"), "type").agg(F.count(F.lit(1)).alias("total"))


def anomalies_by_day(events: DataFrame) -> DataFrame:
    """Daily totals with the change to the day before; a day after one with anomalies is there, if only with 0."""
    daily = events.groupBy(F.to_date("window_start").alias("day"), "type").agg(F.count(F.lit(1)).alias("total"))
    # Every total counts for its own day and against the next one.
    both = daily.select(F.explode(F.array(
        F.struct("day", "type", "total", F.lit(0).cast("long").alias("before")),
        F.struct(F.date_add("day", 1).alias("day"), "type", F.lit(0).cast("long").alias("total"), F.col("total").alias("before")))).alias("d"))
    return both.select("d.*").groupBy("day", "type").agg(F.sum("total").alias("total"), (F.sum("total") - F.sum("before")).alias("change"))


def health_trend(health: DataFrame) -> DataFrame:
    """Daily mean health per sensor."""
    return health.groupBy(F.to_date("window_start").alias("day"), "sensor").agg(
        F.avg("health").alias("health"), F.min("health").alias("worst"))


