"""Time-window aggregation of sensor readings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.functions.columns import span

# The default windows.
HOP_SIZE = timedelta(minutes=1)
HOP_SLIDE = timedelta(seconds=10)
SYNC_WIDTH = timedelta(seconds=1)


def _flat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "avg_value", "max_value", "min_value", "stddev_value",
        (F.col("max_value") - F.col("min_value")).alias("range_value"),
        "sample_count",
    )


def hop_stats_direct(readings: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE,
                     keys: Sequence[str] = ("sensor",), time_col: str = "ts") -> DataFrame:
    """Statistics per hopping window in one aggregation.

    Works on streams. Every reading is copied into size/slide windows before
    the map-side aggregation; for large batches use :func:`hop_stats`.
    """
    grouped = readings.groupBy(F.window(time_col, span(size), span(slide)), *keys).agg(
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.stddev_samp("value").alias("stddev_value"),
        F.count("value").alias("sample_count"),
    )
    return _flat(grouped, keys)


def hop_stats(readings: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE,
              keys: Sequence[str] = ("sensor",), time_col: str = "ts") -> DataFrame:
    """Statistics per hopping window through slide-wide buckets.

    Readings are first reduced to one row per (bucket, key), map-side, so raw
    rows are never multiplied and a hot key shuffles one row per task and
    bucket. Each bucket row then joins its size/slide windows. Spread is
    merged from bucket means and squared deviations, which stays exact for
    large offsets.
    """
    hops, rest = divmod(size, slide)
    if rest or hops < 2:
        return hop_stats_direct(readings, size, slide, keys, time_col)

    buckets = readings.groupBy(F.window(time_col, span(slide)), *keys).agg(
        F.expr("count(value) AS n"),
        F.expr("avg(value) AS mean"),
        F.expr("var_pop(value) * count(value) AS m2"),
        F.expr("max(value) AS max_value"),
        F.expr("min(value) AS min_value"),
    )
    spread = buckets.select(
        *keys, "window", "n", "max_value", "min_value",
        F.expr("CASE WHEN n > 0 THEN struct(n, mean, m2) END AS part"),
        F.expr(f"explode(sequence(0, {hops - 1})) AS back"),
    ).withColumn("window_start", F.col("window.start") - F.col("back") * F.lit(slide))
    # At most size/slide parts per group; collect_list leaves out the NULLs.
    merged = spread.groupBy("window_start", *keys).agg(
        F.expr("max(max_value) AS max_value"),
        F.expr("min(min_value) AS min_value"),
        F.expr("sum(n) AS sample_count"),
        F.expr("collect_list(part) AS parts"),
    )
    return merged.withColumn(
        "avg_value", F.expr("aggregate(parts, 0D, (sum, p) -> sum + p.n * p.mean) / nullif(sample_count, 0)")
    ).withColumn(
        "m2", F.expr("aggregate(parts, 0D, (sum, p) -> sum + p.m2 + p.n * pow(p.mean - avg_value, 2))")
    ).select(
        *keys,
        "window_start",
        (F.col("window_start") + F.lit(size)).alias("window_end"),
        "avg_value", "max_value", "min_value",
        F.expr("CASE WHEN sample_count > 1 THEN sqrt(m2 / (sample_count - 1)) END AS stddev_value"),
        F.expr("max_value - min_value AS range_value"),
        "sample_count",
    )


def tumbling_stats(readings: DataFrame, width: timedelta = SYNC_WIDTH,
                   keys: Sequence[str] = ("cycle", "sensor"), time_col: str = "ts") -> DataFrame:
    """Statistics per tumbling window, with its first and last sample index.

    Samples are numbered in event-time order inside a cycle, so the ends are
    the smallest and largest index: deterministic, and a hash aggregation.
    """
    grouped = readings.groupBy(F.window(time_col, span(width)), *keys).agg(
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.stddev_samp("value").alias("stddev_value"),
        F.count("value").alias("sample_count"),
        F.min("sample_idx").alias("first_sample_idx"),
        F.max("sample_idx").alias("last_sample_idx"),
    )
    return grouped.select(
        *keys,
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "avg_value", "max_value", "min_value", "stddev_value", "sample_count",
        "first_sample_idx", "last_sample_idx",
    )


def window_samples(readings: DataFrame, width: timedelta = SYNC_WIDTH,
                   keys: Sequence[str] = ("cycle", "sensor"), time_col: str = "ts") -> DataFrame:
    """The samples of each tumbling window as an array ordered by sample index.

    An array holds the samples of one sensor in one window: sampling rate times width, once replays are dropped.
    """
    return (
        readings.groupBy(F.window(time_col, span(width)), *keys)
        .agg(F.sort_array(F.collect_list(F.struct("sample_idx", "value"))).alias("samples"))
        .select(*keys, F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), F.col("samples.value").alias("values"))
    )


def tumbling_record(readings: DataFrame, width: timedelta = SYNC_WIDTH,
                    keys: Sequence[str] = ("cycle", "sensor"), time_col: str = "ts") -> DataFrame:
    """Statistics per tumbling window with its samples in the same row."""
    samples = F.sort_array(F.collect_list(F.struct("sample_idx", "value"))).alias("samples")
    grouped = readings.groupBy(F.window(time_col, span(width)), *keys).agg(
        F.avg("value").alias("avg_value"), F.max("value").alias("max_value"), F.min("value").alias("min_value"),
        F.stddev_samp("value").alias("stddev_value"), F.count("value").alias("sample_count"), samples)
    return grouped.select(
        *keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "avg_value", "max_value", "min_value", "stddev_value", "sample_count", F.col("samples.value").alias("values"))
