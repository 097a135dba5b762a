"""Statistical outliers and early warnings."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.session import materialise


def zscores(df: DataFrame, column: str = "value", keys: tuple[str, ...] = ("sensor",),
            limit: float = 3.0) -> DataFrame:
    """Rows whose distance from the group mean exceeds ``limit`` deviations.

    Groups are reduced map-side to one row each and written, so their size is known to the join:
    few groups are broadcast and the rows are not shuffled. Rows with NULL keys form groups as well.
    """
    groups = materialise(df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")), "group-spread")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    scored = df.join(groups, on).withColumn(
        "zscore", (F.col(column) - F.col("_mean")) / F.when(F.col("_std") > 0, F.col("_std")))
    return scored.filter(F.abs("zscore") > limit).drop("_mean", "_std", *[f"_{k}" for k in keys])


def sudden_changes(df: DataFrame, rate: str, limit: float) -> DataFrame:
    return df.filter(F.abs(rate) > limit)


def early_warnings(stats: DataFrame, anomalies: DataFrame, slide: timedelta, ahead: int = 6,
                   factor: float = 2.0) -> DataFrame:
    """Windows with a spike in spread and whether an anomaly follows within ``ahead`` windows.

    A spike is a spread above ``factor`` times the sensor's mean spread. Each
    anomaly is projected back onto the windows before it, which turns the
    look-ahead into an equality join.
    """
    usual = materialise(stats.groupBy("sensor").agg(F.avg("stddev_value").alias("usual_stddev")), "usual-spread")
    spikes = (
        stats.join(usual, "sensor")
        .filter(F.col("stddev_value") > F.col("usual_stddev") * factor)
        .select("sensor", "window_start", "stddev_value", "usual_stddev")
    )
    warned = (
        anomalies.select("sensor", "window_start",
                         F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("windows_ahead"))
        .withColumn("window_start", F.col("window_start") - F.col("windows_ahead") * F.lit(slide))
        .groupBy("sensor", "window_start").agg(F.min("windows_ahead").alias("windows_ahead"))
    )
    return spikes.join(warned, ["sensor", "window_start"], "left").withColumn(
        "followed", F.col("windows_ahead").isNotNull())
