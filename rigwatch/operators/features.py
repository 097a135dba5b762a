"""Per-second and per-cycle features, and their join with condition labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.functions.columns import guarded_ratio, mean_of, pooled_std
from rigwatch.operators.ordered import latest_by, with_index
from rigwatch.schemas import FLOW, LABEL_NAMES, PRESSURE, SENSOR_NAMES, TEMPERATURE


def family_features(sync: DataFrame) -> DataFrame:
    """Pressure, temperature and flow means, pooled pressure spread and PS1 range."""
    return sync.withColumns({
        "pressure_mean": mean_of(f"{s}_avg" for s in PRESSURE),
        "pressure_std": pooled_std(f"{s}_std" for s in PRESSURE),
        "temperature_mean": mean_of(f"{s}_avg" for s in TEMPERATURE),
        "flow_mean": mean_of(f"{s}_avg" for s in FLOW),
        "pressure_range": F.col("PS1_max") - F.col("PS1_min"),
    })


def cross_features(features: DataFrame, conversion: float = 1.0) -> DataFrame:
    """Ratios and products between sensor families; ``conversion`` scales the hydraulic power."""
    return features.withColumns({
        "pressure_temperature_ratio": guarded_ratio(F.col("pressure_mean"), F.col("temperature_mean")),
        "flow_pressure_product": F.col("flow_mean") * F.col("pressure_mean"),
        "efficiency_index": F.col("SE_avg") * F.col("CE_avg") / 100.0,
        "hydraulic_efficiency":
            F.col("flow_mean") * F.col("pressure_mean") * F.lit(float(conversion))
            / F.when(F.col("EPS1_avg") != 0, F.col("EPS1_avg")),
    })


def cycle_stats(readings: DataFrame) -> DataFrame:
    """Mean and sample deviation per cycle and sensor."""
    return readings.groupBy("cycle", "sensor").agg(
        F.avg("value").alias("mean_val"), F.stddev_samp("value").alias("std_val"))


def cycle_features(readings: DataFrame, sensors: Sequence[str] = SENSOR_NAMES) -> DataFrame:
    """One row per cycle with ``<sensor>_mean`` and ``<sensor>_std``."""
    return (
        readings.filter(F.col("sensor").isin(list(sensors)))
        .groupBy("cycle").pivot("sensor", list(sensors))
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    )


def cycle_rollup(features: DataFrame, sensors: Sequence[str] = SENSOR_NAMES) -> DataFrame:
    """Roll synchronised seconds up to one row per cycle."""
    cells = []
    for s in sensors:
        cells += [F.expr(text) for text in (
            f"avg({s}_avg) AS {s}_mean", f"stddev_samp({s}_avg) AS {s}_std",
            f"min({s}_min) AS {s}_min", f"max({s}_max) AS {s}_max")]
    return features.groupBy("cycle").agg(
        *cells,
        F.avg("pressure_mean").alias("pressure_mean"), F.stddev_samp("pressure_mean").alias("pressure_std"),
        F.avg("temperature_mean").alias("temperature_mean"), F.avg("flow_mean").alias("flow_mean"),
        F.count(F.lit(1)).alias("second_count"))


def cycle_ratios(rollup: DataFrame) -> DataFrame:
    """Ranges and ratios of a cycle row."""
    return rollup.withColumns({
        "pressure_range": F.col("PS1_max") - F.col("PS1_min"),
        "temperature_range": F.col("TS1_max") - F.col("TS1_min"),
        "pressure_variability": guarded_ratio(F.col("PS1_std"), F.col("PS1_mean")),
        "flow_pressure_ratio": guarded_ratio(F.col("FS1_mean"), F.col("pressure_mean")),
    })


def newest_labels(labels: DataFrame, order: str = "timestamp") -> DataFrame:
    """One label row per cycle, the newest; repeated deliveries cannot multiply a join."""
    return latest_by(labels, ["cycle"], F.col(order), [c for c in labels.columns if c != "cycle"])


def join_labels(features: DataFrame, labels: DataFrame, how: str = "inner", fill: bool = False) -> DataFrame:
    """Join cycle features with labels; ``fill`` turns NULL numbers into 0.

    No broadcast hint: labels grow with the number of cycles, and the
    optimiser broadcasts them itself while they are small.
    """
    joined = features.join(labels, "cycle", how)
    return joined.na.fill(0) if fill else joined


# Columns that give the cooler condition away.
LEAKAGE = ["CE_mean", "CE_std", "CP_mean", "CP_std"]
NOT_FEATURES = ["cycle", "timestamp", "kafka_timestamp", *LABEL_NAMES, *LEAKAGE]


def feature_columns(df: DataFrame) -> list[str]:
    """Columns a model may see: everything but ids, labels and leakage."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def missing_flags(features: DataFrame, sensors: Sequence[str] = SENSOR_NAMES) -> DataFrame:
    """Add ``<sensor>_missing`` before NULLs are filled, so 0 stays distinct from absent."""
    return features.withColumns({f"{s}_missing": F.col(f"{s}_mean").isNull().cast("int") for s in sensors})


def summarise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum of every column, one row per column."""
    rows = [
        F.expr(f"struct('{c}' AS column, count(v) AS n, avg(v) AS mean, stddev_samp(v) AS stddev, min(v) AS min, max(v) AS max)"
               .replace("(v)", f"(CAST(`{c}` AS DOUBLE))"))
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def quartiles(df: DataFrame, columns: Sequence[str], points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles of every column, interpolated between neighbours, one row per column; NULLs are left out.

    Values are range-partitioned by (column, value) and numbered over the ranges, so no buffer or task holds
    a column; the rows at the two ranks around each point are picked by their number.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.inline(cells)).where("value IS NOT NULL").withColumn("_row", F.monotonically_increasing_id())
    placed = with_index(long, ["column"], "value", "_row", "_at", "long")
    sizes = placed.groupBy("column").agg(F.count(F.lit(1)).alias("n"))  # a row per column
    at = {p: F.lit(float(p)) * (F.col("n") - 1) for p in points}
    picked = placed.join(sizes, "column").groupBy("column", "n").agg(*[
        F.max(F.when(F.col("_at") == rank(at[p]), F.col("value"))).alias(f"_{k}_{p}")
        for p in points for k, rank in (("low", F.floor), ("high", F.ceil))])
    return picked.select("column", "n", *[
        (F.col(f"`_low_{p}`") + (F.col(f"`_high_{p}`") - F.col(f"`_low_{p}`")) * (at[p] - F.floor(at[p]))).alias(f"q{round(p * 100)}")
        for p in points])


def cycle_change(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Difference of each column to the previous cycle number, NULL where that cycle is absent.

    Every row is also sent to the cycle after it, where the two meet in one
    aggregation: the input is read once and nothing is sorted as a whole.
    """
    now = F.struct(F.col("cycle"), F.lit(True).alias("_own"), *columns)
    ahead = F.struct((F.col("cycle") + 1).alias("cycle"), F.lit(False).alias("_own"), *columns)
    cells = [F.bool_or("_own").alias("_own")]
    for c in columns:
        cells += [F.max(F.when(F.col("_own"), F.col(c))).alias(c), F.max(F.when(~F.col("_own"), F.col(c))).alias(f"_{c}")]
    return (
        features.select(F.inline(F.array(now, ahead))).groupBy("cycle").agg(*cells).filter("_own")
        .select("cycle", *columns, *[(F.col(c) - F.col(f"_{c}")).alias(f"{c}_change") for c in columns])
    )
