"""Anomaly rules and health scores over window statistics.

Rules are data: a rule set is a list of :class:`Rule`, turned into column
expressions that run inside the scan's projection, without a join.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigwatch.schemas import HEALTHY_CODES


class Rule(NamedTuple):
    type: str
    sensors: str  # regular expression that must match the whole sensor name
    metric: str
    threshold: float
    penalty: int


# The default rules.
DEFAULT_RULES = [
    Rule("high_pressure", "PS1", "max_value", 300.0, 20),
    Rule("high_temperature", "TS1", "max_value", 100.0, 20),
    Rule("pressure_spike", "PS.*", "range_value", 50.0, 10),
]
# The alternative thresholds for operation near nominal load.
NOMINAL_RULES = [
    Rule("high_pressure", "PS.*", "avg_value", 160.0, 20),
    Rule("pressure_spike", "PS.*", "max_value", 180.0, 10),
    Rule("high_temperature", "TS.*", "avg_value", 60.0, 20),
]
# The status series kept per sensor group.
STATUS_SERIES = [
    ("PS.*", "high_pressure"),
    ("PS.*", "pressure_spike"),
    ("TS.*", "high_temperature"),
]
# Thresholds of the detector over synchronised records.
WIDE_PRESSURE_MAX = 300.0
WIDE_TEMPERATURE_MAX = 100.0
WIDE_PRESSURE_RANGE = 50.0


def matches(pattern: str, column: str = "sensor") -> Column:
    """Whole-name match of a label pattern; plain names and prefixes avoid the regex engine."""
    stem = pattern[:-2] if pattern.endswith(".*") else pattern
    if stem.isalnum():
        col = F.col(column)
        return col.startswith(stem) if pattern.endswith(".*") else col == stem
    return F.col(column).rlike(f"^(?:{pattern})$")


def fires(rule: Rule) -> Column:
    return matches(rule.sensors) & (F.col(rule.metric) > F.lit(rule.threshold))


def fired_types(rules: list[Rule] = DEFAULT_RULES) -> Column:
    """Array of the anomaly types a statistics row raises."""
    return F.array_compact(F.array(*[F.when(fires(r), F.lit(r.type)) for r in rules]))


def health_score(rules: list[Rule] = DEFAULT_RULES) -> Column:
    """100 minus the penalty of every rule that fires, at least 0."""
    lost = F.lit(0)
    for rule in rules:
        lost = lost + F.when(fires(rule), F.lit(rule.penalty)).otherwise(F.lit(0))
    return F.greatest(F.lit(0), F.lit(100) - lost)


def anomaly_events(stats: DataFrame, rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    """One row per window, sensor and anomaly type raised."""
    return stats.select("*", F.explode(fired_types(rules)).alias("type"))


def anomaly_status(stats: DataFrame, rules: list[Rule] = DEFAULT_RULES,
                   series: list[tuple[str, str]] = STATUS_SERIES) -> DataFrame:
    """Status 0 or 1 of every series a sensor has, per window."""
    relevant = F.array_compact(F.array(*[F.when(matches(p), F.lit(t)) for p, t in series]))
    return (
        stats.select("sensor", "window_start", "window_end",
                     fired_types(rules).alias("_fired"), F.explode(relevant).alias("type"))
        .withColumn("status", F.array_contains("_fired", F.col("type")).cast("int"))
        .drop("_fired")
    )


def sensor_health(stats: DataFrame, rules: list[Rule] = DEFAULT_RULES) -> DataFrame:
    """Health score per window and sensor."""
    return stats.select("sensor", "window_start", "window_end", health_score(rules).alias("health"))


def wide_anomalies(features: DataFrame) -> DataFrame:
    """Anomalies in synchronised records; the first matching kind names the row."""
    pressure = F.col("PS1_avg") > WIDE_PRESSURE_MAX
    temperature = F.col("temperature_mean") > WIDE_TEMPERATURE_MAX
    return features.filter(
        pressure | temperature | (F.col("pressure_range") > WIDE_PRESSURE_RANGE)
    ).withColumn(
        "anomaly_type",
        F.when(pressure, "high_pressure").when(temperature, "high_temperature")
        .otherwise("pressure_range_anomaly"))


def threshold_tuning(stats: DataFrame, labels: DataFrame, target: str = "label_cooler",
                     rules: list[Rule] = DEFAULT_RULES,
                     factors: tuple[float, ...] = (0.8, 0.85, 0.9, 0.95, 1.0, 1.05, 1.1, 1.15, 1.2),
                     ) -> DataFrame:
    """False alarms of every rule with its threshold moved in steps.

    ``stats`` are windows per sensor and cycle; a window of a cycle whose
    ``target`` is at the healthy code should stay silent. Each window is
    reduced to the number of steps it exceeds, so the counts stay tiny
    whatever the number of windows, rules and steps.
    """
    steps = sorted(factors)
    exceeded = [
        F.when(matches(r.sensors), F.struct(F.lit(r.type).alias("type"), F.expr(
            " + ".join(f"IF({r.metric} > {r.threshold}D * {f}D, 1, 0)" for f in steps)).alias("level")))
        for r in rules
    ]
    # Counted per cycle first, so the join meets a few rows per cycle and a busy cycle is no heavier than others.
    per_cycle = (stats.select("cycle", F.inline(F.array_compact(F.array(*exceeded))))
                 .groupBy("cycle", "type", "level").agg(F.count(F.lit(1)).alias("n")))
    counts = (
        per_cycle.join(labels.select("cycle", (F.col(target) == HEALTHY_CODES[target]).alias("healthy")), "cycle")
        .groupBy("type", "level", "healthy").agg(F.sum("n").alias("n"))
    )
    # One row per rule and step even when no window belongs to the rule.
    none = stats.sparkSession.createDataFrame(
        [(r.type, 0, True, 0) for r in rules], "type string, level int, healthy boolean, n long")
    per_step = F.array(*[F.struct(F.lit(f).alias("factor"), (F.col("level") > n).alias("fired")) for n, f in enumerate(steps)])
    return (
        counts.unionByName(none).select("type", "healthy", "n", F.inline(per_step))
        .groupBy("type", "factor").agg(
            F.sum(F.when(F.col("healthy"), F.col("n")).otherwise(0)).alias("healthy_windows"),
            F.sum(F.when(F.col("healthy") & F.col("fired"), F.col("n")).otherwise(0)).alias("false_alarms"),
            F.sum(F.when(~F.col("healthy") & F.col("fired"), F.col("n")).otherwise(0)).alias("fault_alarms"))
        .withColumn("false_alarm_rate",
                    F.col("false_alarms") / F.when(F.col("healthy_windows") > 0, F.col("healthy_windows")))
    )
