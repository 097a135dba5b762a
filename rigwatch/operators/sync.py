"""Synchronisation of sensors with different rates into wide records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rigwatch.functions.columns import span
from rigwatch.operators.ordered import DAY, forward_fill, newest_first
from rigwatch.operators.windows import SYNC_WIDTH
from rigwatch.schemas import SENSOR_NAMES, SENSORS, TOP_RATE_HZ, rate_of

STATS = ("avg", "min", "max", "std", "count")


AGGREGATES = {"avg": "avg", "min": "min", "max": "max", "std": "stddev_samp", "count": "count"}


def sync_table(readings: DataFrame, width: timedelta = SYNC_WIDTH, stats: Sequence[str] = STATS,
               sensors: Sequence[str] = SENSOR_NAMES, time_col: str = "ts",
               keys: Sequence[str] = ("cycle",)) -> DataFrame:
    """One wide row per time window and cycle with ``<sensor>_<stat>`` columns.

    The pivot has a declared value list, so no job looks for the sensors, and
    it plans a per-sensor aggregation before the wide one: readings are
    reduced map-side to one row per window, cycle and sensor.
    """
    return (
        readings.filter(F.col("sensor").isin(list(sensors)))
        .groupBy(F.window(time_col, span(width)).alias("window"), *keys)
        .pivot("sensor", list(sensors))
        .agg(*[F.expr(f"{AGGREGATES[s]}(value) AS {s}") for s in stats])
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                *keys, *_names(sensors, stats))
    )


def _names(sensors: Sequence[str], stats: Sequence[str]) -> list[str]:
    # One aggregate alone would be named after the sensor only; see the alias below.
    return [f"{s}_{stat}" for s in sensors for stat in stats] if len(stats) > 1 else [
        F.col(s).alias(f"{s}_{stats[0]}") for s in sensors]


def sync_stream(readings: DataFrame, width: timedelta = SYNC_WIDTH, stats: Sequence[str] = ("avg", "min", "max"),
                sensors: Sequence[str] = SENSOR_NAMES, time_col: str = "ts") -> DataFrame:
    """The same record as one conditional aggregation, for streams of any output mode."""
    cells = [
        F.expr(f"{AGGREGATES[stat]}(CASE WHEN sensor = '{s}' THEN value END) AS {s}_{stat}")
        for s in sensors for stat in stats
    ]
    return (
        readings.groupBy(F.window(time_col, span(width)).alias("window"), "cycle").agg(*cells)
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                "cycle", *[f"{s}_{stat}" for s in sensors for stat in stats])
    )


def join_sensor_windows(frames: Sequence[DataFrame], on: Sequence[str] = ("window_start", "cycle")) -> DataFrame:
    """Full outer join of per-sensor frames, one row per key each, on the shared columns.

    The frames are laid side by side in one aggregation: one shuffle, however many sensors. A NULL
    key meets NULL keys of the other frames.
    """
    columns = [c for f in frames for c in f.columns if c not in on]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return together.groupBy(*on).agg(*[F.max(c).alias(c) for c in columns])


def join_sensor_streams(readings: DataFrame, width: timedelta = SYNC_WIDTH, sensors: Sequence[str] = SENSOR_NAMES,
                        time_col: str = "ts", keys: Sequence[str] = ("cycle",)) -> DataFrame:
    """Window means of separate streams, one per sampling rate, in full outer stream-stream joins on (window, keys).

    ``readings`` carry a watermark: state holds the windows that are still open, and a window without a partner is given
    out when the watermark has passed it. Means are made before the joins, so a join sees a row per window and key.
    """
    rates = {s.sensor: s.rate_hz for s in SENSORS}
    window = F.window(time_col, span(width))
    frames = []
    for rate in sorted({rates[s] for s in sensors}, reverse=True):
        names = [s for s in sensors if rates[s] == rate]
        cells = [F.expr(f"avg(CASE WHEN sensor = '{s}' THEN value END) AS {s}_avg") for s in names]
        frames.append(readings.filter(F.col("sensor").isin(names)).groupBy(window, *keys).agg(*cells))
    joined = reduce(lambda a, b: a.join(b, ["window", *keys], "full_outer"), frames)
    return joined.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
                         *[f"{s}_avg" for s in sensors])


def sync_record(readings: DataFrame, width: timedelta = SYNC_WIDTH, sensors: Sequence[str] = SENSOR_NAMES,
                time_col: str = "ts", keys: Sequence[str] = ("cycle",)) -> DataFrame:
    """One wide row per time window and key: the samples of every sensor as an ordered array beside its statistics.

    One shuffle: a group's samples are collected once, sorted by sensor and index, and laid side by side by array
    expressions. A group holds what all sensors send in one window. ``second_in_cycle`` is that of the earliest
    sample; a sensor without samples has an empty array, NULL statistics and count 0; the spread of one sample is NULL.
    """
    second = F.floor(F.col("sample_idx") / rate_of("sensor")).cast("int")
    grouped = (
        readings.filter(F.col("sensor").isin(list(sensors)))
        .groupBy(F.window(time_col, span(width)).alias("window"), *keys)
        .agg(F.min(second).alias("second_in_cycle"),
             F.sort_array(F.collect_list(F.struct("sensor", "sample_idx", "value"))).alias("_samples"))
    )
    cells = grouped.withColumns({
        f"{s}_values": F.expr(f"transform(filter(_samples, x -> x.sensor = '{s}'), x -> x.value)") for s in sensors})
    stats = {}
    for s in sensors:
        stats |= {
            f"{s}_avg": F.expr(f"aggregate({s}_values, 0D, (a, x) -> a + x) / nullif(size({s}_values), 0)"),
            f"{s}_min": F.array_min(f"{s}_values"), f"{s}_max": F.array_max(f"{s}_values"),
            f"{s}_count": F.size(f"{s}_values"),
        }
    spreads = {f"{s}_std": F.expr(
        f"CASE WHEN {s}_count > 1 THEN sqrt(aggregate({s}_values, 0D, (a, x) -> a + pow(x - {s}_avg, 2)) / ({s}_count - 1)) END")
        for s in sensors}
    return cells.withColumns(stats).withColumns(spreads).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "second_in_cycle",
        *[f"{s}_{part}" for s in sensors for part in ("values", *STATS)])


def aligned(readings: DataFrame, base: str, others: Sequence[str], keys: Sequence[str] = ("cycle",), time_col: str = "ts",
            tie: str = "offset", block: timedelta = DAY) -> DataFrame:
    """Every reading of ``base`` beside the last value of each other sensor at or before its time.

    Of readings of one sensor at one time the one with the largest ``tie`` counts. All series are laid into one table with
    a row per key and time, in which values are carried forward from time block to time block; no range join.
    """
    carried = [f"_{s}" for s in others]
    newest = newest_first(time_col, tie)
    points = readings.filter(F.col("sensor").isin([base, *others])).groupBy(*keys, time_col).agg(
        *[F.max_by("value", F.when(F.col("sensor") == s, newest)).alias(c) for s, c in zip(others, carried)])
    filled = forward_fill(points, keys, time_col, carried, "_at", block).select(
        *[F.col(k).alias(f"_key_{k}") for k in [*keys, time_col]], *[F.col(f"{c}_at").alias(s) for s, c in zip(others, carried)])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in [*keys, time_col]])
    return (readings.filter(F.col("sensor") == base).withColumnRenamed("value", base).join(filled, on)
            .select(*keys, time_col, tie, base, *others))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of separate sources in one frame, by column name."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def upsample(readings: DataFrame) -> DataFrame:
    """Repeat slow samples up to the highest rate: tick = index * factor + k; samples of unknown sensors stay as they are."""
    factor = F.coalesce((F.lit(TOP_RATE_HZ) / rate_of("sensor")).cast("int"), F.lit(1))
    return (
        readings.withColumn("_factor", factor)
        .withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_factor") - 1)))
        .withColumn("tick", F.col("sample_idx") * F.col("_factor") + F.col("_k"))
        .drop("_factor", "_k")
    )


def wide_ticks(readings: DataFrame, sensors: Sequence[str] = SENSOR_NAMES, id_offset: int = 1) -> DataFrame:
    """One row per cycle and tick with a column per sensor; ids start at ``id_offset``.

    Samples are shuffled once, by cycle and second, before slow ones are
    repeated. A second's samples are put into a list, and its ticks are made
    from that one after the other: no table of ticks is held.
    """
    second = F.floor(F.col("sample_idx") / rate_of("sensor"))
    placed = (
        readings.filter(F.col("sensor").isin(list(sensors)))
        .select("cycle", "sensor", "sample_idx", "value", second.alias("_second"),
                F.coalesce((F.lit(TOP_RATE_HZ) / rate_of("sensor")).cast("int"), F.lit(1)).alias("_factor"))
        .withColumn("_from", F.col("sample_idx") * F.col("_factor"))
        .repartition("cycle", "_second")
    )
    seconds = placed.groupBy("cycle", "_second").agg(F.collect_list(F.struct("sensor", "_from", "_factor", "value")).alias("_samples"))
    own = seconds.select("cycle", *[F.expr(f"filter(_samples, x -> x.sensor = '{s}')").alias(f"_{s}") for s in sensors], F.explode(F.expr(
        "array_distinct(flatten(transform(_samples, x -> coalesce(sequence(x._from, x._from + x._factor - 1), array(x._from)))))")).alias("tick"))
    covers = "x -> (tick >= x._from AND tick < x._from + x._factor) OR (tick IS NULL AND x._from IS NULL)"
    cells = [F.expr(f"array_max(transform(filter(_{s}, {covers}), x -> x.value))").alias(s) for s in sensors]
    return own.select((F.col("cycle") + id_offset).alias("profile_id"), "tick", *cells)
