"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rigwatch.schemas import LABEL_TEXTS, RAW_METRIC_PREFIX, TOPIC_PREFIX

ZERO_GUARD = 1e-6


def fixed(column: Column | str, digits: int = 6) -> Column:
    """Round for comparison across engines.

    The nudge keeps exact decimal ties from depending on summation order.
    """
    if isinstance(column, str):
        return F.expr(f"round(`{column}` + 1e-9, {digits})")
    return F.round(column + F.lit(1e-9), digits)


def span(duration: timedelta) -> str:
    """Duration as the text that ``window`` and ``withWatermark`` take."""
    return f"{round(duration.total_seconds() * 1_000_000)} microseconds"


def micros(column: Column) -> Column:
    """Microseconds since the epoch (session time zone UTC)."""
    return F.unix_micros(column.cast("timestamp"))


def block_of(time_col: str, block: timedelta) -> Column:
    """Number of the fixed-length time block that holds a timestamp."""
    width = round(block.total_seconds() * 1_000_000)
    return F.floor(micros(F.col(time_col)) / F.lit(width)).cast("long")


def mean_of(columns: Iterable[str]) -> Column:
    """Arithmetic mean across columns, NULL when any of them is NULL."""
    columns = list(columns)
    return F.expr(f"({' + '.join(columns)}) / {len(columns)}")


def pooled_std(columns: Iterable[str]) -> Column:
    """Square root of the mean squared deviation across columns."""
    columns = list(columns)
    return F.expr(f"sqrt(({' + '.join(f'{c} * {c}' for c in columns)}) / {len(columns)})")


def guarded_ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom + F.lit(ZERO_GUARD))


def topic_to_sensor(topic: Column | str, prefix: str = TOPIC_PREFIX) -> Column:
    return F.regexp_replace(topic, f"^{prefix}", "")


def raw_metric_name(sensor: Column | str) -> Column:
    """Gauge name of a raw sensor series."""
    return F.concat(F.lit(RAW_METRIC_PREFIX), F.lower(sensor))


def with_prefix(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Prefix every column name except the ones in ``keep``."""
    keep = set(keep)
    return df.select([F.col(c) if c in keep else F.col(c).alias(f"{prefix}_{c}") for c in df.columns])


def label_text(label: str) -> Column:
    """Description of a condition code."""
    pairs = [F.lit(x) for code, text in LABEL_TEXTS[label].items() for x in (code, text)]
    return F.element_at(F.create_map(*pairs), F.col(label))


def band(value: Column | str, steps: list[tuple[float, str]]) -> Column:
    """Name of the highest step whose lower bound the value reaches.

    Values below the first step get the first step's name.
    """
    value = F.col(value) if isinstance(value, str) else value
    result = None
    for bound, name in sorted(steps, reverse=True):
        result = F.when(value >= bound, name) if result is None else result.when(value >= bound, name)
    return F.when(value.isNull(), F.lit(None)).otherwise(result.otherwise(min(steps)[1]))


# Lower bounds and colours of the dashboard bands.
HEALTH_BANDS = [(0, "red"), (80, "orange"), (90, "green")]
VITAL_BANDS = [(0, "green"), (150, "orange"), (180, "red")]
ANALYTICS_STALE_BANDS = [(0, "green"), (10, "orange"), (30, "red")]
RAW_STALE_BANDS = [(0, "green"), (5, "orange"), (30, "red")]
ALIVE_BANDS = [(0, "red"), (1, "green")]
ACTIVE_BANDS = [(0, "green"), (1, "red")]


def with_date_parts(df: DataFrame, time_col: str = "window_start") -> DataFrame:
    """Add year, month, day, hour, minute and second of a timestamp."""
    t = F.col(time_col)
    return df.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
        "hour": F.hour(t), "minute": F.minute(t), "second": F.second(t).cast("int"),
    })


def sample_time(base: Column, sample_idx: Column, rate_hz: Column) -> Column:
    """Event time of a sample: start of the cycle plus index over rate."""
    offset = F.round(sample_idx.cast("long") * F.lit(1_000_000) / rate_hz).cast("long")
    return F.timestamp_micros(micros(base) + offset)


def second_in_cycle(sample_idx: Column, rate_hz: Column) -> Column:
    return F.floor(sample_idx / rate_hz).cast("int")
