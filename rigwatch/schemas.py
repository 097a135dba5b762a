"""Declared schemas and the fixed values of the data model."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Sensor(NamedTuple):
    sensor: str
    family: str
    unit: str
    rate_hz: int


# The sensors of the rig, their family, unit and sampling rate.
SENSORS = [
    Sensor("PS1", "pressure", "bar", 100),
    Sensor("PS2", "pressure", "bar", 100),
    Sensor("PS3", "pressure", "bar", 100),
    Sensor("PS4", "pressure", "bar", 100),
    Sensor("PS5", "pressure", "bar", 100),
    Sensor("PS6", "pressure", "bar", 100),
    Sensor("EPS1", "power", "W", 100),
    Sensor("FS1", "flow", "l/min", 10),
    Sensor("FS2", "flow", "l/min", 10),
    Sensor("TS1", "temperature", "C", 1),
    Sensor("TS2", "temperature", "C", 1),
    Sensor("TS3", "temperature", "C", 1),
    Sensor("TS4", "temperature", "C", 1),
    Sensor("VS1", "vibration", "mm/s", 1),
    Sensor("CE", "virtual", "%", 1),
    Sensor("CP", "virtual", "kW", 1),
    Sensor("SE", "virtual", "%", 1),
]
CYCLE_SECONDS = 60
TOP_RATE_HZ = 100
# Names on the bus and in the metric store.
RAW_METRIC_PREFIX = "hydraulic_raw_"
TOPIC_PREFIX = "hydraulic-"
ANALYTICS_TOPIC = "hydraulic-analytics"
LABEL_TOPIC = "hydraulic-labels"
ALERT_TOPIC = "hydraulic-alerts"

# Meaning of the condition codes.
LABEL_TEXTS = {
    "label_cooler": {3: "close to total failure", 20: "reduced efficiency", 100: "full efficiency"},
    "label_valve": {100: "optimal switching behavior", 90: "small lag", 80: "severe lag",
                    73: "close to total failure"},
    "label_pump": {0: "no", 1: "weak", 2: "severe"},
    "label_accumulator": {130: "optimal pressure", 115: "slightly reduced pressure",
                          100: "severely reduced pressure", 90: "close to total failure"},
    "label_stable": {0: "yes", 1: "not"},
}
# The code that means "no fault" for each label.
HEALTHY_CODES = {"label_cooler": 100, "label_valve": 100, "label_pump": 0,
                 "label_accumulator": 130, "label_stable": 0}

SENSOR_NAMES = [s.sensor for s in SENSORS]
LABEL_NAMES = list(LABEL_TEXTS)
PRESSURE = [s.sensor for s in SENSORS if s.family == "pressure"]
FLOW = [s.sensor for s in SENSORS if s.family == "flow"]
TEMPERATURE = [s.sensor for s in SENSORS if s.family == "temperature"]

READING = T.StructType([
    T.StructField("sensor", T.StringType()),
    T.StructField("cycle", T.IntegerType()),
    T.StructField("sample_idx", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("sampling_rate_hz", T.IntegerType()),
])
LABEL = T.StructType(
    [T.StructField("cycle", T.IntegerType())]
    + [T.StructField(name, T.IntegerType()) for name in LABEL_NAMES]
    + [T.StructField("timestamp", T.DoubleType())]
)
WINDOW_STATS = T.StructType([
    T.StructField("sensor", T.StringType()),
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("stddev_value", T.DoubleType()),
    T.StructField("range_value", T.DoubleType()),
    T.StructField("sample_count", T.LongType()),
])
BUS_MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
DEVICE_EVENT = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("cycle_index", T.LongType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("cooler_efficiency_pct", T.DoubleType()),
    T.StructField("pressure1_bar", T.DoubleType()),
    T.StructField("pressure2_bar", T.DoubleType()),
    T.StructField("temperature_cooler_out_C", T.DoubleType()),
    T.StructField("cooler_condition", T.StringType()),
    T.StructField("features", T.MapType(T.StringType(), T.StringType())),
])
# Headers of the CSV export and the event field each one feeds.
CSV_MAPPING = {
    "device_id": "device_id",
    "cycle_index": "cycle_index",
    "event_time": "event_time",
    "cooler_efficiency": "cooler_efficiency_pct",
    "pressure1": "pressure1_bar",
    "pressure2": "pressure2_bar",
    "temperature_cooler_out": "temperature_cooler_out_C",
}


def sensor_table(spark: SparkSession) -> DataFrame:
    """The sensor dimension, one row per sensor (17 rows)."""
    rows = [(s.sensor, s.family, s.unit, s.rate_hz, s.rate_hz * CYCLE_SECONDS,
             TOP_RATE_HZ // s.rate_hz) for s in SENSORS]
    return spark.createDataFrame(
        rows, "sensor string, family string, unit string, rate_hz int, "
              "samples_per_cycle int, upsample int")


def _lookup(field: str, sensor: str) -> Column:
    pairs = ", ".join(f"{s.sensor!r}, {getattr(s, field)!r}" for s in SENSORS)
    return F.expr(f"element_at(map({pairs}), {sensor})")


def rate_of(sensor: str) -> Column:
    """Sampling rate in Hz of the sensor named in a column, NULL for an unknown one."""
    return _lookup("rate_hz", sensor)


def family_of(sensor: str) -> Column:
    """Family of the sensor named in a column."""
    return _lookup("family", sensor)
