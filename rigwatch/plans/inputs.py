"""Readings, labels and bus messages derived from the given tables.

The same rules are stated once as DataFrame code and once as SQL.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.operators.ordered import with_index
from rigwatch.schemas import SENSOR_NAMES, rate_of

# The events lie minutes apart, so windows are scaled up in the same ratio.
SIZE, SLIDE, WIDTH = timedelta(hours=6), timedelta(hours=1), timedelta(hours=1)
BLOCK = timedelta(days=1)
AS_OF = datetime(2024, 1, 31)
RIG_WIDTH, CYCLE_DAYS, EPOCH_MICROS = timedelta(hours=6), 5, 1_704_067_200_000_000  # from 2024-01-01
COOLER, VALVE, ACCUMULATOR = (3, 20, 100), (73, 80, 90, 100), (90, 100, 115, 130)


# Columns used of the given tables.
EVENT_COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, value double"
CUSTOMER_COLUMNS = "c_custkey bigint, c_nationkey int"
READING_COLUMNS = (
    f"get(array({', '.join(map(repr, SENSOR_NAMES))}), CAST((event_id + user_id + 14) % 17 AS INT)) AS sensor",
    "CAST(user_id AS INT) AS cycle",
)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings from ``events``: sensor, cycle, value, ts, rate and bus position."""
    return spark.read.schema(EVENT_COLUMNS).parquet(f"{sf_dir}/events.parquet").selectExpr(
        *READING_COLUMNS, "value", "ts", "event_id AS offset").withColumn("sampling_rate_hz", rate_of("sensor"))


def indexed_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the sample index inside each cycle and sensor."""
    return with_index(readings(spark, sf_dir), ["cycle", "sensor"], "ts", "offset")


def rig_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of one rig whose cycles follow each other in time, five days each.

    A synchronised record needs all sensors in the same window and cycle; the
    user-based cycles of :func:`readings` are too thin for that.
    """
    return by_days(readings(spark, sf_dir))


def by_days(rows: DataFrame) -> DataFrame:
    """Readings with their cycle taken from the time."""
    day = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(EPOCH_MICROS)) / (CYCLE_DAYS * 86_400_000_000))
    return rows.withColumn("cycle", day.cast("int"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition labels from ``customer``, one row per cycle."""
    return labels_of(spark.read.schema(CUSTOMER_COLUMNS).parquet(f"{sf_dir}/customer.parquet"))


def labels_of(customers: DataFrame) -> DataFrame:
    return customers.selectExpr(
        "CAST(c_custkey AS INT) AS cycle",
        f"get(array{COOLER}, CAST(c_nationkey % 3 AS INT)) AS label_cooler",
        f"get(array{VALVE}, CAST(c_custkey % 4 AS INT)) AS label_valve",
        "CAST(c_custkey % 3 AS INT) AS label_pump",
        f"get(array{ACCUMULATOR}, CAST(c_nationkey % 4 AS INT)) AS label_accumulator",
        "CAST(c_custkey % 2 AS INT) AS label_stable")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus messages of the readings."""
    return messages_of(readings(spark, sf_dir))


def messages_of(source: DataFrame) -> DataFrame:
    """Bus messages of readings, with drifted, foreign and broken bodies mixed in."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    good = F.to_json(F.struct(
        "sensor", "cycle", F.col("offset").cast("int").alias("sample_idx"), "value",
        iso.alias("timestamp"), "sampling_rate_hz"))
    drifted = F.to_json(F.struct(
        "sensor", F.col("value").alias("val"), "cycle", F.col("offset").alias("idx"), iso.alias("ts")))
    result = F.to_json(F.struct(
        "sensor", iso.alias("window_start"), F.col("value").alias("avg_value"), F.lit(1).alias("sample_count")))
    kind = F.col("offset") % 10
    body = F.when(kind == 7, drifted).when(kind == 8, result).when(kind == 9, F.lit("{broken")).otherwise(good)
    return source.select(
        F.col("sensor").cast("binary").alias("key"), body.cast("binary").alias("value"),
        F.concat(F.lit("hydraulic-"), "sensor").alias("topic"),
        (F.col("offset") % 8).cast("int").alias("partition"), "offset",
        F.col("ts").cast("timestamp").alias("timestamp"))


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str, **options: str) -> DataFrame:
    """A table as a stream, whether it is a file or a folder of files; stops if there is none."""
    path = f"{sf_dir}/{name}.parque[t]"  # a pattern: a file source takes no single file
    spark.read.schema(schema).parquet(path)
    return spark.readStream.schema(schema).options(**options).parquet(path)


def reading_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a stream over the events table."""
    return readings_of(table_stream(spark, sf_dir, "events", EVENT_COLUMNS))


def readings_of(events: DataFrame) -> DataFrame:
    """Readings of a stream of events."""
    return events.selectExpr(
        *READING_COLUMNS, "value", "CAST(ts AS TIMESTAMP) AS ts", "event_id AS offset").withColumn("sampling_rate_hz", rate_of("sensor"))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL side has them."""
    return df.select([F.col(f.name).cast("timestamp_ntz").alias(f.name)
                      if f.dataType.typeName() == "timestamp" else F.col(f.name) for f in df.schema.fields])


def day_as_time(df: DataFrame, column: str = "day") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


# SQL side -------------------------------------------------------------------

def r(expression: str, digits: int = 6) -> str:
    """Rounding that matches ``functions.columns.fixed``."""
    return f"round(({expression}) + 1e-9, {digits})"


def with_ctes(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


_NAMES = ", ".join(f"'{n}'" for n in SENSOR_NAMES)
READINGS = f"""readings AS (
  SELECT sensor, cycle, value, ts, "offset",
         CASE WHEN sensor LIKE 'PS%' OR sensor = 'EPS1' THEN 100
              WHEN sensor LIKE 'FS%' THEN 10 ELSE 1 END AS sampling_rate_hz
  FROM (SELECT [{_NAMES}][1 + (event_id + user_id + 14) % 17] AS sensor,
               CAST(user_id AS INT) AS cycle, value, ts, event_id AS "offset"
        FROM events))"""
# Same columns, cycles by time.
RIG = READINGS.replace("readings AS (", "user_readings AS (", 1) + """,
readings AS (
  SELECT * REPLACE (CAST(floor(epoch_us(ts - INTERVAL 19723 DAY) / (5 * 86400000000)) AS INT) AS cycle)
  FROM user_readings)"""
INDEXED = READINGS + """,
indexed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY cycle, sensor ORDER BY ts, "offset") - 1 AS INT) AS sample_idx
  FROM readings)"""
LABELS = """labelled AS (
  SELECT CAST(c_custkey AS INT) AS cycle,
         [3, 20, 100][1 + c_nationkey % 3] AS label_cooler,
         [73, 80, 90, 100][1 + c_custkey % 4] AS label_valve,
         CAST(c_custkey % 3 AS INT) AS label_pump,
         [90, 100, 115, 130][1 + c_nationkey % 4] AS label_accumulator,
         CAST(c_custkey % 2 AS INT) AS label_stable
  FROM customer)"""


def hops(size: int = 6, slide: int = 1, keys: str = "sensor", name: str = "hop") -> str:
    """Hopping-window statistics in hours; needs ``readings``."""
    return f"""{name} AS (
  SELECT {keys}, ws AS window_start, ws + INTERVAL {size} HOUR AS window_end,
         avg(value) AS avg_value, max(value) AS max_value, min(value) AS min_value,
         stddev_samp(value) AS stddev_value, max(value) - min(value) AS range_value,
         count(value) AS sample_count
  FROM (SELECT r.*, time_bucket(INTERVAL {slide} HOUR, ts, TIMESTAMP '1970-01-01') - to_hours(CAST(k * {slide} AS INT)) AS ws
        FROM readings r, range({size // slide}) t(k))
  GROUP BY {keys}, ws)"""


HOP = READINGS + ",\n" + hops()
_HIGH_PRESSURE = "sensor = 'PS1' AND max_value > 300"
_HIGH_TEMPERATURE = "sensor = 'TS1' AND max_value > 100"
_PRESSURE_SPIKE = "sensor LIKE 'PS%' AND range_value > 50"
EVENTS = HOP + f""",
raised AS (
  SELECT *, 'high_pressure' AS type FROM hop WHERE {_HIGH_PRESSURE}
  UNION ALL SELECT *, 'high_temperature' FROM hop WHERE {_HIGH_TEMPERATURE}
  UNION ALL SELECT *, 'pressure_spike' FROM hop WHERE {_PRESSURE_SPIKE})"""
STATUS = HOP + f""",
status AS (
  SELECT sensor, window_start, window_end, 'high_pressure' AS type, CAST({_HIGH_PRESSURE} AS INT) AS status
  FROM hop WHERE sensor LIKE 'PS%'
  UNION ALL SELECT sensor, window_start, window_end, 'pressure_spike', CAST({_PRESSURE_SPIKE} AS INT)
  FROM hop WHERE sensor LIKE 'PS%'
  UNION ALL SELECT sensor, window_start, window_end, 'high_temperature', CAST({_HIGH_TEMPERATURE} AS INT)
  FROM hop WHERE sensor LIKE 'TS%')"""
HEALTH = HOP + f""",
scores AS (
  SELECT sensor, window_start, window_end,
         CAST(greatest(0, 100 - CASE WHEN {_HIGH_PRESSURE} THEN 20 ELSE 0 END
                              - CASE WHEN {_HIGH_TEMPERATURE} THEN 20 ELSE 0 END
                              - CASE WHEN {_PRESSURE_SPIKE} THEN 10 ELSE 0 END) AS INT) AS health
  FROM hop)"""


def sync_cte(stats: tuple[str, ...] = ("avg", "min", "max", "std", "count"), sensors=tuple(SENSOR_NAMES),
             hours: int = 6) -> str:
    """Synchronised wide records; needs ``readings``."""
    sql = {"avg": "avg(value)", "min": "min(value)", "max": "max(value)", "std": "stddev_samp(value)",
           "count": "nullif(count(value) FILTER (WHERE sensor = '{s}'), 0)"}
    cells = ", ".join(
        (sql[k].format(s=s) if k == "count" else f"{sql[k]} FILTER (WHERE sensor = '{s}')") + f' AS "{s}_{k}"'
        for s in sensors for k in stats)
    return f"""sync AS (
  SELECT time_bucket(INTERVAL {hours} HOUR, ts, TIMESTAMP '1970-01-01') AS window_start,
         time_bucket(INTERVAL {hours} HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL {hours} HOUR AS window_end,
         cycle, {cells}
  FROM readings WHERE sensor IN ({', '.join(f"'{s}'" for s in sensors)})
  GROUP BY ALL)"""


def family_cte() -> str:
    """Family features over ``sync``."""
    def mean(names):
        return "(" + " + ".join(f'"{n}_avg"' for n in names) + f") / {len(names)}"

    pressure = [f"PS{i}" for i in range(1, 7)]
    std = "sqrt((" + " + ".join(f'"{p}_std" * "{p}_std"' for p in pressure) + ") / 6)"
    temps = [f"TS{i}" for i in range(1, 5)]
    return f"""family AS (
  SELECT *, {mean(pressure)} AS pressure_mean, {std} AS pressure_std, {mean(temps)} AS temperature_mean,
         {mean(['FS1', 'FS2'])} AS flow_mean, "PS1_max" - "PS1_min" AS pressure_range
  FROM sync)"""


