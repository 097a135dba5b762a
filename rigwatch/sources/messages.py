"""Decoding, validation and routing of bus messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rigwatch.schemas import DEVICE_EVENT, LABEL, READING, WINDOW_STATS

BUS_COLUMNS = ("topic", "partition", "offset")


def unpacked(df: DataFrame, body: Column, *keep: Column | str) -> DataFrame:
    """The fields of a struct expression as columns.

    Generated from a one-element array, so later filters on the fields use the
    decoded row instead of decoding the body once more per predicate.
    """
    return df.select(F.inline(F.array(body)), *keep)


def parse(messages: DataFrame, schema: T.StructType, keep: tuple[Column | str, ...] = ()) -> DataFrame:
    """Decode the message body; fields that do not fit the schema become NULL."""
    return unpacked(messages, F.from_json(F.col("value").cast("string"), schema), *keep)


def parse_readings(messages: DataFrame, keep_bus_columns: bool = False, keep_body: bool = False) -> DataFrame:
    """Sensor readings with an event time ``ts`` from the ISO text; ``body`` is the message as it came."""
    kept = [c for c in BUS_COLUMNS if c in messages.columns] if keep_bus_columns else []
    # The bus timestamp would collide with the payload's own field.
    renamed = messages.withColumnRenamed("timestamp", "kafka_timestamp") \
        if "timestamp" in messages.columns else messages
    extra = tuple(kept + (["kafka_timestamp"] if "kafka_timestamp" in renamed.columns else []))
    if keep_body:
        extra += (F.col("value").cast("string").alias("body"),)
    return parse(renamed, READING, extra).withColumn("ts", F.try_to_timestamp("timestamp")).drop("timestamp")


def parse_labels(messages: DataFrame) -> DataFrame:
    return parse(messages, LABEL)


def parse_window_stats(messages: DataFrame) -> DataFrame:
    return parse(messages, WINDOW_STATS)


def is_valid_reading() -> Column:
    """A reading can be archived when sensor, value and event time are present."""
    return F.col("sensor").isNotNull() & F.col("value").isNotNull() & F.col("ts").isNotNull()


def split_valid(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readings to archive, and the quarantined rest with the reason."""
    reason = (F.when(F.col("sensor").isNull(), "no sensor").when(F.col("value").isNull(), "no value")
              .when(F.col("ts").isNull(), "no event time"))
    return readings.filter(is_valid_reading()), \
        readings.filter(~is_valid_reading()).withColumn("reason", reason)


def envelope(df: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Key and JSON body for the bus; NULL fields are left out of the body."""
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def documents(messages: DataFrame) -> DataFrame:
    """Decoded messages of either kind with the bus metadata attached.

    ``kind`` is "analytics" when the body carries ``avg_value``, else "raw".
    """
    body = F.from_json(F.col("value").cast("string"), T.StructType(
        READING.fields + [f for f in WINDOW_STATS.fields if f.name != "sensor"]))
    return unpacked(
        messages, body,
        F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"),
    ).withColumn("kind", F.when(F.col("avg_value").isNotNull(), "analytics").otherwise("raw"))


def bus_time(millis: Column) -> Column:
    """Timestamp of a bus message from epoch milliseconds."""
    return F.timestamp_millis(millis)


def extra(path: str, kind: str, event: str = "event") -> Column:
    """A field of an open event by its path, whether a schema lists it or not; NULL when absent or of another kind."""
    return F.try_variant_get(event, F.lit(f"$.{path}"), kind)


def open_events(messages: DataFrame, body: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Device events whose open fields are kept.

    A body is decoded once, into a VARIANT, from which the declared fields and the checks are taken; ``event`` is that
    VARIANT, ``body`` the text as it came.
    """
    text = F.col(body).cast("string")
    rows = messages.select(*keep, text.alias("body"), F.try_parse_json(text).alias("event"))
    declared = {f.name: f.dataType.simpleString() for f in DEVICE_EVENT.fields}
    whole = F.schema_of_variant("event").startswith("OBJECT")
    flat = rows.select(*keep, "body", "event", F.coalesce(whole, F.lit(False)).alias("_object"), *[extra(name, kind).alias(name) for name, kind in declared.items()])
    when = F.try_to_timestamp("event_time")
    problem = F.when(~F.col("_object"), "not an object").otherwise(event_problem(when))
    return flat.withColumn("event_ts", when).withColumn("problem", problem).drop("_object")


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events without their body, and the rest with body and problem."""
    return events.filter("problem IS NULL").drop("body"), events.filter("problem IS NOT NULL")


def event_problem(when: Column) -> Column:
    """What keeps a decoded event from meeting the contract; ``when`` is its event time."""
    return (
        F.when(F.col("device_id").isNull(), "device_id missing")
        .when(F.col("cycle_index").isNull(), "cycle_index missing")
        .when(F.col("cycle_index") < 0, "cycle_index negative")
        .when(F.col("event_time").isNull(), "event_time missing")
        .when(when.isNull(), "event_time not a date-time")
        .when(F.col("cooler_efficiency_pct").isNull(), "cooler_efficiency_pct missing")
    )


def device_events(messages: DataFrame, body: str = "value") -> DataFrame:
    """Device events with a ``problem`` column, NULL when the event meets the contract."""
    event = F.from_json(F.col(body).cast("string"), DEVICE_EVENT)
    flat = unpacked(messages, event)
    when = F.try_to_timestamp("event_time")
    return flat.withColumn("event_ts", when).withColumn("problem", event_problem(when))
