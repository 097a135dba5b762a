"""Structured Streaming jobs: sinks, state tables and the three-query main job."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rigwatch.functions.columns import span
from rigwatch.operators.ordered import latest_by, newest_first
from rigwatch.operators.rules import anomaly_events, anomaly_status
from rigwatch.operators.windows import HOP_SIZE, HOP_SLIDE, hop_stats_direct
from rigwatch.schemas import ALERT_TOPIC, ANALYTICS_TOPIC
from rigwatch.sources.messages import (
    BUS_COLUMNS, documents, envelope, is_valid_reading, parse_labels, parse_readings, split_valid,
)
from rigwatch.streaming.progress import ProgressRecorder, counted
from rigwatch.streaming.transitions import status_transitions

WATERMARK = timedelta(seconds=10)
LABEL_TRIGGER = "5 seconds"


def watermarked(readings: DataFrame, delay: timedelta = WATERMARK, time_col: str = "ts") -> DataFrame:
    return readings.withWatermark(time_col, span(delay))


def drop_replays(readings: DataFrame, keys: Sequence[str] = ("sensor", "cycle", "sample_idx")) -> DataFrame:
    """Drop repeated deliveries of a sample within the watermark."""
    return readings.dropDuplicatesWithinWatermark(list(keys))


def hop_stats_stream(readings: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE,
                     delay: timedelta = WATERMARK) -> DataFrame:
    """Watermarked hopping-window statistics per sensor; state is five numbers per open window."""
    return hop_stats_direct(watermarked(readings, delay), size, slide)


def running_counts(readings: DataFrame) -> DataFrame:
    """Running sample count and last event time per sensor (complete or update mode)."""
    return readings.groupBy("sensor").agg(F.count(F.lit(1)).alias("sample_count"), F.max("ts").alias("last_update"))


def running_gauges(readings: DataFrame) -> DataFrame:
    """Current value of each sensor, of equal times the one with the largest bus offset, beside its running count."""
    return readings.groupBy("sensor").agg(
        F.max_by("value", newest_first("ts", "offset")).alias("value"), F.count(F.lit(1)).alias("sample_count"), F.max("ts").alias("last_update"))


def publish_gauges(readings: DataFrame, path: str, checkpoint: str, trigger: str | None = "2 seconds") -> StreamingQuery:
    """Keep the gauge table up to date; read it with :func:`current_state`."""
    return to_updates(running_gauges(readings), path, checkpoint, trigger)


def _with_trigger(writer, trigger: str | None):
    """A processing-time text, "available" for one pass over what is there, or the default."""
    if trigger == "available":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def to_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
               trigger: str | None = None) -> StreamingQuery:
    """Append rows to a Parquet archive; the file sink's log makes retries exact."""
    writer = df.writeStream.format("parquet").outputMode("append") \
        .option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _with_trigger(writer, trigger).start()


def to_time_partitions(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Archive partitioned by date and hour; finer folders would hold one tiny file each.

    Rows are dealt to all shuffle partitions by a hash of the whole row, so a busy hour is written by all tasks.
    """
    dated = df.withColumn("date", F.to_date("window_start")).withColumn("hour", F.hour("window_start"))
    dated = dated.repartition(*df.columns)
    return to_parquet(dated, path, checkpoint, ["date", "hour"], trigger)


def to_console(df: DataFrame, checkpoint: str, trigger: str = "5 seconds") -> StreamingQuery:
    return df.writeStream.outputMode("append").format("console").option("truncate", "false") \
        .option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()


def to_bus(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "update",
           key: str = "sensor") -> StreamingQuery:
    """Rows as JSON messages keyed by sensor. Needs the bus connector on the class path."""
    return envelope(df, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).option("checkpointLocation", checkpoint).outputMode(mode).start()


def to_updates(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Changed rows of an update-mode result, one folder per micro-batch.

    A repeated batch overwrites its own folder, so retries leave no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _with_trigger(writer, trigger).start()


def current_state(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key in an update log."""
    log = spark.read.parquet(path)
    columns = [c for c in log.columns if c not in (*keys, "batch_id")]
    return latest_by(log, keys, F.col("batch_id"), columns)


def compact_updates(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Write the current state of an update log into a new path, as its batch 0."""
    current_state(spark, path, keys).write.parquet(f"{target}/batch_id=0")


def to_documents(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "2 seconds") -> StreamingQuery:
    """Messages with bus metadata, routed into a raw and an analytics table."""
    return to_parquet(documents(messages), path, checkpoint, ["kind"], trigger)


def archive_readings(messages: DataFrame, path: str, quarantine: str, checkpoints: str, trigger: str | None = None,
                     partition_by: Sequence[str] = ("sensor",)) -> list[StreamingQuery]:
    """Raw archive by sensor, and the messages that are not readings beside it.

    A "date" among the partition columns is taken from the event time; long
    archives want it, so that time ranges and retention prune folders too.
    """
    parsed = parse_readings(messages, keep_bus_columns=True, keep_body=True)
    _, rejected = split_valid(parsed)
    valid, _ = split_valid(counted(parsed, is_valid_reading()))
    valid = valid.drop("body", *BUS_COLUMNS)
    if "date" in partition_by:
        valid = valid.withColumn("date", F.to_date("ts"))
    return [to_parquet(valid, path, f"{checkpoints}/raw", partition_by, trigger),
            to_parquet(rejected, quarantine, f"{checkpoints}/quarantine", (), trigger)]


def archive_labels(messages: DataFrame, path: str, checkpoint: str,
                   trigger: str | None = LABEL_TRIGGER) -> StreamingQuery:
    return to_parquet(parse_labels(messages), path, checkpoint, (), trigger)


def alerts(stats: DataFrame) -> DataFrame:
    """Anomalies raised by window statistics, for the alert topic or table."""
    return anomaly_events(stats)


def run(spark: SparkSession, servers: str, archive: str, checkpoints: str,
        max_per_trigger: int = 5_000_000) -> list[StreamingQuery]:
    """The main job: statistics, alerts and current state from one stateful query, readings and labels to the archive.

    The statistics, alerts (each once) and current state are tables below ``archive``, and what a micro-batch changed goes to the bus
    as well. ``max_per_trigger`` bounds a micro-batch; what is left of a backlog follows in the next ones. Progress, counters and late rows of
    all queries are appended to ``archive``/metrics while they run.
    """
    from rigwatch.sources.bus import read_labels, read_sensors
    from rigwatch.streaming.tables import WindowTables

    def publish(stats: DataFrame, alerts: DataFrame) -> None:
        for rows, topic in ((stats, ANALYTICS_TOPIC), (alerts, ALERT_TOPIC)):
            envelope(rows, "sensor").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    spark.streams.addListener(ProgressRecorder(spark, f"{archive}/metrics"))
    messages = read_sensors(spark, servers, max_per_trigger=max_per_trigger)
    valid, _ = split_valid(parse_readings(messages))
    tables = WindowTables(spark, hop_stats_stream(valid), f"{archive}/tables", publish=publish)
    return [
        tables.start(f"{checkpoints}/tables"),
        *archive_readings(messages, f"{archive}/raw", f"{archive}/quarantine", checkpoints,
                          partition_by=("sensor", "date")),
        archive_labels(read_labels(spark, servers), f"{archive}/labels", f"{checkpoints}/labels"),
    ]


@contextmanager
def state_in_rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which event-time timers need; the session's setting returns after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish_transitions(stats: DataFrame, path: str, checkpoint: str, stale_after: timedelta, delay: timedelta = WATERMARK,
                        trigger: str | None = None) -> StreamingQuery:
    """Changes of status, and staleness, of a stream of window statistics as an append-only table."""
    status = anomaly_status(watermarked(stats, delay, "window_end"))
    with state_in_rocksdb(stats.sparkSession):
        return to_parquet(status_transitions(status, stale_after), path, checkpoint, (), trigger)


def wait_for_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def drain(*queries: StreamingQuery) -> None:
    """Wait until queries with the "available" trigger have read everything."""
    for query in queries:
        query.awaitTermination()
