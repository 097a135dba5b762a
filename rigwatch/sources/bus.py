"""Message-bus scans. The connector package must be on the cluster's class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rigwatch.schemas import BUS_MESSAGE, LABEL_TOPIC, SENSOR_NAMES, TOPIC_PREFIX

SENSOR_TOPICS = [TOPIC_PREFIX + name for name in SENSOR_NAMES]


def sensor_pattern(prefix: str = TOPIC_PREFIX) -> str:
    """Topic pattern of the sensors only; it leaves out the result and label topics."""
    return f"{prefix}(?:{'|'.join(SENSOR_NAMES)})"


def bus_options(servers: str, topics: Sequence[str] | None = None, pattern: str | None = None,
                starting: str = "latest", fail_on_data_loss: bool = True,
                max_per_trigger: int | None = None) -> dict[str, str]:
    """Reader options for a topic list or a topic pattern.

    ``max_per_trigger`` bounds a micro-batch when a backlog is read.
    """
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting,
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if pattern is not None:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = ",".join(topics)
    return options


def read_bus(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_sensors(spark: SparkSession, servers: str, starting: str = "latest",
                 max_per_trigger: int | None = None) -> DataFrame:
    return read_bus(spark, bus_options(
        servers, pattern=sensor_pattern(), starting=starting, max_per_trigger=max_per_trigger))


def read_labels(spark: SparkSession, servers: str) -> DataFrame:
    return read_bus(spark, bus_options(servers, [LABEL_TOPIC], starting="earliest"))


def read_message_files(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Bus messages dumped as Parquet, as a stream with the same columns."""
    reader = spark.readStream.schema(BUS_MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def exclude_topics(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    return messages.filter(~F.col("topic").isin(list(topics)))
