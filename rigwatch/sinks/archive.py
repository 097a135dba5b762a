"""Batch sinks: archives, exports, retention and training records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Snappy Parquet.

    With partition columns the rows are rebalanced on them first: small
    folders get few files and a folder that holds much of the data is split
    over several tasks.
    """
    out = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode(mode).option("compression", "snappy")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def expired_partitions(df: DataFrame, date_col: str, keep_from: date) -> DataFrame:
    """Partition dates before the cutoff with their row counts."""
    return df.filter(F.col(date_col) < F.lit(keep_from)).groupBy(date_col).agg(F.count(F.lit(1)).alias("rows"))


def apply_retention(spark: SparkSession, path: str, date_col: str, keep_from: date) -> list[str]:
    """Drop the folders of expired dates, at any depth of partition columns; what is kept isn't touched.

    Returns the folders dropped. The work grows with the number of partition folders, not with the data.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped, level = [], [root]
    while level:
        below = [s.getPath() for p in level for s in files.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()]
        level = []
        for folder in below:
            name, _, value = folder.getName().partition("=")
            if name != date_col:
                level.append(folder)
            elif value < keep_from.isoformat():  # a default partition name sorts after all dates and stays
                files.delete(folder, True)
                dropped.append(folder.toString())
    return dropped
