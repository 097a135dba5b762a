import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from rigwatch.sinks import archive
from rigwatch.session import materialise, scratch_path, shared_folder


def dated(spark):
    return spark.range(100).select(F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 5).cast("int")).alias("day"), "id")


def test_partitioned_parquet(spark, out):
    archive.write_parquet(dated(spark), out + "/t", ["day"])
    assert sorted(d for d in os.listdir(out + "/t") if d.startswith("day")) == [f"day=2024-01-0{n}" for n in range(1, 6)]
    assert spark.read.parquet(out + "/t").count() == 100
    archive.write_parquet(dated(spark).limit(10), out + "/t", ["day"])
    assert spark.read.parquet(out + "/t").count() == 10


def test_csv_with_header(spark, out):
    df = spark.createDataFrame([(1, 2.5, None), (2, None, "x")], "cycle int, v double, s string")
    archive.write_csv(df, out + "/c")
    back = spark.read.schema(df.schema).option("header", "true").csv(out + "/c")
    assert sorted(back.collect()) == sorted(df.collect())


def test_retention_drops_expired_folders_alone(spark, out):
    archive.write_parquet(dated(spark), out + "/src", ["day"])
    source = spark.read.parquet(out + "/src")
    assert {r.day: r.rows for r in archive.expired_partitions(source, "day", date(2024, 1, 3)).collect()} == \
        {date(2024, 1, 1): 20, date(2024, 1, 2): 20}
    kept = sorted(os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(out + "/src") for f in names if "day=2024-01-0" in d and d[-1] > "2")
    assert len(archive.apply_retention(spark, out + "/src", "day", date(2024, 1, 3))) == 2
    assert spark.read.parquet(out + "/src").count() == 60
    assert kept == sorted(os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(out + "/src") for f in names if "day=" in d)
    archive.write_parquet(dated(spark).selectExpr("*", "'a' as k"), out + "/nested", ["k", "day"])
    archive.apply_retention(spark, out + "/nested", "day", date(2024, 1, 3))
    assert spark.read.parquet(out + "/nested").count() == 60


def test_scratch_paths(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert materialise(spark.range(7), "m").count() == 7
