"""File sources: cycle matrices, label files, archives and mapped CSV."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from rigwatch.schemas import CSV_MAPPING, DEVICE_EVENT, LABEL_NAMES, rate_of


def numbered_lines(spark: SparkSession, path: str, through_folder: bool = False) -> DataFrame:
    """Lines of text files with the 0-based line number inside each file.

    With ``through_folder`` a folder's files are one text in the order of their names, as Spark
    writes sorted rows, and their lines are numbered through.
    Lines are numbered where they are read and only the line counts per file
    split are summed. While that table (one row per split) is small enough to
    be broadcast the text is not shuffled. A line outside its split's range
    stops the job.
    """
    def scan() -> DataFrame:
        return spark.read.text(path).select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("position"), "value")

    splits = scan().groupBy("file", "split").agg(
        F.min("position").alias("first"), F.count(F.lit(1)).alias("lines"))
    text = F.regexp_extract("file", "^(.*)/", 1) if through_folder else F.col("file")
    before = Window.partitionBy(text).orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("offset", F.coalesce(F.sum("lines").over(before), F.lit(0)))
    inside = F.col("position") - F.col("first")
    in_range = (inside >= 0) & (inside < F.col("lines"))
    return scan().join(splits, ["file", "split"]).select(
        "file",
        F.when(in_range, F.col("offset") + inside)
        .otherwise(F.raise_error(F.lit("file splits changed between scans"))).alias("line"),
        "value")


def file_stem(file: Column | str) -> Column:
    return F.regexp_extract(file, r"([^/]+?)(?:\.[^./]*)?$", 1)


def folder_value(file: Column | str, name: str) -> Column:
    """Value in the last ``name=value`` folder of a path."""
    return F.regexp_extract(file, f"^.*/{name}=([^/]*)/", 1)


def matrix_samples(lines: DataFrame, line: str = "value") -> DataFrame:
    """One row per sample of tab-separated cycle lines."""
    others = [c for c in lines.columns if c != line]
    return lines.select(
        *others, F.posexplode(F.split(F.trim(line), "\t")).alias("sample_idx", "text")
    ).select(*others, "sample_idx", F.col("text").try_cast("double").alias("value"))


def read_matrices(spark: SparkSession, path: str, cycle_offset: int = 0, folders: bool = False) -> DataFrame:
    """Readings from cycle matrices, one line per cycle: one file per sensor, or with ``folders`` one ``sensor=`` folder of files."""
    sensor = folder_value("file", "sensor") if folders else file_stem("file")
    lines = numbered_lines(spark, path, folders).select(
        sensor.alias("sensor"), (F.col("line") + cycle_offset).cast("int").alias("cycle"), "value")
    return matrix_samples(lines).withColumn("sampling_rate_hz", rate_of("sensor"))


def count_cycles(spark: SparkSession, path: str) -> DataFrame:
    """Number of cycles per matrix file."""
    return spark.read.text(path).groupBy(file_stem(F.col("_metadata.file_path")).alias("sensor")).agg(
        F.count(F.lit(1)).alias("cycles"))


def label_fields(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split label lines on white space; ``parts`` of the wrong size mark a malformed line."""
    return lines.withColumn("parts", F.split(F.trim(F.col(line)), r"\s+"))


def _code(i: int) -> Column:
    return F.get("parts", F.lit(i)).try_cast("double").try_cast("int")


def well_formed() -> Column:
    """Whether ``parts`` are as many numbers as there are labels."""
    numbers = reduce(lambda a, b: a & b, [_code(i).isNotNull() for i in range(len(LABEL_NAMES))])
    return F.coalesce((F.size("parts") == len(LABEL_NAMES)) & numbers, F.lit(False))


def parse_label_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Well-formed label lines (five numbers) as integer codes."""
    fields = label_fields(lines, line).filter(well_formed())
    others = [c for c in lines.columns if c != line]
    return fields.select(*others, *[_code(i).alias(name) for i, name in enumerate(LABEL_NAMES)])


def malformed_label_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines with another number of fields, or with a field that is not a number."""
    return label_fields(lines, line).filter(~well_formed()).drop("parts")


def read_label_file(spark: SparkSession, path: str, cycle_offset: int = 0, through_folder: bool = False) -> DataFrame:
    """Labels from the five-column profile file; the cycle is the line number plus an offset. Malformed lines count."""
    lines = numbered_lines(spark, path, through_folder).select((F.col("line") + cycle_offset).cast("int").alias("cycle"), "value")
    return parse_label_lines(lines)


def read_label_table(spark: SparkSession, path: str) -> DataFrame:
    """Labels from a headerless TSV with the cycle in the first column."""
    schema = T.StructType([T.StructField("cycle", T.IntegerType())]
                          + [T.StructField(n, T.IntegerType()) for n in LABEL_NAMES])
    return spark.read.schema(schema).option("sep", "\t").option("header", "false").csv(path)


def scan_parquet(spark: SparkSession, path: str, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Parquet scan with equality filters; filters on partition columns prune folders."""
    df = spark.read.parquet(path)
    for name, value in (filters or {}).items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that holds a table, primary location first."""
    for path in paths:
        try:
            spark.read.parquet(path)
            return path
        except AnalysisException:  # no such path, or nothing in it
            continue
    raise FileNotFoundError(f"none of {list(paths)} exists")


def first_with_all(spark: SparkSession, folders: Sequence[str], names: Sequence[str]) -> str:
    """The first folder in which all the named tables can be read, primary location first."""
    for folder in folders:
        try:
            for name in names:
                spark.read.parquet(f"{folder}/{name}")
            return folder
        except AnalysisException:  # no such path, or nothing in it
            continue
    raise FileNotFoundError(f"none of {list(folders)} holds {list(names)}")


def scan_with_fallback(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.parquet(first_existing(spark, paths))


def map_columns(df: DataFrame, mapping: Mapping[str, str] = CSV_MAPPING) -> DataFrame:
    """Rename and cast source headers to the device-event fields; unreadable values become NULL."""
    types = {f.name: f.dataType for f in DEVICE_EVENT.fields}
    return df.select([F.col(header).try_cast(types[field]).alias(field) for header, field in mapping.items()])


def read_mapped_csv(spark: SparkSession, path: str, mapping: Mapping[str, str] = CSV_MAPPING) -> DataFrame:
    return map_columns(spark.read.option("header", "true").csv(path), mapping)


def cycle_range(readings: DataFrame, start: int, end: int, total: int | None = None) -> DataFrame:
    """Readings of the cycles in [start, end)."""
    if start < 0 or start >= end or (total is not None and end > total):
        raise ValueError(f"invalid cycle range {start}..{end}")
    return readings.filter((F.col("cycle") >= start) & (F.col("cycle") < end))


def draw_cycles(spark: SparkSession, n: int, total: int, seed: int = 42) -> DataFrame:
    """n cycle numbers drawn uniformly with replacement, reproducible for a seed."""
    text = F.concat_ws(":", F.lit(seed), F.col("id"))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return spark.range(n).select(F.col("id").alias("draw"), (number % total).cast("int").alias("cycle"))


def sample_cycles(readings: DataFrame, n: int, total: int, seed: int = 42) -> DataFrame:
    """Readings of n randomly drawn cycles; a cycle drawn twice appears twice."""
    return readings.join(draw_cycles(readings.sparkSession, n, total, seed), "cycle")
