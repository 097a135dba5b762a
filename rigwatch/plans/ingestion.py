"""Decoding, validation, file sources and archives."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rigwatch.functions.columns import fixed, raw_metric_name, topic_to_sensor, with_prefix
from rigwatch.operators import monitoring, windows
from rigwatch.plans import inputs as i
from rigwatch.plans.inputs import r, with_ctes
from rigwatch.plans.monitoring import DOUBLES, rounded
from rigwatch.plans.registry import query
from rigwatch.schemas import CSV_MAPPING, LABEL_NAMES, SENSOR_NAMES, SENSORS, sensor_table
from rigwatch.session import scratch_path
from rigwatch.sinks import archive
from rigwatch.sources import files, messages


@query("parse_json", with_ctes(i.READINGS, select="""
SELECT sensor, cycle, CAST("offset" AS INT) AS sample_idx, value, ts, sampling_rate_hz, "offset"
FROM readings WHERE "offset" % 10 < 7"""))
def parse_json(spark, sf):
    valid, _ = messages.split_valid(messages.parse_readings(i.messages(spark, sf), keep_bus_columns=True))
    return i.plain_times(valid).select("sensor", "cycle", "sample_idx", "value", "ts", "sampling_rate_hz", "offset")


@query("quarantine", with_ctes(i.READINGS, select="""
SELECT "offset", CASE WHEN "offset" % 10 = 9 THEN NULL ELSE sensor END AS sensor,
       CASE WHEN "offset" % 10 = 9 THEN '{broken' END AS broken_body,
       CASE WHEN "offset" % 10 = 9 THEN 'no sensor' ELSE 'no value' END AS reason
FROM readings WHERE "offset" % 10 >= 7"""))
def quarantine(spark, sf):
    _, rejected = messages.split_valid(messages.parse_readings(i.messages(spark, sf), keep_bus_columns=True, keep_body=True))
    return rejected.select("offset", "sensor", F.when(F.col("offset") % 10 == 9, F.col("body")).alias("broken_body"), "reason")


@query("enriched_documents", with_ctes(i.READINGS, select="""
SELECT "offset" AS kafka_offset, CAST("offset" % 8 AS INT) AS kafka_partition,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS kafka_timestamp,
       CASE WHEN "offset" % 10 = 8 THEN 'analytics' ELSE 'raw' END AS kind,
       CASE WHEN "offset" % 10 = 9 THEN NULL ELSE sensor END AS sensor,
       CASE WHEN "offset" % 10 < 7 THEN value END AS value,
       CASE WHEN "offset" % 10 = 8 THEN value END AS avg_value
FROM readings"""))
def enriched_documents(spark, sf):
    return messages.documents(i.messages(spark, sf)).select(
        "kafka_offset", "kafka_partition", "kafka_timestamp", "kind", "sensor", "value", "avg_value")


@query("envelope_json", with_ctes(i.HOP, select="SELECT sensor, sensor AS key, window_start, window_end, "
       + ", ".join(f"{r(c)} AS {c}" for c in DOUBLES)
       + ", sample_count, stddev_value IS NOT NULL AS body_has_stddev FROM hop"))
def envelope_json(spark, sf):
    stats = windows.hop_stats(i.readings(spark, sf), i.SIZE, i.SLIDE)
    timed = stats.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    sent = messages.envelope(timed, "sensor").withColumn("body_has_stddev", F.col("value").contains('"stddev_value"'))
    got = messages.parse(sent, messages.WINDOW_STATS, ("key", "body_has_stddev"))
    return rounded(i.plain_times(got), *DOUBLES)


@query("raw_gauges", with_ctes(i.READINGS, select="""
SELECT lower('hydraulic_raw_' || sensor) AS metric, sensor, sensor AS raw_sensor,
       max_by(value, struct_pack(t := ts, o := "offset")) AS raw_value, count(*) AS raw_samples
FROM readings GROUP BY sensor"""))
def raw_gauges(spark, sf):
    topics = i.readings(spark, sf).withColumn("topic", F.concat(F.lit("hydraulic-"), "sensor"))
    latest = monitoring.gauges(topics.withColumn("sensor", topic_to_sensor("topic")))
    return with_prefix(latest.select("sensor", "value", "samples"), "raw").select(
        raw_metric_name("raw_sensor").alias("metric"), F.col("raw_sensor").alias("sensor"), "*")


@query("event_validation", with_ctes(i.READINGS, select="""
SELECT CASE WHEN k = 0 THEN NULL ELSE sensor END AS device_id,
       CASE WHEN k = 1 THEN NULL WHEN k = 2 THEN -1 - cycle ELSE cycle END::DOUBLE AS cycle_index,
       CASE WHEN k = 5 THEN NULL ELSE value END AS cooler_efficiency_pct,
       CASE WHEN k IN (3, 4) THEN NULL ELSE ts END AS event_ts,
       CASE k WHEN 0 THEN 'device_id missing' WHEN 1 THEN 'cycle_index missing' WHEN 2 THEN 'cycle_index negative'
              WHEN 3 THEN 'event_time missing' WHEN 4 THEN 'event_time not a date-time'
              WHEN 5 THEN 'cooler_efficiency_pct missing' END AS problem,
       CASE WHEN k = 6 THEN 'n/a' END AS feature_note
FROM (SELECT *, "offset" % 11 AS k FROM readings)"""))
def event_validation(spark, sf):
    k = F.col("offset") % 11
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.to_json(F.struct(
        F.when(k != 0, F.col("sensor")).alias("device_id"),
        F.when(k == 2, -1 - F.col("cycle")).when(k != 1, F.col("cycle")).alias("cycle_index"),
        F.when(k == 4, F.lit("yesterday")).when(k != 3, iso).alias("event_time"),
        F.when(k != 5, F.col("value")).alias("cooler_efficiency_pct"),
        F.when(k == 6, F.create_map(F.lit("note"), F.lit("n/a"))).alias("features"),
        F.lit("kept out").alias("extra")))
    checked = messages.device_events(i.readings(spark, sf).select(body.alias("value")))
    return i.plain_times(checked).select(
        "device_id", F.col("cycle_index").cast("double").alias("cycle_index"), "cooler_efficiency_pct", "event_ts", "problem",
        F.element_at("features", F.lit("note")).alias("feature_note"))


@query("event_extras", with_ctes(i.READINGS, select="""
SELECT "offset", CASE WHEN k NOT IN (0, 8) THEN sensor END AS device_id, CASE WHEN k NOT IN (7, 8) THEN 'fw-' || (cycle % 5) END AS firmware,
       CASE WHEN k <> 8 THEN cycle::DOUBLE % 13 END AS bay, CASE WHEN k = 6 THEN 'n/a' END AS feature_note,
       CASE WHEN k = 0 THEN 'device_id missing' WHEN k = 8 THEN 'not an object' END AS problem,
       k IN (0, 8) AS has_body, CASE WHEN k = 8 THEN '{broken' END AS broken_body
FROM (SELECT *, "offset" % 11 AS k FROM readings)"""))
def event_extras(spark, sf):
    """Fields that no schema lists, one of them nested, and the bodies of what is turned away."""
    k = F.col("offset") % 11
    body = F.when(k == 8, F.lit("{broken")).otherwise(F.to_json(F.struct(
        F.when(k != 0, F.col("sensor")).alias("device_id"), F.col("cycle").alias("cycle_index"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_time"), F.col("value").alias("cooler_efficiency_pct"),
        F.when(k == 6, F.create_map(F.lit("note"), F.lit("n/a"))).alias("features"),
        F.when(k != 7, F.concat(F.lit("fw-"), (F.col("cycle") % 5).cast("string"))).alias("firmware"),
        F.struct(F.struct((F.col("cycle") % 13).alias("bay")).alias("place")).alias("site"))))
    valid, rejected = messages.split_events(messages.open_events(i.readings(spark, sf).select(body.alias("value"), "offset"), keep=("offset",)))
    both = valid.unionByName(rejected, allowMissingColumns=True)
    return both.select("offset", "device_id", messages.extra("firmware", "string").alias("firmware"), messages.extra("site.place.bay", "double").alias("bay"),
                       messages.extra("features.note", "string").alias("feature_note"), "problem", F.col("body").isNotNull().alias("has_body"),
                       F.when(F.col("problem") == "not an object", F.col("body")).alias("broken_body"))


@query("csv_mapping", with_ctes(i.READINGS, select="""
SELECT sensor AS device_id, cycle::BIGINT AS cycle_index, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
       value AS cooler_efficiency_pct, value * 2 AS pressure1_bar, CAST(NULL AS DOUBLE) AS pressure2_bar,
       CAST("offset" AS DOUBLE) AS "temperature_cooler_out_C"
FROM readings"""))
def csv_mapping(spark, sf):
    path = scratch_path(spark, "mapped-csv")
    source = i.readings(spark, sf).select(
        F.col("sensor").alias("device_id"), F.col("cycle").alias("cycle_index"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"), F.col("value").alias("cooler_efficiency"),
        (F.col("value") * 2).alias("pressure1"), F.lit(None).cast("double").alias("pressure2"),
        F.col("offset").alias("temperature_cooler_out"))
    archive.write_csv(source.select(*CSV_MAPPING), path)
    return files.read_mapped_csv(spark, path)


def matrix_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Cycle lines: the vector of each ``embeddings`` row as tab-separated text."""
    text = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), "\t")
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        F.col("vec_id").cast("int").alias("cycle"), text.alias("value"))


@query("matrix_unpivot", f"""
SELECT CAST(vec_id AS INT) AS cycle, CAST(j - 1 AS INT) AS sample_idx, {r('CAST(embedding[j] AS DOUBLE)')} AS value
FROM embeddings, unnest(range(1, len(embedding) + 1)) t(j)""")
def matrix_unpivot(spark, sf):
    return files.matrix_samples(matrix_lines(spark, sf)).withColumn("value", fixed("value"))


@query("matrix_scan", f"""
SELECT sensor, cycle, CAST(j - 1 AS INT) AS sample_idx, {r('CAST(embedding[j] AS DOUBLE)')} AS value,
       CAST(CASE WHEN sensor LIKE 'PS%' OR sensor = 'EPS1' THEN 100 WHEN sensor LIKE 'FS%' THEN 10 ELSE 1 END AS INT) AS sampling_rate_hz
FROM (SELECT sensor, embedding, CAST(row_number() OVER (PARTITION BY sensor ORDER BY vec_id) - 1 AS INT) AS cycle
      FROM (SELECT [{i._NAMES}][1 + vec_id % {len(SENSOR_NAMES)}] AS sensor, vec_id, embedding FROM embeddings)),
     unnest(range(1, len(embedding) + 1)) t(j)""")
def matrix_scan(spark, sf):
    """Matrices of all sensors written as text, a folder of files each, and read back; the cycle is the line's number."""
    path = scratch_path(spark, "matrices")
    sensor = F.get(F.array(*[F.lit(s) for s in SENSOR_NAMES]), F.col("cycle") % len(SENSOR_NAMES))
    (matrix_lines(spark, sf).withColumn("sensor", sensor).repartitionByRange("sensor", "cycle")
     .sortWithinPartitions("sensor", "cycle").select("sensor", "value").write.partitionBy("sensor").text(path))
    return files.read_matrices(spark, path, folders=True).withColumn("value", fixed("value"))


@query("cycle_count", "SELECT CAST(count(*) AS BIGINT) AS cycles FROM embeddings")
def cycle_count(spark, sf):
    path = scratch_path(spark, "matrix")
    matrix_lines(spark, sf).select("value").write.text(path)
    return files.count_cycles(spark, path).agg(F.sum("cycles").alias("cycles"))


def label_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Label lines of ``customer``; every 25th has a field too few."""
    fields = [F.col(n).cast("double").cast("string") for n in LABEL_NAMES]
    full = F.concat_ws("  ", *fields)
    short = F.concat_ws("  ", *fields[:-1])
    wordy = F.concat_ws("  ", *fields[:-1], F.lit("x"))
    return i.labels(spark, sf).select("cycle", F.when(F.col("cycle") % 25 == 7, short).when(F.col("cycle") % 25 == 8, wordy)
                                      .otherwise(full).alias("value"))


@query("label_parse", with_ctes(i.LABELS, select="SELECT * FROM labelled WHERE cycle % 25 NOT IN (7, 8)"))
def label_parse(spark, sf):
    return files.parse_label_lines(label_lines(spark, sf))


@query("label_rejects", with_ctes(i.LABELS, select="SELECT cycle FROM labelled WHERE cycle % 25 IN (7, 8)"))
def label_rejects(spark, sf):
    return files.malformed_label_lines(label_lines(spark, sf)).select("cycle")


@query("label_preview", with_ctes(i.LABELS, select="SELECT * FROM labelled ORDER BY cycle DESC LIMIT 20"))
def label_preview(spark, sf):
    """The last cycles' labels."""
    from rigwatch.operators.ordered import newest

    return newest(i.labels(spark, sf), ["cycle"], 20)


@query("label_scan", with_ctes(i.LABELS, select="""
SELECT CAST(row_number() OVER (ORDER BY cycle) - 1 AS INT) AS line, cycle, label_cooler, label_valve, label_pump,
       label_accumulator, label_stable
FROM labelled"""))
def label_scan(spark, sf):
    """Labels written as text, ranges of cycles a file, and numbered where they are read.

    The number of lines in the files before is added; there is a row per file to order.
    """
    path = scratch_path(spark, "label-lines")
    fields = [F.col(n).cast("string") for n in ("cycle", *LABEL_NAMES)]
    (i.labels(spark, sf).repartitionByRange("cycle").sortWithinPartitions("cycle")
     .select(F.concat_ws("\t", *fields).alias("value")).write.text(path))
    lines = files.numbered_lines(spark, path).select(
        "file", "line", F.split_part("value", F.lit("\t"), F.lit(1)).cast("int").alias("cycle"),
        F.regexp_replace("value", r"^[^\t]*\t", "").alias("value"))
    per_file = lines.groupBy("file").agg(F.min("cycle").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(per_file.select("file", before.alias("before")), "file")
    return files.parse_label_lines(placed.select((F.col("before") + F.col("line")).cast("int").alias("line"), "cycle", "value"))


@query("label_scan_one_based", with_ctes(i.LABELS, select="""
SELECT line AS cycle, label_cooler, label_valve, label_pump, label_accumulator, label_stable
FROM (SELECT *, CAST(row_number() OVER (ORDER BY cycle) AS INT) AS line FROM labelled) WHERE cycle % 25 NOT IN (7, 8)"""))
def label_scan_one_based(spark, sf):
    """Labels read from text with cycles from 1; malformed lines keep their number and give no row."""
    path = scratch_path(spark, "label-profile")
    label_lines(spark, sf).repartitionByRange("cycle").sortWithinPartitions("cycle").select("value").write.text(path)
    return files.read_label_file(spark, path, cycle_offset=1, through_folder=True)


@query("label_table", with_ctes(i.LABELS, select="SELECT * FROM labelled"))
def label_table(spark, sf):
    path = scratch_path(spark, "labels-tsv")
    i.labels(spark, sf).write.option("sep", "\t").csv(path)
    return files.read_label_table(spark, path)


@query("cycle_range", with_ctes(i.READINGS, select="""
SELECT cycle, sensor, ts, value, "offset" FROM readings WHERE cycle >= 5 AND cycle < 12"""))
def cycle_range(spark, sf):
    return files.cycle_range(i.readings(spark, sf), 5, 12).select("cycle", "sensor", "ts", "value", "offset")


@query("cycle_sample", with_ctes(i.READINGS, """
drawn AS (SELECT draw, CAST(CAST('0x' || substr(md5('7:' || draw), 1, 8) AS BIGINT)
                            % (SELECT max(cycle) + 1 FROM readings) AS INT) AS cycle
          FROM range(10) t(draw))""", select="""
SELECT draw, cycle, sensor, ts, value, "offset" FROM readings JOIN drawn USING (cycle)"""))
def cycle_sample(spark, sf):
    source = i.readings(spark, sf)
    total = source.agg(F.max("cycle")).first()[0] + 1
    return files.sample_cycles(source, 10, total, seed=7).select("draw", "cycle", "sensor", "ts", "value", "offset")


def _write_archive(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "raw")
    archive.write_parquet(i.readings(spark, sf), path, ["sensor"])
    return path


@query("archive_scan", with_ctes(i.READINGS, select="""
SELECT sensor, cycle, ts, value, "offset" FROM readings WHERE sensor = 'TS2' AND cycle = 3"""))
def archive_scan(spark, sf):
    path = _write_archive(spark, sf)
    chosen = files.scan_parquet(spark, path, {"sensor": "TS2", "cycle": 3})
    return chosen.select("sensor", "cycle", "ts", "value", "offset")


@query("fallback_scan", with_ctes(i.READINGS, select="""
SELECT sensor, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM readings GROUP BY sensor"""))
def fallback_scan(spark, sf):
    path = _write_archive(spark, sf)
    source = files.scan_with_fallback(spark, [f"{path}-primary-is-absent", path])
    return source.groupBy("sensor").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


_DAILY = """SELECT date_trunc('day', ts)::TIMESTAMP AS date, count(*) AS {n} FROM readings
WHERE ts {op} TIMESTAMP '2024-01-16' GROUP BY 1"""


def _dated_archive(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "dated")
    archive.write_parquet(i.readings(spark, sf).withColumn("date", F.to_date("ts")), path, ["date"])
    return path


@query("retention", with_ctes(i.READINGS, select=_DAILY.format(n="n", op=">=")))
def retention(spark, sf):
    path = _dated_archive(spark, sf)
    archive.apply_retention(spark, path, "date", date(2024, 1, 16))
    kept = spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return i.day_as_time(kept, "date")


@query("expired_partitions", with_ctes(i.READINGS, select=_DAILY.format(n="rows", op="<")))
def expired_partitions(spark, sf):
    source = i.readings(spark, sf).withColumn("date", F.to_date("ts"))
    return i.day_as_time(archive.expired_partitions(source, "date", date(2024, 1, 16)), "date")


@query("labelled_export", with_ctes(i.READINGS, i.LABELS, select=f"""
SELECT cycle, {r('avg(value)')} AS mean_value, count(*) AS n, any_value(label_cooler) AS label_cooler
FROM readings JOIN labelled USING (cycle) GROUP BY cycle"""))
def labelled_export(spark, sf):
    """Labelled rows written as CSV with a header and read back."""
    path = scratch_path(spark, "labelled-csv")
    means = i.readings(spark, sf).groupBy("cycle").agg(F.avg("value").alias("mean_value"), F.count(F.lit(1)).alias("n"))
    archive.write_csv(means.join(i.labels(spark, sf).select("cycle", "label_cooler"), "cycle"), path)
    back = spark.read.schema("cycle int, mean_value double, n long, label_cooler int").option("header", "true").csv(path)
    return rounded(back, "mean_value")


_CATALOG = ", ".join(
    f"('{s.sensor}', '{s.family}', '{s.unit}', {s.rate_hz}, {s.rate_hz * 60}, {100 // s.rate_hz})" for s in SENSORS)


@query("sensor_catalog", with_ctes(i.READINGS, f"""
catalog AS (SELECT * FROM (VALUES {_CATALOG}) c(sensor, family, unit, rate_hz, samples_per_cycle, upsample))""", select="""
SELECT sensor, family, unit, rate_hz, samples_per_cycle, upsample, count(cycle) AS sample_count
FROM catalog LEFT JOIN readings USING (sensor) GROUP BY ALL"""))
def sensor_catalog(spark, sf):
    """The sensor dimension beside the samples received; counted before the join."""
    return sensor_table(spark).join(monitoring.sample_counts(i.readings(spark, sf)), "sensor", "left").na.fill(0, ["sample_count"])


@query("stored_records", with_ctes(i.READINGS, select="""
SELECT sensor, ts, value, "offset", (SELECT count(*) FROM readings) AS records
FROM readings ORDER BY ts DESC, "offset" DESC LIMIT 2"""))
def stored_records(spark, sf):
    """Record count of a stored collection beside its two newest rows."""
    from rigwatch.operators.ordered import newest

    stored = i.readings(spark, sf)
    counted = monitoring.sample_counts(stored).agg(F.sum("sample_count").alias("records")).first()[0]
    return newest(stored, ["ts", "offset"]).select("sensor", "ts", "value", "offset", F.lit(counted).cast("long").alias("records"))
