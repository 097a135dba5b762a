"""Result tables that several micro-batches write: newest row per key, in a bounded number of files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from rigwatch.operators.ordered import forward_fill, latest_by, over_previous_rows
from rigwatch.operators.rules import DEFAULT_RULES, Rule, fired_types

EVERY = 10                # micro-batches between two snapshots
KEEP = timedelta(days=1)  # rows older than this, by the newest one, are final


class KeyedTable:
    """The newest row of every key.

    A micro-batch writes the rows it changed to a folder of its own, which a repeated batch
    overwrites. Every ``every`` batches the state is written as a snapshot; readers take the newest complete
    snapshot and the folders after it. What a snapshot replaces stays until the next one, for readers that
    are still at it. With ``final`` (a time column) rows more than ``keep`` older than the newest one leave the
    state at a snapshot, for an archive that is only added to, so a snapshot costs as much as the open rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType, every: int = EVERY,
                 final: str | None = None, keep: timedelta = KEEP):
        self.spark, self.path, self.keys, self.schema = spark, path, list(keys), schema
        self.every, self.final, self.keep = every, final, keep
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self, kind: str) -> list[int]:
        """Batches that have a complete folder of a kind, in order."""
        at = self._path(f"{self.path}/{kind}")
        if not self._files.exists(at):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit() and self._files.exists(self._path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _folders(self, kind: str, numbers: Sequence[int]) -> DataFrame:
        paths = [f"{self.path}/{kind}/{n}" for n in numbers]
        if not paths:
            return self.spark.createDataFrame([], self.schema).withColumn("_batch", F.lit(-1))
        frames = self.spark.read.schema(self.schema).parquet(*paths)
        return frames.withColumn("_batch", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).cast("int"))

    def covers(self, batch_id: int) -> bool:
        """Whether a snapshot holds the batch: then it was written whole before."""
        return any(n >= batch_id for n in self._numbers("snapshot"))

    def changed(self, batch_id: int) -> DataFrame:
        """The rows that a batch wrote."""
        return self._folders("batch", [batch_id]).drop("_batch")

    def open_rows(self, before: int | None = None) -> DataFrame:
        """Newest row per key of the rows that may still change, from batches under ``before``."""
        def under(kind: str) -> list[int]:
            return [n for n in self._numbers(kind) if before is None or n < before]
        last = max(under("snapshot"), default=-1)
        rows = self._folders("batch", [n for n in under("batch") if n > last])
        if last >= 0:
            rows = rows.union(self._folders("snapshot", [last]))
        columns = [c for c in self.schema.names if c not in self.keys]
        return latest_by(rows, self.keys, F.col("_batch"), columns).select(*self.schema.names)

    def read(self) -> DataFrame:
        """The table: open and final rows."""
        last = max(self._numbers("snapshot"), default=-1)
        final = self._folders("final", [n for n in self._numbers("final") if n <= last])
        return final.drop("_batch").union(self.open_rows())

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Write the rows that a batch changed, one per key."""
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/batch/{batch_id}")

    def settle(self, batch_id: int) -> None:
        """After everything of a batch is written: every few batches write a snapshot and drop what it makes needless."""
        if (batch_id + 1) % self.every or self.covers(batch_id):
            return
        older = [n for n in self._numbers("snapshot") if n < batch_id]
        state = self.open_rows(batch_id + 1)
        if self.final:
            newest = state.agg(F.max(self.final)).first()[0]
            done = F.coalesce(F.col(self.final) < F.lit(newest - self.keep), F.lit(False)) if newest else F.lit(False)
            state.where(done).write.mode("overwrite").parquet(f"{self.path}/final/{batch_id}")
            state = state.where(~done)
        state.write.mode("overwrite").parquet(f"{self.path}/snapshot/{batch_id}")
        kept = max(older, default=-1)  # the snapshot before and its batches stay for readers at work
        for kind in ("snapshot", "batch"):
            for n in self._numbers(kind):
                if n < kept or (kind == "batch" and n == kept):
                    self._files.delete(self._path(f"{self.path}/{kind}/{n}"), True)


def _start(df: DataFrame, write: Callable, mode: str, checkpoint: str, trigger: str | None) -> StreamingQuery:
    from rigwatch.streaming.jobs import _with_trigger
    return _with_trigger(df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint), trigger).start()


class WindowTables:
    """Statistics, alerts and current state of the sensors from one stateful query in update mode.

    ``windows`` has the statistics of every window and the alert types raised for it so far; ``alerts`` has each
    (window, sensor, type) once, when it is raised first, however often the window is updated; ``current`` has
    the newest window per sensor. A repeated batch gives the same files: it starts from the batches before it.
    ``publish`` gets what a batch changed and its new alerts, once more when the batch is repeated.
    """

    WINDOW = ("sensor", "window_start", "window_end")

    def __init__(self, spark: SparkSession, stats: DataFrame, path: str, rules: list[Rule] = DEFAULT_RULES,
                 every: int = EVERY, keep: timedelta = KEEP, publish: Callable[[DataFrame, DataFrame], None] | None = None):
        self.stats, self.rules, self.publish = stats, rules, publish
        types, fields = ArrayType(StringType()), stats.schema.fields
        window = StructType([*fields, StructField("alerted", types), StructField("new_alerts", types)])
        alert = StructType([*fields, StructField("type", StringType())])
        self.windows = KeyedTable(spark, f"{path}/windows", self.WINDOW, window, every, "window_end", keep)
        self.alerts = KeyedTable(spark, f"{path}/alerts", (*self.WINDOW, "type"), alert, every, "window_end", keep)
        self.current = KeyedTable(spark, f"{path}/current", ("sensor",), StructType([*fields]), every)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():  # a batch that only moves the watermark changes nothing
            self._write(batch, batch_id)
        for table in (self.windows, self.alerts, self.current):
            table.settle(batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.windows.covers(batch_id):
            none = F.array().cast("array<string>")
            known = self.windows.open_rows(batch_id).select(*self.WINDOW, F.col("alerted").alias("known"))
            rows = (batch.withColumn("fired", fired_types(self.rules)).join(known, list(self.WINDOW), "left")
                    .withColumn("known", F.coalesce("known", none)))
            self.windows.put(rows.withColumn("alerted", F.array_union("known", "fired"))
                             .withColumn("new_alerts", F.array_except("fired", "known")), batch_id)
        changed = self.windows.changed(batch_id)  # read back: the stream's batch is computed once
        if not self.alerts.covers(batch_id):
            alerts = changed.select(*self.stats.columns, F.explode("new_alerts").alias("type"))
            self.alerts.put(alerts, batch_id)
            if self.publish:
                self.publish(changed.select(*self.stats.columns), alerts)
        if not self.current.covers(batch_id):
            rows = self.current.open_rows(batch_id).withColumn("_b", F.lit(0)).unionByName(
                changed.select(*self.stats.columns, F.lit(1).alias("_b")))
            order = F.unix_micros("window_end") * 2 + F.col("_b")
            self.current.put(latest_by(rows, ["sensor"], order, [c for c in self.stats.columns if c != "sensor"]), batch_id)

    def start(self, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
        return _start(self.stats, self.write, "update", checkpoint, trigger)


class CarriedColumns:
    """Forward fill, rate of change and rolling mean over what streams in.

    ``wide`` is an append-mode stream of window records. The last filled values and the last
    ``rows - 1`` values of each key are kept in a table keyed by micro-batch, and precede the next batch's rows; so the
    results equal those of the batch operators over all records, also after a batch was repeated.
    """

    def __init__(self, spark: SparkSession, wide: DataFrame, path: str, keys: Sequence[str], time_col: str, fill: Sequence[str],
                 value: str, seconds: float, rows: int = 6, every: int = EVERY):
        self.spark, self.wide, self.path = spark, wide, path
        self.keys, self.time_col, self.fill, self.value = list(keys), time_col, list(fill), value
        self.seconds, self.rows = seconds, rows
        self.slim = list(dict.fromkeys([time_col, value, *fill]))
        tail = wide.select(F.array(F.struct(*self.slim)).alias("tail")).schema
        state = StructType([wide.schema[k] for k in self.keys] + [tail["tail"]])
        self.tails = KeyedTable(spark, f"{path}/tails", self.keys, state, every)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        if not self.tails.covers(batch_id) and not batch.isEmpty():
            self._write(batch, batch_id)
        self.tails.settle(batch_id)

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/rows/{batch_id}")
        rows = self.spark.read.schema(self.wide.schema).parquet(f"{self.path}/rows/{batch_id}")
        touched = rows.select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        before = self.tails.open_rows(batch_id).join(touched, on, "left_semi")
        seeds = before.select(*self.keys, F.inline("tail"))
        both = rows.withColumn("_seed", F.lit(False)).unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
        filled = forward_fill(both, self.keys, self.time_col, self.fill)
        back = self.rows - 1
        done = over_previous_rows(filled, self.keys, self.time_col, [self.value], back, {
            f"{self.value}_rate": lambda w: (F.col(self.value) - F.lag(self.value, 1).over(w)) / F.lit(float(self.seconds)),
            f"{self.value}_rolling": lambda w: F.avg(self.value).over(w.rowsBetween(-back, 0))})
        done.where("NOT _seed").drop("_seed").write.mode("overwrite").parquet(f"{self.path}/data/{batch_id}")
        # The newest rows of a key with their filled values: all that later rows need. Bounded: the rows kept are few.
        last = F.struct(self.time_col, F.col(self.value).alias(self.value), *[
            F.col(f"{c}_interpolated").alias(c) for c in self.fill if c not in (self.time_col, self.value)])
        newest = Window.partitionBy(*self.keys).orderBy(F.col(self.time_col).desc())
        kept = filled.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= back)
        self.tails.put(kept.groupBy(*self.keys).agg(F.sort_array(F.collect_list(last)).alias("tail")), batch_id)

    def start(self, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
        return _start(self.wide, self.write, "append", checkpoint, trigger)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/*")
