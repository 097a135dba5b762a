"""Progress of streaming queries as rows."""

from __future__ import annotations

import threading
import time
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SCHEMA = "query string, batch_id long, input_rows long, input_per_second double, processed_per_second double"
METRICS = SCHEMA + ", run string, at string, read long, valid long, rejected long, late long"
COUNTERS = "ingest"   # name of the counters that ``counted`` adds


def _row(progress) -> tuple:
    def number(x):
        return float(x) if x is not None else None

    return (progress["name"] or progress["id"].__str__(), progress["batchId"], progress["numInputRows"],
            number(progress["inputRowsPerSecond"]), number(progress["processedRowsPerSecond"]))


def progress_table(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The progress reports the session still holds for a query (100 by default)."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], SCHEMA)


def counted(readings: DataFrame, valid) -> DataFrame:
    """Parsed messages with counters of what a micro-batch read and of what is valid, reported with its progress."""
    return readings.observe(COUNTERS, F.count(F.lit(1)).alias("read"), F.count(F.when(valid, 1)).alias("valid"))


class ProgressRecorder(StreamingQueryListener):
    """Appends the reports of all queries of a session to a table while they run.

    A report is a row per micro-batch: rates, the counters of :func:`counted`, and the rows that state operators dropped as
    late. At most ``every`` reports are held; if the table cannot be written, the newest ``HELD`` stay for the next attempt.
    """

    HELD = 10_000

    def __init__(self, spark: SparkSession | None = None, path: str | None = None, every: int = 20) -> None:
        self.spark, self.path, self.every = spark, path, every
        self._rows: deque = deque(maxlen=self.HELD)
        self._writing, self._ended = threading.Lock(), set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counters = p.observedMetrics.get(COUNTERS)
        read, valid = (counters["read"], counters["valid"]) if counters else (None, None)
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators) if p.stateOperators else None
        self._rows.append((p.name or str(p.id), p.batchId, p.numInputRows, p.inputRowsPerSecond, p.processedRowsPerSecond,
                           str(p.runId), p.timestamp, read, valid, None if read is None else read - valid, late))
        if self.path and len(self._rows) >= self.every:
            self.save(self.spark, self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if self.path:
            self.save(self.spark, self.path)
        self._ended.add(str(event.runId))

    def wait(self, *queries: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the last reports of ended queries have come; reports follow a query's end by a moment."""
        end = time.monotonic() + seconds
        while time.monotonic() < end and not self._ended >= {str(q.runId) for q in queries}:
            time.sleep(0.05)

    def table(self, spark: SparkSession) -> DataFrame:
        """The reports held, in the columns of :func:`progress_table`."""
        return spark.createDataFrame(list(self._rows), METRICS).select(*[f.split()[0] for f in SCHEMA.split(", ")])

    def save(self, spark: SparkSession, path: str) -> int:
        """Append the reports held to the table at ``path`` and let go of them; returns how many."""
        with self._writing:
            rows = [self._rows.popleft() for _ in range(len(self._rows))]
            try:
                if rows:
                    spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(path)
            except Exception:
                self._rows.extendleft(reversed(rows))
                raise
            return len(rows)
