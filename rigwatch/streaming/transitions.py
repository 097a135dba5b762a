"""Changes of status, and staleness, as they happen."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

SCHEMA = "sensor string, type string, changed_at timestamp, state string, previous string"
NAMES = ("normal", "raised")
STALE = "stale"


def _moment(millis: int) -> datetime:
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


class StatusTransitions(StatefulProcessor):
    """One (sensor, type): the windows that wait for the watermark, and the last status seen.

    Windows are taken in order of their end, when the watermark has passed it; so the order in which they
    arrive does not matter. A timer stands at the end of every window and at the moment a series gets stale.
    """

    def __init__(self, stale_after: timedelta):
        self.stale = round(stale_after.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "state string, seen long")
        self.waiting = handle.getMapState("waiting", "window_end long", "window_start long, status int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for row in rows:
            self.waiting.updateValue((row.end_ms,), (row.start_ms, row.status))
            self.handle.registerTimer(row.end_ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        state, seen = (self.last.get() if self.last.exists() else (None, None))
        if self.waiting.containsKey((at,)):
            start, status = self.waiting.getValue((at,))
            self.waiting.removeKey((at,))
            if seen is not None and state != STALE and at - seen > self.stale:
                yield self._row(key, seen + self.stale, STALE, state)
                state = STALE
            if NAMES[status] != state:
                yield self._row(key, start, NAMES[status], state)
            state, seen = NAMES[status], at
            self.last.update((state, seen))
            if watermark <= seen + self.stale:
                self.handle.registerTimer(seen + self.stale)
        # Windows that end before the moment of staleness have timers of their own, which come first.
        if state not in (None, STALE) and watermark > seen + self.stale and not any(
                end <= seen + self.stale for (end,) in self.waiting.keys()):
            yield self._row(key, seen + self.stale, STALE, state)
            self.last.update((STALE, seen))

    @staticmethod
    def _row(key, millis: int, state: str, previous: str | None) -> Row:
        return Row(sensor=key[0], type=key[1], changed_at=_moment(millis), state=state, previous=previous)

    def close(self) -> None:
        pass


def status_transitions(status: DataFrame, stale_after: timedelta) -> DataFrame:
    """A row whenever the status of a (sensor, type) changes or goes stale.

    ``status`` has ``sensor, type, window_start, window_end, status`` and a watermark on ``window_end``. A status holds
    from the start of its first window; a series is stale when no window has ended for longer than ``stale_after``, from that
    moment on. State: one status per series and the windows ahead of the watermark.
    """
    rows = status.select("sensor", "type", "window_end", F.unix_millis("window_start").alias("start_ms"),
                         F.unix_millis("window_end").alias("end_ms"), "status")
    return rows.groupBy("sensor", "type").transformWithState(StatusTransitions(stale_after), SCHEMA, "append", "eventTime")
