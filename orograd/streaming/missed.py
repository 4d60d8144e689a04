"""Hours that a feed owes: keyed state with event-time timers that reports an hour not come in time, and withdraws it when it comes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "feed string, hour timestamp, status string"


class _Expected(StatefulProcessor):
    """State of a feed: the next hour it owes, hours come before their turn, and hours reported as missed."""

    def __init__(self, lookback_ms: int) -> None:
        self.lookback = lookback_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "hour long")
        self.early = handle.getMapState("early", "hour long", "seen boolean")
        self.missed = handle.getMapState("missed", "hour long", "seen boolean")

    def _due(self, hour: int) -> int:
        """When an hour's data is overdue: its end plus the look-back."""
        return (hour + 1) * HOUR_MS + self.lookback

    def _rows(self, key, found: list[tuple[int, str]]) -> Iterator[pd.DataFrame]:
        if found:
            yield pd.DataFrame({"feed": key[0], "hour": pd.to_datetime([h * HOUR_MS for h, _ in found], unit="ms", utc=True), "status": [s for _, s in found]})

    def _advance(self, hour: int) -> int:
        while self.early.containsKey((hour,)):
            self.early.removeKey((hour,))
            hour += 1
        return hour

    def _wait(self, hour: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.next.update((hour,))
        self.handle.registerTimer(self._due(hour))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hours = sorted({int(h) for pdf in rows for h in pdf["hour_no"]})
        hour = self.next.get()[0] if self.next.exists() else hours[0]
        found = []
        for h in hours:
            if h >= hour:
                self.early.updateValue((h,), (True,))
            elif self.missed.containsKey((h,)):
                self.missed.removeKey((h,))
                found.append((h, "came"))
        self._wait(self._advance(hour))
        yield from self._rows(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        hour, now, found = self.next.get()[0], timerValues.getCurrentWatermarkInMs(), []
        while self._due(hour) <= now:
            self.missed.updateValue((hour,), (True,))
            found.append((hour, "missed"))
            hour = self._advance(hour + 1)
        self._wait(hour)
        yield from self._rows(key, found)

    def close(self) -> None:
        pass


def missed_hours(stream: DataFrame, *, feed: str = "feed", ts: str = "ts", arrived: str = "arrived", lookback_ms: int = 2 * HOUR_MS) -> DataFrame:
    """Changes `(feed, hour, status)`: `missed` when an hour's rows have not come `lookback_ms` after its end, `came` when they do later.

    Time is that of `arrived`, when rows landed, so late hours are not lost behind the watermark; any feed's arrivals move it, hence a silent feed is
    reported too. A feed owes every hour from the first it sent. Rows without a feed or time are ignored. Needs the RocksDB
    state store (`spark.sql.streaming.stateStore.providerClass`); `open_gaps` folds the changes to the present list.
    """
    rows = stream.where(F.col(feed).isNotNull() & F.col(ts).isNotNull() & F.col(arrived).isNotNull()).select(
        F.col(feed).cast("string").alias("feed"), F.floor(F.unix_timestamp(ts) / 3600).cast("long").alias("hour_no"), F.col(arrived).alias("arrived"))
    return rows.withWatermark("arrived", "0 seconds").groupBy("feed").transformWithStateInPandas(_Expected(lookback_ms), OUT, "update", "eventTime")


def open_gaps(changes: DataFrame) -> DataFrame:
    """(feed, hour) of the hours that are missed now. An hour is reported and withdrawn once each."""
    return changes.groupBy("feed", "hour").agg(F.count(F.when(F.col("status") == "came", 1)).alias("_came")).where("_came = 0").drop("_came")
