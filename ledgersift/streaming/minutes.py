"""Messages per minute on a stream, empty minutes included, each as soon as it is final."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import ledgersift.streaming as package

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

MINUTE = 60_000
#: Minutes handed on at once.
_FRAME = 1440


def _frames(first: int, end: int, volumes: dict[int, int]) -> Iterator[pd.DataFrame]:
    """The minutes from ``first`` up to ``end`` (milliseconds), zero where no volume is known."""
    for start in range(first, end, _FRAME * MINUTE):
        at = list(range(start, min(end, start + _FRAME * MINUTE), MINUTE))
        yield pd.DataFrame({"minute": pd.to_datetime(at, unit="ms"), "volume": [volumes.get(m, 0) for m in at]})


class EveryMinute(StatefulProcessor):
    """Remembers the next minute that is due; a timer lets empty ones out once the watermark has passed them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "at bigint")

    def _wait(self, due: int) -> None:
        self.due.update((due,))
        self.handle.registerTimer(due + MINUTE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # one row for each minute that has become final and is not empty
        volumes: dict[int, int] = {}
        for part in rows:
            volumes.update(zip(part["at"].tolist(), part["volume"].tolist()))
        first = min(volumes)
        if self.due.exists():
            first = self.due.get()[0]
            self.handle.deleteTimer(first + MINUTE)
        end = max(volumes) + MINUTE
        yield from _frames(first, end, volumes)
        self._wait(end)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first = self.due.get()[0]
        end = timerValues.getCurrentWatermarkInMs() // MINUTE * MINUTE
        yield from _frames(first, end, {})
        self._wait(max(first, end))

    def close(self) -> None:
        pass


def every_minute(messages: DataFrame, time: str = "timestamp", late: str = "10 minutes") -> DataFrame:
    """minute and volume from the first message's minute to the watermark, without gaps.

    Messages are counted by minute first, in parallel; the operator that puts the minutes
    in a row sees one row a minute. Needs the state store of ``state.STATE_STORE``.
    """
    zoned = messages.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    counted = zoned.groupBy(F.window(time, "1 minute")).agg(F.count(F.lit(1)).alias("volume"))
    rows = counted.select(
        F.lit(0).alias("line"),
        F.window_time("window").alias("time"),
        F.unix_millis("window.start").alias("at"),
        "volume",
    )
    return rows.groupBy("line").transformWithStateInPandas(
        statefulProcessor=EveryMinute(),
        outputStructType="minute timestamp, volume bigint",
        outputMode="append",
        timeMode="EventTime",
    )
