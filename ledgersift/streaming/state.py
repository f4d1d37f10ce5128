"""The feature cache kept in the state store of a stream: one entry per entity, with expiry.

Each entity's newest row is a value of its state. Tasks reduce their messages to the newest of
each entity in an Arrow batch before the shuffle, so hot entities send few rows. A timer on event time removes it once the
watermark has passed its expiry, so the state holds live entries only. Readers take the
entries from the state store itself; no batch is aggregated again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import ledgersift.streaming as package
from ledgersift.operators.cache import TTL_SECONDS
from ledgersift.streaming.sinks import StreamJob

# Functions sent to executors travel by value, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(package)

#: The state store that holds timers and typed values.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = "spark.sql.streaming.stateStore.providerClass"


def _millis(moment) -> int:
    return int(pd.Timestamp(moment).timestamp() * 1000)


@contextmanager
def state_store(spark: SparkSession):
    """Streams started inside the block keep timers and typed values."""
    before = spark.conf.get(_STATE_CONF)
    spark.conf.set(_STATE_CONF, STATE_STORE)
    try:
        yield
    finally:
        spark.conf.set(_STATE_CONF, before)


def newest_of_batches(events: DataFrame, entity: str, time: str, tie: str) -> DataFrame:
    """The newest row by (time, tie) of each entity in every Arrow batch; older ones change nothing.

    Rows without a time or a tie are left to the state operator.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = pc.and_(batch.column(time).is_valid(), batch.column(tie).is_valid())
            places = pa.table({"entity": batch.column(entity), "time": batch.column(time), "tie": batch.column(tie), "place": pa.array(range(batch.num_rows))})
            ordered = places.filter(known).sort_by([("time", "ascending"), ("tie", "ascending")])
            last = ordered.group_by("entity", use_threads=False).aggregate([("place", "last")]).column("place_last")
            others = places.filter(pc.invert(known)).column("place")
            yield batch.take(pa.array(sorted(last.to_pylist() + others.to_pylist()), type=pa.int64()))

    return events.mapInArrow(run, events.schema)


class NewestEntry(StatefulProcessor):
    """Keeps the newest row of an entity by (time, tie) until its time to live has passed."""

    def __init__(self, kind: T.StructType, time: str, tie: str, seconds: int):
        self.kind, self.time, self.tie, self.seconds = kind, time, tie, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", self.kind)

    def _expiry(self, row: tuple) -> int:
        return _millis(row[self.kind.names.index(self.time)]) + 1000 * self.seconds

    def _order(self, row: tuple) -> tuple:
        return _millis(row[self.kind.names.index(self.time)]), row[self.kind.names.index(self.tie)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = tuple(self.entry.get()) if self.entry.exists() else None
        newest = held
        for part in rows:
            last = (part if len(part) == 1 else part.sort_values([self.time, self.tie])).iloc[-1]
            row = tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else (v.item() if hasattr(v, "item") else v) for v in last[self.kind.names])
            if newest is None or self._order(row) > self._order(newest):
                newest = row
        if newest is not held and newest is not None:
            if held is not None:
                self.handle.deleteTimer(self._expiry(held))
            self.entry.update(newest)
            self.handle.registerTimer(self._expiry(newest))
        return iter(())  # a table for each entity, empty or not, would cost more than its state

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.entry.clear()
        at = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        yield pd.DataFrame({"entity": [str(key[0])], "expired_at": [at]})

    def close(self) -> None:
        pass


def start_cache_state(
    events: DataFrame,
    path: str,
    checkpoint: str,
    entity: str = "nameOrig",
    time: str = "ts",
    tie: str = "tx_id",
    kind: str = "account",
    late: str = "10 minutes",
    once: bool = False,
) -> StreamJob:
    """Feed the state from a stream; the expired entries go to files at ``path``."""
    spark = events.sparkSession
    payload = [c for c in events.columns if c != entity]
    cast = events.withColumn(time, F.col(time).cast("timestamp"))
    # the newest message of all is the newest of its entity, so the watermark is the same
    zoned = newest_of_batches(cast, entity, time, tie).withWatermark(time, late)
    types = T.StructType([zoned.schema[c] for c in payload])
    with state_store(spark):
        expired = zoned.groupBy(entity).transformWithStateInPandas(
            statefulProcessor=NewestEntry(types, time, tie, TTL_SECONDS[kind]),
            outputStructType="entity string, expired_at timestamp",
            outputMode="append",
            timeMode="EventTime",
        )
        writer = expired.writeStream.option("checkpointLocation", checkpoint).outputMode("append").format("parquet")
        if once:
            writer = writer.trigger(availableNow=True)
        return StreamJob([writer.start(path)])


def read_cache_state(
    spark: SparkSession, checkpoint: str, time: str = "ts", kind: str = "account"
) -> DataFrame:
    """The live entries of a state that is not being written: cache_key, columns, cached_at, expires_at."""
    with state_store(spark):
        state = spark.read.format("statestore").option("stateVarName", "entry").load(checkpoint)
    rest = [f.name for f in state.schema["value"].dataType if f.name != time]
    cached = F.col(f"value.{time}")
    entity = F.col("key").getField(state.schema["key"].dataType.names[0])
    return state.select(
        F.concat(F.lit(f"{kind}:"), entity.cast("string")).alias("cache_key"),
        *[F.col(f"value.{c}").alias(c) for c in rest],
        cached.alias("cached_at"),
        (cached + F.expr(f"INTERVAL {TTL_SECONDS[kind]} SECOND")).alias("expires_at"),
    )
