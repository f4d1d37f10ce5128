"""Sinks, the alert job with several sinks, and the stream-fed feature cache."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgersift.operators.cache import latest_features
from ledgersift.session import work_path
from ledgersift.streaming.scoring import alert_messages, alerts, score, with_stream_features


def to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def to_console(df: DataFrame) -> StreamingQuery:
    return df.writeStream.format("console").option("truncate", False).outputMode("append").start()


def to_memory(df: DataFrame, name: str) -> StreamingQuery:
    """In-memory table for a dashboard; it grows on the driver, so feed it alerts only."""
    return df.writeStream.format("memory").queryName(name).outputMode("append").start()


def to_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", once: bool = False
) -> StreamingQuery:
    writer = df.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start(path)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Process all that is there now and return the written table."""
    out, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    to_files(stream, out, checkpoint, once=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_to_keyed_table(spark: SparkSession, stream: DataFrame, key: str, name: str) -> DataFrame:
    """Process all that is there now; the newest value of every key, open ones included.

    Each micro-batch writes the keys it changed to its own folder (again, if it is run
    again); reading takes every key from its latest batch.
    """
    out, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    sink = files_batch_sink(out, "parquet")
    writer.foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
    kind = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    batches = spark.read.schema(kind).parquet(out)
    latest = [F.max_by(c, "batch_id").alias(c) for c in stream.columns if c != key]
    return batches.groupBy(key).agg(*latest)


BatchSink = Callable[[DataFrame, int], None]


def files_batch_sink(path: str, fmt: str = "json") -> BatchSink:
    """One folder per micro-batch; a batch run again overwrites its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def kafka_batch_sink(servers: str, topic: str) -> BatchSink:
    def write(batch: DataFrame, batch_id: int) -> None:
        (
            alert_messages(batch)
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return write


@dataclass
class StreamJob:
    """Handle of the started queries."""

    queries: list[StreamingQuery] = field(default_factory=list)

    def await_all(self, timeout: float | None = None) -> None:
        for q in self.queries:
            q.awaitTermination(timeout) if timeout else q.awaitTermination()

    def stop(self) -> None:
        for q in self.queries:
            q.stop()

    @property
    def active(self) -> bool:
        return any(q.isActive for q in self.queries)


def start_alerts(
    messages: DataFrame,
    sinks: list[BatchSink],
    checkpoint: str,
    model: PipelineModel | None = None,
    once: bool = False,
) -> StreamJob:
    """Score the stream and hand each micro-batch of alerts to every sink.

    All sinks share one query, so the source is read and scored once.
    """
    found = alerts(score(with_stream_features(messages), model))

    def fan_out(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = found.writeStream.foreachBatch(fan_out).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return StreamJob([writer.start()])


def feed_cache(
    events: DataFrame,
    path: str,
    checkpoint: str,
    entity: str = "nameOrig",
    time: str = "ts",
    tie: str = "tx_id",
    kind: str = "account",
    once: bool = False,
) -> StreamJob:
    """Keep the newest row per entity: each batch adds its own newest rows."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        newest = latest_features(batch, entity, kind, time, tie)
        newest.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return StreamJob([writer.start()])


def read_cache(spark: SparkSession, path: str, tie: str = "tx_id") -> DataFrame:
    """Current cache entries: the newest per key over all batches."""
    entries = spark.read.parquet(path).drop("batch_id")
    rest = [c for c in entries.columns if c not in ("cache_key", "cached_at", tie)]
    newest = entries.groupBy("cache_key").agg(
        F.max(F.struct("cached_at", tie, *rest)).alias("r")
    )
    return newest.select("cache_key", *[f"r.{c}" for c in (tie, *rest)], "r.cached_at")


def compact_cache(spark: SparkSession, path: str, target: str) -> None:
    """Write the current entries alone to a new folder."""
    read_cache(spark, path).write.mode("overwrite").parquet(f"{target}/batch_id=0")
