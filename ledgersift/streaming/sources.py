"""Message sources. Every source ends in the same parsed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgersift.schema import MESSAGE_SCHEMA


def parse_messages(raw: DataFrame, schema: StructType = MESSAGE_SCHEMA) -> DataFrame:
    """JSON in the binary or string column ``value`` to typed columns."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return raw.select(parsed.alias("data")).select("data.*")


def read_kafka(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest"
) -> DataFrame:
    """Transactions from a Kafka topic (needs the Kafka package on the classpath)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return parse_messages(raw)


def read_json_files(
    spark: SparkSession,
    path: str,
    schema: StructType = MESSAGE_SCHEMA,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Transactions from JSON-lines files as they arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return parse_messages(reader.load(path), schema)
