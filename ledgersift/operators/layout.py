"""Joins to the type lookup, partitioning choices and their report."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.schema import RISK_SCORES


def risk_lookup(spark: SparkSession) -> DataFrame:
    """Type -> risk score; one row per transaction type."""
    rows = ", ".join(f"('{kind}', {score}D)" for kind, score in RISK_SCORES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(type, risk_score)")


def join_risk(tx: DataFrame, lookup: DataFrame, broadcast: bool = False) -> DataFrame:
    """Attach the type's risk score. Hint only for lookups known to be small."""
    side = F.broadcast(lookup) if broadcast else lookup
    return tx.join(side, "type", "left")


def by_amount_range(df: DataFrame, partitions: int = 100) -> DataFrame:
    return df.repartitionByRange(partitions, "amount")


def by_type(df: DataFrame, salts: int = 1, id_col: str = "tx_id") -> DataFrame:
    """Co-locate rows by type; with ``salts`` each type spreads over that many partitions."""
    if salts <= 1:
        return df.repartition("type")
    return df.repartition("type", F.pmod(F.xxhash64(id_col), F.lit(salts)))


@contextmanager
def kept(*frames: DataFrame):
    """Persist frames, spilling to disk, for the length of a ``with`` block."""
    for df in frames:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frames
    finally:
        for df in frames:
            df.unpersist()


#: Fewer rows are not worth a task of their own; more tasks than this for each core neither.
TASK_ROWS, TASKS_PER_CORE = 16_384, 2


def dealt(df: DataFrame, key: str, n_rows: int) -> DataFrame:
    """The rows in even partitions by a unique key, for work that goes over them again and again."""
    most = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(most, -(-n_rows // TASK_ROWS))), key)


def partition_report(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows per partition: least, most, mean, skew ratio and warning.

    ``partitions`` is the planned number, so that empty ones count; without it
    only partitions that hold rows are seen.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(
        F.count(F.lit(1)).alias("filled"),
        F.min("n").alias("least"),
        F.max("n").alias("max_rows"),
        F.sum("n").alias("total"),
    )
    planned = F.col("filled") if partitions is None else F.lit(partitions)
    ratio = F.col("max_rows") / F.col("avg_rows")
    return totals.select(
        planned.cast("int").alias("partitions"),
        F.when(F.col("filled") < planned, 0).otherwise(F.col("least")).alias("min_rows"),
        "max_rows",
        (F.col("total") / planned).alias("avg_rows"),
    ).withColumns({"skew_ratio": ratio, "skewed": ratio > 2})
