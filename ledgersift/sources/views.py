"""Transaction, event and log tables derived from the given star-schema tables.

Payments are read from orders and their customers, message streams and logs from
events. Streaming callers pass their own orders or events frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is inferred once per process, not once per query."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as an unbounded source of files."""
    # A pattern instead of the plain name: a file source takes a single file only that way.
    path = f"{sf_dir.rstrip('/')}/{name}[.]parquet"
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(path)


def transactions_from(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Payment rows from orders and the balances of their customers."""
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    key = F.col("o_orderkey")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    kind = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "TRANSFER")
        .when(F.col("o_orderpriority") == "2-HIGH", "CASH_OUT")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "CASH_IN")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "PAYMENT")
        .otherwise("DEBIT")
    )
    zero = F.lit(0.0)
    base = joined.select(
        key.alias("tx_id"),
        (day + 1).cast("int").alias("step"),
        kind.alias("type"),
        (F.col("o_totalprice") * F.col("o_totalprice") / F.lit(200000.0)).alias("amount"),
        (F.greatest(F.col("c_acctbal"), zero) * (key % 50 + 1).cast("double")).alias(
            "oldbalanceOrg"
        ),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("nameOrig"),
        F.concat(F.lit("M"), (key * 7919 % 997).cast("string")).alias("nameDest"),
        F.when(key % 3 == 0, zero)
        .otherwise((key % 1000 * 100).cast("double"))
        .alias("oldbalanceDest"),
        F.col("o_orderstatus").alias("st"),
    )
    old, amount, status = F.col("oldbalanceOrg"), F.col("amount"), F.col("st")
    after = base.withColumns(
        {
            "newbalanceOrig": F.when(status == "P", zero)
            .when(F.col("type") == "CASH_IN", old + amount)
            .when(status == "O", old - amount)
            .otherwise(F.greatest(old - amount, zero)),
            "newbalanceDest": F.when(status == "F", F.col("oldbalanceDest")).otherwise(
                F.col("oldbalanceDest") + amount
            ),
        }
    )
    drained = (
        F.col("type").isin("TRANSFER", "CASH_OUT")
        & (amount > 100000)
        & (F.col("newbalanceOrig") == 0)
        & (F.col("tx_id") % 4 != 0)
    )
    flagged = (F.col("type") == "TRANSFER") & (amount > 200000) & (status == "P")
    return after.select(
        "tx_id", "step", "type", "amount", "oldbalanceOrg", "newbalanceOrig", "nameOrig",
        "nameDest", "oldbalanceDest", "newbalanceDest",
        F.when(drained | (F.col("tx_id") % 500 == 0), 1).otherwise(0).alias("isFraud"),
        F.when(flagged, 1).otherwise(0).alias("isFlaggedFraud"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with missing values, negative amounts and repeated rows."""
    tx = transactions(spark, sf_dir)
    key, amount = F.col("tx_id"), F.col("amount")
    dirty = tx.withColumns(
        {
            "amount": F.when(key % 97 == 0, F.lit(None).cast("double"))
            .when(key % 131 == 0, -amount)
            .otherwise(amount),
            "type": F.when(key % 211 == 0, F.lit(None).cast("string")).otherwise(F.col("type")),
        }
    )
    repeats = F.when(key % 101 == 0, 2).otherwise(1)
    return dirty.withColumn("_copy", F.explode(F.sequence(F.lit(1), repeats))).drop("_copy")


def transaction_events_from(events: DataFrame) -> DataFrame:
    """Payment messages with an event time."""
    kind = (
        F.when(F.col("event_type") == "purchase", "TRANSFER")
        .when(F.col("event_type") == "signup", "CASH_OUT")
        .when(F.col("event_type") == "view", "CASH_IN")
        .when(F.col("event_type") == "click", "PAYMENT")
        .otherwise("DEBIT")
    )
    return events.select(
        F.col("event_id").alias("tx_id"),
        "ts",
        kind.alias("type"),
        (F.col("value") * 1000.0).alias("amount"),
        F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("nameOrig"),
    )


def transaction_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_events_from(table(spark, sf_dir, "events"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("endpoint"),
        F.col("value").alias("response_time_ms"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
    )


def host_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sample_id"),
        F.col("ts").alias("timestamp"),
        (value % 100.0).alias("cpu_percent"),
        (value * 1.7 % 100.0).alias("memory_percent"),
        (value * 2.3 % 100.0).alias("disk_usage_percent"),
    )
