"""Scoring of message streams; works on batch frames as well."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.functions.features import with_stream_features
from ledgersift.functions.scoring import fallback_score

__all__ = ["alert_messages", "alerts", "minute_counts", "score", "with_stream_features"]


def score(messages: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Add fraud probability, prediction and time; rules stand in for a missing model."""
    if model is None:
        scored = messages.withColumn("fraud_probability", fallback_score())
        hit = F.when(F.col("fraud_probability") > 0.5, 1.0).otherwise(0.0)
        scored = scored.withColumn("prediction", hit)
    else:
        p = vector_to_array("probability")[1]
        scored = model.transform(messages).withColumn("fraud_probability", p)
    return scored.withColumn("prediction_timestamp", F.current_timestamp())


def alerts(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("prediction") == 1.0)


def alert_messages(scored: DataFrame) -> DataFrame:
    """One JSON ``value`` per alert."""
    return scored.select(
        F.to_json(
            F.struct(
                F.col("nameOrig").alias("transaction_id"),
                "amount",
                "type",
                "fraud_probability",
                "prediction",
                "prediction_timestamp",
            )
        ).alias("value")
    )


def minute_counts(
    messages: DataFrame, time: str = "timestamp", late: str = "10 minutes"
) -> DataFrame:
    """Messages per minute; a minute is final once the watermark has passed it."""
    # Watermarks need a zoned timestamp.
    zoned = messages.withColumn(time, F.col(time).cast("timestamp"))
    minute = F.window(time, "1 minute")
    counted = zoned.withWatermark(time, late).groupBy(minute).agg(
        F.count(F.lit(1)).alias("volume")
    )
    return counted.select(F.col("window.start").alias("minute"), "volume")
