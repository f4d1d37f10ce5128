"""Use of fitted models on whole frames."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.functions.features import with_defaults


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def score_batch(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Verdict per transaction; missing inputs take the request-path defaults."""
    scored = model.transform(with_defaults(df))
    return scored.select(
        *[c for c in ("tx_id",) if c in df.columns],
        F.coalesce("nameOrig", F.lit("unknown")).alias("transaction_id"),
        (F.col("prediction") == 1.0).alias("is_fraud"),
        vector_to_array("probability")[1].alias("fraud_probability"),
        F.current_timestamp().alias("timestamp"),
    )
