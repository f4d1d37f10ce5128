"""Batch load: one scan that writes the rows and counts them on the way."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgersift.functions.features import with_etl_features
from ledgersift.operators.quality import cash_out_mismatch
from ledgersift.schema import CRITICAL_COLUMNS
from ledgersift.sources.files import MALFORMED, read_transactions_with_errors, write_partitioned

# Names of the recorded stages.
STAGES = (
    "data_loading", "data_validation", "feature_engineering", "fraud_filtering", "data_saving",
)


class EtlError(RuntimeError):
    """A stage of the load failed."""


def load_transactions(
    df: DataFrame, output: str, fmt: str = "parquet", into: SparkSession | None = None
) -> DataFrame:
    """Write the readable rows with their features, partitioned by type; return the counts.

    Rows whose ``MALFORMED`` column holds their line are errors: counted, not written. The
    counts are observed on the rows that the write reads, so there is one scan, and counts and
    rows belong together. All columns take part, because a CSV row only counts as malformed
    in columns that are read. An observation leaves its session unable to ship pyspark.ml
    models that carry a training summary, so ``df`` should be of a session of its own, as
    ``run_etl`` arranges; the counts come in the session ``into``.
    """
    spark = into or df.sparkSession
    started = time.monotonic()
    has_errors = MALFORMED in df.columns
    good = F.col(MALFORMED).isNull() if has_errors else F.lit(True)
    columns = [c for c in df.columns if c != MALFORMED]
    nulls = [F.count_if(good & F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL_COLUMNS]
    counts = Observation("load")
    observed = df.observe(
        counts,
        F.count(F.hash(*columns)).alias("total_records"),
        F.count_if(~good).alias("error_records"),
        F.count_if(good & (F.col("isFraud") == 1)).alias("fraud_records"),
        F.count_if(good & (F.col("amount") < 0)).alias("negative_amounts"),
        F.count_if(good & cash_out_mismatch()).alias("cash_out_mismatches"),
        *nulls,
    )
    try:
        write_partitioned(with_etl_features(observed.filter(good).select(*columns)), output, fmt=fmt)
    except Exception as error:
        raise EtlError(str(error)) from error
    got = counts.get
    total, errors = got["total_records"], got["error_records"]
    plain = ("total_records", "error_records", "fraud_records")
    warnings = sum(1 for k, v in got.items() if v and k not in plain)
    return spark.range(1).select(
        F.lit(total).cast("bigint").alias("total_records"),
        F.lit(total - errors).cast("bigint").alias("processed_records"),
        F.lit(errors).cast("bigint").alias("error_records"),
        F.lit(got["fraud_records"]).cast("bigint").alias("fraud_records"),
        F.lit(warnings).alias("warnings"),
        F.array(*[F.lit(s) for s in STAGES]).alias("stages"),
        F.lit(100.0 * (total - errors) / total if total else 0.0).alias("success_rate_pct"),
        F.lit(time.monotonic() - started).alias("seconds"),
    )


def run_etl(spark: SparkSession, source: str, output: str, fmt: str = "parquet") -> DataFrame:
    """CSV file to partitioned feature table, in a session of its own."""
    own = spark.newSession()
    return load_transactions(read_transactions_with_errors(own, source), output, fmt, into=spark)
