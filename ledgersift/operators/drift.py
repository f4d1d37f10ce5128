"""Feature statistics, their baseline on disk, and drift alerts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.operators.quality import unpivot_one_row

# Relative change above which a measure has drifted.
DRIFT_LIMITS = (
    ("MEAN_DRIFT", 0.10),
    ("STD_DRIFT", 0.15),
    ("DISTRIBUTION_DRIFT", 0.20),
)

STATISTICS_SCHEMA = "feature string, mean double, std double, min double, max double, count bigint"


def numeric_features(df: DataFrame, ids: tuple[str, ...] = ("tx_id",)) -> list[str]:
    """All numeric columns but the ids, in order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in ids]


def feature_statistics(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """mean, sample std, min, max and non-null count per feature (all numeric ones); nulls become 0."""
    features = numeric_features(df) if features is None else features
    makers = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    stats = [
        F.coalesce(f(c).cast("double"), F.lit(0.0)).alias(f"{m}_{c}")
        for c in features
        for m, f in makers.items()
    ]
    wide = df.agg(*stats, *[F.count(c).alias(f"count_{c}") for c in features])
    kinds = dict.fromkeys(makers, "double") | {"count": "bigint"}
    tall = unpivot_one_row(wide, features, kinds).drop("position")
    return tall.withColumnRenamed("column_name", "feature")


def save_baseline(statistics: DataFrame, path: str) -> None:
    statistics.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").json(path)


def load_baseline(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored statistics, or None when there are none."""
    try:
        return spark.read.schema(STATISTICS_SCHEMA).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def drift_alerts(
    baseline: DataFrame, current: DataFrame, limits: dict[str, float] | None = None
) -> DataFrame:
    """Alerts for mean, deviation and range, one row per feature and drifted measure."""
    limit = dict(DRIFT_LIMITS) | (limits or {})
    b, c = baseline.alias("b"), current.alias("c")
    both = b.join(c, "feature")
    spread = {side: F.col(f"{side}.max") - F.col(f"{side}.min") for side in "bc"}
    measures = [
        ("MEAN_DRIFT", F.col("b.mean"), F.col("c.mean")),
        ("STD_DRIFT", F.col("b.std"), F.col("c.std")),
        ("DISTRIBUTION_DRIFT", spread["b"], spread["c"]),
    ]
    entries = [
        F.struct(
            F.lit(name).alias("alert_type"),
            before.alias("baseline_value"),
            after.alias("current_value"),
            F.lit(limit[name]).alias("threshold"),
        )
        for name, before, after in measures
    ]
    tall = both.select("feature", F.explode(F.array(*entries)).alias("m")).select("feature", "m.*")
    before = F.col("baseline_value")
    change = F.when(before != 0, F.abs(F.col("current_value") - before) / F.abs(before))
    scored = tall.withColumn("drift_score", change)
    score, bar = F.col("drift_score"), F.col("threshold")
    return scored.filter(score > bar).withColumn(
        "severity", F.when(score > bar * 2.0, "HIGH").otherwise("MEDIUM")
    )


def monitor_drift(df: DataFrame, features: list[str] | None, baseline_path: str) -> DataFrame | None:
    """Alerts against the stored baseline; the first call stores one and returns None."""
    current = feature_statistics(df, features)
    baseline = load_baseline(df.sparkSession, baseline_path)
    if baseline is None:
        save_baseline(current, baseline_path)
        return None
    return drift_alerts(baseline, current)


def drift_summary(alerts: DataFrame) -> DataFrame:
    return alerts.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.count_if(F.col("severity") == "HIGH").alias("high_severity"),
        F.count_if(F.col("severity") == "MEDIUM").alias("medium_severity"),
    )


def save_alerts(alerts: DataFrame, path: str) -> None:
    alerts.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").json(path)


def report(alerts: DataFrame) -> str:
    """Plain-text report of an alert table (at most three rows per feature)."""
    lines = ["FEATURE DRIFT REPORT"]
    for row in alerts.orderBy("feature", "alert_type").collect():
        lines.append(
            f"{row.severity:6} {row.feature} {row.alert_type}: {row.baseline_value:.4f} -> "
            f"{row.current_value:.4f} ({row.drift_score:.4f} > {row.threshold})"
        )
    return "\n".join(lines) if len(lines) > 1 else lines[0] + "\nNO DRIFT DETECTED"
