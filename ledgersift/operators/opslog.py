"""Service, host and stream-volume aggregates over log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.analytics import ratio, rows
from ledgersift.operators.quantiles import exact_quantiles

FAILED_LATENCY_MS = 9999.0

# Metric, limit, alert type, severity.
METRIC_LIMITS = (
    ("cpu_percent", 80.0, "CPU_HIGH", "HIGH"),
    ("memory_percent", 85.0, "MEMORY_HIGH", "HIGH"),
    ("disk_usage_percent", 90.0, "DISK_HIGH", "MEDIUM"),
)

_QUANTILES = (("median_latency_ms", 0.5), ("p95_latency_ms", 0.95), ("p99_latency_ms", 0.99))


def latency_summary(log: DataFrame, max_mean_ms: float = 100.0, **settings: int) -> DataFrame:
    """Mean, maximum and exact quantiles of response time; no answer counts as 9999 ms."""
    filled = log.select(
        F.coalesce(F.col("response_time_ms"), F.lit(FAILED_LATENCY_MS)).alias("ms")
    )
    exact = exact_quantiles(filled, "ms", [p for _, p in _QUANTILES], **settings)
    quantiles = [F.lit(v).cast("double").alias(name) for (name, _), v in zip(_QUANTILES, exact)]
    summary = filled.agg(
        F.avg("ms").alias("avg_latency_ms"), F.max("ms").alias("max_latency_ms"), *quantiles
    )
    return summary.withColumn("latency_pass", F.col("avg_latency_ms") < max_mean_ms)


def throughput_summary(log: DataFrame, minimum: float = 100000.0) -> DataFrame:
    """Successful requests per elapsed second, errors and their share."""
    ok = F.col("status_code") == 200
    seconds = F.timestamp_diff("MICROSECOND", F.min("timestamp"), F.max("timestamp")) / 1e6
    counted = log.agg(
        F.count_if(ok).alias("total_requests"),
        F.count_if(~ok).alias("errors"),
        seconds.alias("duration_seconds"),
    )
    n, bad = F.col("total_requests"), F.col("errors")
    return counted.withColumns(
        {
            "throughput_tx_s": ratio(n, F.col("duration_seconds")),
            "fail_ratio": ratio(bad, n + bad),
        }
    ).withColumn("throughput_pass", F.col("throughput_tx_s") >= minimum)


def _newest(df: DataFrame, tie: str, limit: int) -> DataFrame:
    return df.orderBy(F.desc("timestamp"), F.desc(tie)).limit(limit)


def api_metrics(log: DataFrame, recent: int = 100) -> DataFrame:
    """Requests and errors over all time, mean latency over the newest requests."""
    last = _newest(log, "request_id", recent)
    mean = last.agg(F.avg("response_time_ms")).scalar()
    size = last.agg(rows()).scalar()
    bad = F.count_if(F.col("status_code") >= 400)
    totals = log.agg(rows().alias("total_requests"), bad.alias("error_count"))
    return totals.withColumns(
        {
            "error_rate_percent": ratio(F.col("error_count"), F.col("total_requests"), 100.0),
            "avg_response_time_ms": mean,
            "recent_requests": size,
        }
    )


def metric_average_last_n(metrics: DataFrame, last: int = 10) -> DataFrame:
    return _newest(metrics, "sample_id", last).agg(
        F.avg("cpu_percent").alias("avg_cpu_percent"),
        F.avg("memory_percent").alias("avg_memory_percent"),
        F.avg("disk_usage_percent").alias("avg_disk_usage_percent"),
        rows().alias("sample_size"),
    )


def threshold_alerts(metrics: DataFrame, limits=METRIC_LIMITS) -> DataFrame:
    """One row per sample and metric over its limit."""
    entries = [
        F.struct(
            F.lit(kind).alias("alert_type"),
            F.lit(severity).alias("severity"),
            F.col(metric).alias("value"),
            F.lit(limit).alias("threshold"),
        )
        for metric, limit, kind, severity in limits
    ]
    tall = metrics.select("sample_id", "timestamp", F.explode(F.array(*entries)).alias("a"))
    return tall.select("sample_id", "timestamp", "a.*").filter(F.col("value") > F.col("threshold"))


def minute_volume(events: DataFrame, time: str = "ts") -> DataFrame:
    """Rows per minute from the first to the last, empty minutes included."""
    minute = F.window(time, "1 minute")["start"]
    counted = events.select(minute.alias("minute")).groupBy("minute").agg(rows().alias("volume"))
    bounds = counted.agg(F.min("minute").alias("first"), F.max("minute").alias("last"))
    kind = counted.schema["minute"].dataType
    # One row has only the days of the covered span; their minutes come out in many tasks.
    first_day, last_day = F.to_date("first").cast(kind), F.to_date("last").cast(kind)
    days = bounds.select(
        "first", "last", F.explode(F.sequence(first_day, last_day, F.expr("INTERVAL 1 DAY"))).alias("day")
    ).repartition("day")
    start = F.greatest("day", "first")
    end = F.least(F.col("day") + F.expr("INTERVAL 1439 MINUTE"), "last")
    spine = days.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MINUTE"))).alias("minute"))
    return spine.join(counted, "minute", "left").select(
        "minute", F.coalesce("volume", F.lit(0)).alias("volume")
    )


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").json(path)
