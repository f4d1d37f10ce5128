"""Fraud, dashboard and business aggregates. One scan and one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.functions import features as X


def rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole * scale, 0 when the whole is 0 or missing."""
    return F.when(whole != 0, part / whole * scale).otherwise(0.0)


def fraud_only(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("isFraud") == 1)


def type_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("type").agg(rows().alias("tx_count"))


def type_stats(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy("type")
        .agg(
            rows().alias("tx_count"),
            F.avg("amount").alias("avg_amount"),
            F.sum("amount").alias("total_amount"),
            F.sum("isFraud").alias("fraud_count"),
        )
        .orderBy(F.desc("tx_count"), "type")
    )


def type_fraud_rate(tx: DataFrame) -> DataFrame:
    grouped = tx.groupBy("type").agg(
        rows().alias("tx_count"),
        F.sum("isFraud").alias("fraud_count"),
        F.avg("amount").alias("avg_amount"),
    )
    return grouped.withColumn(
        "fraud_rate_pct", ratio(F.col("fraud_count"), F.col("tx_count"), 100.0)
    ).orderBy(F.desc("tx_count"), "type")


def label_distribution(tx: DataFrame, label: str = "isFraud") -> DataFrame:
    """Rows and share per label value, in one job: the total is summed over the groups."""
    grouped = tx.groupBy(label).agg(rows().alias("tx_count"))
    total = F.sum("tx_count").over(Window.partitionBy())
    return grouped.withColumn("percentage", F.col("tx_count") / total * 100.0)


def imbalance_severity(tx: DataFrame) -> DataFrame:
    counted = tx.agg(rows().alias("tx_count"), F.sum("isFraud").alias("fraud_count"))
    pct = ratio(F.col("fraud_count"), F.col("tx_count"), 100.0)
    return counted.withColumn("fraud_pct", pct).withColumn(
        "severity",
        F.when(F.col("fraud_pct") < 0.5, "SEVERE")
        .when(F.col("fraud_pct") < 1.0, "MODERATE")
        .otherwise("NONE"),
    )


def amount_by_fraud(tx: DataFrame) -> DataFrame:
    return tx.groupBy("isFraud").agg(
        F.avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
        F.min("amount").alias("min_amount"),
        F.sum("amount").alias("total_amount"),
    )


def fraud_patterns(tx: DataFrame) -> DataFrame:
    return (
        fraud_only(tx)
        .groupBy("type")
        .agg(
            rows().alias("fraud_count"),
            F.avg("amount").alias("avg_amount"),
            F.max("amount").alias("max_amount"),
            F.min("amount").alias("min_amount"),
        )
        .orderBy(F.desc("fraud_count"), "type")
    )


def type_fraud_agg(tx: DataFrame) -> DataFrame:
    return tx.groupBy("type", "isFraud").agg(
        F.avg("amount").alias("avg_amount"), rows().alias("tx_count")
    )


def amount_stats(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.avg("amount").alias("avg_amount"),
        F.sum("amount").alias("total_amount"),
    )


def fraud_kpis(tx: DataFrame) -> DataFrame:
    fraud_amount = F.when(F.col("isFraud") == 1, F.col("amount"))
    totals = tx.agg(
        rows().alias("total_transactions"),
        F.count_if(F.col("isFraud") == 1).alias("total_fraud"),
        F.sum("amount").alias("total_amount"),
        F.coalesce(F.sum(fraud_amount), F.lit(0.0)).alias("fraud_amount"),
    )
    n, bad = F.col("total_transactions"), F.col("total_fraud")
    return totals.withColumns(
        {
            "fraud_rate_pct": ratio(bad, n, 100.0),
            "amount_share_pct": ratio(F.col("fraud_amount"), F.col("total_amount"), 100.0),
            "avg_fraud_amount": ratio(F.col("fraud_amount"), bad),
            "avg_amount": ratio(F.col("total_amount"), n),
        }
    )


def cardinality(
    tx: DataFrame, columns: tuple[str, ...] = ("nameOrig", "nameDest"), approx: bool = False
) -> DataFrame:
    count = F.approx_count_distinct if approx else F.count_distinct
    return tx.agg(*[count(c).alias(f"unique_{c}") for c in columns])


def large_transactions(tx: DataFrame) -> DataFrame:
    return tx.agg(
        F.count_if(F.col("amount") > 1000000.0).alias("over_1m"),
        F.count_if(F.col("amount") > 100000.0).alias("over_100k"),
    )


def risk_concentration(tx: DataFrame) -> DataFrame:
    by_type = tx.groupBy("type").agg(F.sum("isFraud").alias("fraud_count"))
    return by_type.filter(F.col("fraud_count") > 0).agg(
        rows().alias("risky_types"),
        F.coalesce(F.sum("fraud_count"), F.lit(0)).alias("fraud_in_risky_types"),
    )


def dashboard_kpis(scored: DataFrame) -> DataFrame:
    return scored.agg(
        rows().alias("total_transactions"),
        F.avg(F.col("isFraud") * 100.0).alias("fraud_rate_pct"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk"),
        F.count_if(F.col("amount") > 100000.0).alias("high_amount"),
        F.avg("amount").alias("avg_amount"),
    )


def risk_level_counts(df: DataFrame, level: str = "risk_level") -> DataFrame:
    return df.groupBy(level).agg(rows().alias("tx_count"))


def amount_band_counts(tx: DataFrame) -> DataFrame:
    banded = tx.select(X.amount_band().alias("risk_level")).filter(F.col("risk_level").isNotNull())
    return risk_level_counts(banded)


def histogram(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Equal-width bins between the column's minimum and maximum, counted per group."""
    source = df.filter(F.col(value).isNotNull())
    low = df.select(F.min(value)).scalar()
    high = df.select(F.max(value)).scalar()
    width = (high - low) / F.lit(float(bins))
    number = F.when(width > 0, F.floor((F.col(value) - low) / width)).otherwise(0)
    binned = source.select(
        F.col(by), F.least(number, F.lit(bins - 1)).cast("int").alias("bin")
    )
    return binned.groupBy("bin", by).agg(rows().alias("tx_count"))


def step_timeline(tx: DataFrame, last: int = 60) -> DataFrame:
    counted = tx.groupBy("step").agg(rows().alias("tx_count"))
    return counted.orderBy(F.desc("step")).limit(last).orderBy("step")


def recent_transactions(scored: DataFrame, time: str = "ts", limit: int = 20) -> DataFrame:
    newest = scored.orderBy(F.desc(time), F.desc("tx_id")).limit(limit)
    return newest.select("tx_id", time, "type", "amount", "risk_level", "fraud_probability")


def top_high_risk(scored: DataFrame, limit: int = 5) -> DataFrame:
    p = F.col("fraud_probability")
    top = (
        scored.filter(F.col("risk_level") == "HIGH").orderBy(p.desc(), "tx_id").limit(limit)
    )
    return top.withColumn("alert_band", F.when(p > 0.8, "alert-high").otherwise("alert-medium"))


def filter_choices(df: DataFrame, **choices: list) -> DataFrame:
    """Keep rows whose columns hold a chosen value; an empty choice keeps all."""
    for column, wanted in choices.items():
        if wanted:
            df = df.filter(F.col(column).isin(*wanted))
    return df


def search_transactions(
    tx: DataFrame, term: str = "", limit: int = 20, regex: bool = True
) -> DataFrame:
    """First matches of a case-insensitive term in sender or type."""
    if term:
        pattern = F.lit(f"(?i){term}")
        if regex:
            hit = F.rlike("nameOrig", pattern) | F.rlike("type", pattern)
        else:
            low = term.lower()
            hit = F.lower("nameOrig").contains(low) | F.lower("type").contains(low)
        tx = tx.filter(hit)
    return tx.orderBy("tx_id").limit(limit)


def confusion_metrics(
    df: DataFrame, predicted: Column, actual: Column, by: tuple[str, ...] = ()
) -> DataFrame:
    """Counts and rates of a yes/no prediction, in one aggregate (per group if asked)."""
    counts = df.groupBy(*by).agg(
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
    )
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    rates = counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
        }
    )
    both = F.col("precision") + F.col("recall")
    return rates.withColumn("f1", ratio(F.col("precision") * F.col("recall") * 2.0, both))


def metric_targets(
    metrics: DataFrame, min_precision: float = 0.95, min_recall: float = 0.90
) -> DataFrame:
    """Pass/fail per row of precision and recall."""
    checked = metrics.withColumns(
        {
            "precision_pass": F.col("precision") >= min_precision,
            "recall_pass": F.col("recall") >= min_recall,
        }
    )
    return checked.withColumn("overall_pass", F.col("precision_pass") & F.col("recall_pass"))


def service_targets(
    summary: DataFrame, max_latency_ms: float = 100.0, min_throughput: float = 100000.0
) -> DataFrame:
    """Pass/fail of mean latency and throughput, for whichever column is there."""
    checks = {}
    if "avg_latency_ms" in summary.columns:
        checks["latency_pass"] = F.col("avg_latency_ms") < max_latency_ms
    if "throughput_tx_s" in summary.columns:
        checks["throughput_pass"] = F.col("throughput_tx_s") >= min_throughput
    return summary.withColumns(checks)


def business_kpis(scored: DataFrame, system_cost: float = 100000.0) -> DataFrame:
    """Detection rate, avoided losses, return, blocked normal payments, coverage."""
    caught = F.col("is_fraud") & (F.col("isFraud") == 1)
    blocked = F.col("is_fraud") & (F.col("isFraud") == 0)
    totals = scored.agg(
        rows().alias("n"),
        F.count_if(F.col("fraud_probability").isNotNull()).alias("scored"),
        F.count_if(F.col("isFraud") == 1).alias("frauds"),
        F.count_if(caught).alias("caught"),
        F.count_if(blocked).alias("blocked"),
        F.coalesce(F.sum(F.when(caught, F.col("amount"))), F.lit(0.0)).alias("avoided_losses"),
    )
    return totals.select(
        ratio(F.col("caught"), F.col("frauds"), 100.0).alias("detection_rate_pct"),
        "avoided_losses",
        (F.col("avoided_losses") / F.lit(system_cost)).alias("roi"),
        ratio(F.col("blocked"), F.col("n"), 100.0).alias("false_positive_pct"),
        ratio(F.col("scored"), F.col("n"), 100.0).alias("coverage_pct"),
    )


def with_request_errors(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Add ``error``: the names of missing required fields, null when complete."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    return df.withColumn("error", F.when(missing != "", F.concat(F.lit("missing: "), missing)))


def batch_score_summary(results: DataFrame) -> DataFrame:
    ok = F.col("error").isNull()
    return results.agg(
        rows().alias("batch_size"),
        F.count_if(ok).alias("successful_predictions"),
        F.count_if(~ok).alias("failed_predictions"),
        F.count_if(ok & F.col("is_fraud")).alias("fraud_count"),
    )


def size_estimate(df: DataFrame) -> DataFrame:
    """Rough table size: 8 bytes per cell."""
    width = len(df.columns)
    n = F.col("row_count")
    return df.agg(rows().alias("row_count")).select(
        "row_count",
        F.lit(width).alias("column_count"),
        (n * width * 8).alias("estimated_bytes"),
    )
