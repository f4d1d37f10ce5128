"""Aggregates, top-k reports, history metrics and log summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgersift.functions import scoring as S
from ledgersift.operators import analytics as A
from ledgersift.operators import history as H
from ledgersift.operators import opslog as O
from ledgersift.operators import sketches as K
from ledgersift.plans.catalog import query, rounded
from ledgersift.plans.row_queries import _ADDITIVE
from ledgersift.plans.sql import with_tables
from ledgersift.session import work_path
from ledgersift.sources import views as V

_TX = "transactions"


def _indicators(spark, sf_dir):
    return H.indicator_scores(V.transactions(spark, sf_dir))


def _reduced(spark, sf_dir):
    return H.score_with_history(V.transactions(spark, sf_dir))


@query("type_counts", with_tables("SELECT type, count(*) AS tx_count FROM transactions GROUP BY 1", _TX))
def type_counts(spark, sf_dir):
    return A.type_counts(V.transactions(spark, sf_dir))


@query(
    "type_stats",
    with_tables(
        """SELECT type, count(*) AS tx_count, round(avg(amount), 4) AS avg_amount,
  round(sum(amount), 2) AS total_amount, CAST(sum(isFraud) AS BIGINT) AS fraud_count
FROM transactions GROUP BY type ORDER BY tx_count DESC, type""",
        _TX,
    ),
)
def type_stats(spark, sf_dir):
    return rounded(A.type_stats(V.transactions(spark, sf_dir)), avg_amount=4, total_amount=2)


@query(
    "type_fraud_rate",
    with_tables(
        """SELECT type, count(*) AS tx_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
  round(avg(amount), 4) AS avg_amount, round(sum(isFraud) / count(*) * 100e0, 4) AS fraud_rate_pct
FROM transactions GROUP BY type ORDER BY tx_count DESC, type""",
        _TX,
    ),
)
def type_fraud_rate(spark, sf_dir):
    return rounded(A.type_fraud_rate(V.transactions(spark, sf_dir)), avg_amount=4, fraud_rate_pct=4)


def _distribution_sql(label: str) -> str:
    return with_tables(
        f"""SELECT {label}, count(*) AS tx_count,
  round(count(*) / (SELECT count(*) FROM transactions) * 100e0, 4) AS percentage
FROM transactions GROUP BY {label}""",
        _TX,
    )


@query("fraud_distribution", _distribution_sql("isFraud"))
def fraud_distribution(spark, sf_dir):
    return rounded(A.label_distribution(V.transactions(spark, sf_dir)), percentage=4)


@query("flagged_distribution", _distribution_sql("isFlaggedFraud"))
def flagged_distribution(spark, sf_dir):
    tx = V.transactions(spark, sf_dir)
    return rounded(A.label_distribution(tx, "isFlaggedFraud"), percentage=4)


@query(
    "imbalance_severity",
    with_tables(
        """SELECT *, CASE WHEN fraud_pct < 0.5e0 THEN 'SEVERE' WHEN fraud_pct < 1e0 THEN 'MODERATE'
  ELSE 'NONE' END AS severity
FROM (SELECT count(*) AS tx_count, CAST(sum(isFraud) AS BIGINT) AS fraud_count,
  round(sum(isFraud) / count(*) * 100e0, 4) AS fraud_pct FROM transactions)""",
        _TX,
    ),
)
def imbalance_severity(spark, sf_dir):
    return rounded(A.imbalance_severity(V.transactions(spark, sf_dir)), fraud_pct=4)


@query(
    "amount_by_fraud",
    with_tables(
        """SELECT isFraud, round(avg(amount), 4) AS avg_amount, max(amount) AS max_amount,
  min(amount) AS min_amount, round(sum(amount), 2) AS total_amount
FROM transactions GROUP BY isFraud""",
        _TX,
    ),
)
def amount_by_fraud(spark, sf_dir):
    return rounded(A.amount_by_fraud(V.transactions(spark, sf_dir)), avg_amount=4, total_amount=2)


@query(
    "fraud_patterns",
    with_tables(
        """SELECT type, count(*) AS fraud_count, round(avg(amount), 4) AS avg_amount,
  max(amount) AS max_amount, min(amount) AS min_amount
FROM transactions WHERE isFraud = 1 GROUP BY type ORDER BY fraud_count DESC, type""",
        _TX,
    ),
)
def fraud_patterns(spark, sf_dir):
    return rounded(A.fraud_patterns(V.transactions(spark, sf_dir)), avg_amount=4)


@query(
    "type_fraud_agg",
    with_tables(
        """SELECT type, isFraud, round(avg(amount), 4) AS avg_amount, count(*) AS tx_count
FROM transactions GROUP BY type, isFraud""",
        _TX,
    ),
)
def type_fraud_agg(spark, sf_dir):
    return rounded(A.type_fraud_agg(V.transactions(spark, sf_dir)), avg_amount=4)


@query(
    "amount_stats",
    with_tables(
        """SELECT min(amount) AS min_amount, max(amount) AS max_amount,
  round(avg(amount), 4) AS avg_amount, round(sum(amount), 2) AS total_amount FROM transactions""",
        _TX,
    ),
)
def amount_stats(spark, sf_dir):
    return rounded(A.amount_stats(V.transactions(spark, sf_dir)), avg_amount=4, total_amount=2)


@query(
    "fraud_kpis",
    with_tables(
        """SELECT n AS total_transactions, bad AS total_fraud, round(total, 2) AS total_amount,
  round(lost, 2) AS fraud_amount, round(bad / n * 100e0, 4) AS fraud_rate_pct,
  round(lost / total * 100e0, 4) AS amount_share_pct, round(lost / bad, 4) AS avg_fraud_amount,
  round(total / n, 4) AS avg_amount
FROM (SELECT count(*) AS n, count(*) FILTER (isFraud = 1) AS bad, sum(amount) AS total,
  sum(amount) FILTER (isFraud = 1) AS lost FROM transactions)""",
        _TX,
    ),
)
def fraud_kpis(spark, sf_dir):
    kpis = A.fraud_kpis(V.transactions(spark, sf_dir))
    return rounded(
        kpis, total_amount=2, fraud_amount=2, fraud_rate_pct=4, amount_share_pct=4,
        avg_fraud_amount=4, avg_amount=4,
    )


@query(
    "cardinality",
    with_tables(
        """SELECT count(DISTINCT nameOrig) AS "unique_nameOrig",
  count(DISTINCT nameDest) AS "unique_nameDest" FROM transactions""",
        _TX,
    ),
)
def cardinality(spark, sf_dir):
    return A.cardinality(V.transactions(spark, sf_dir))


_SKETCHED = ("nameOrig", "nameDest", "type", "amount", "step")


@query(
    "distinct_sketches",
    with_tables(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT (step - 1) // 240) AS parts, count(*) AS "rows",
  count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS exact, TRUE AS close FROM transactions"""
            for c in _SKETCHED
        ),
        _TX,
    ),
)
def distinct_sketches(spark, sf_dir):
    """Sketches of ten days a part: most stored first, the rest added, united and held against exact counts."""
    tx = V.transactions(spark, sf_dir)
    part, path = F.floor((F.col("step") - 1) / 240), work_path(spark, "sketches")
    first = tx.filter(part < 5)
    K.add_parts(K.distinct_sketches(first, list(_SKETCHED), part), path)
    K.add_parts(K.distinct_sketches(tx.filter(part >= 5), list(_SKETCHED), part), path)
    exact = tx.agg(*[F.count_distinct(c).alias(c) for c in _SKETCHED])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in _SKETCHED])
    known = K.united_counts(K.stored_sketches(spark, path)).join(exact.select(F.inline(pairs)), "column")
    close = F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), K.relative_error() * F.col("exact"))
    return known.select("column", "parts", "rows", "nulls", "exact", close.alias("close"))


@query(
    "large_tx",
    with_tables(
        """SELECT count(*) FILTER (amount > 1000000) AS over_1m,
  count(*) FILTER (amount > 100000) AS over_100k FROM transactions""",
        _TX,
    ),
)
def large_tx(spark, sf_dir):
    return A.large_transactions(V.transactions(spark, sf_dir))


@query(
    "risk_concentration",
    with_tables(
        """SELECT count(*) AS risky_types, CAST(sum(f) AS BIGINT) AS fraud_in_risky_types
FROM (SELECT sum(isFraud) AS f FROM transactions GROUP BY type) WHERE f > 0""",
        _TX,
    ),
)
def risk_concentration(spark, sf_dir):
    return A.risk_concentration(V.transactions(spark, sf_dir))


@query(
    "size_estimate",
    with_tables(
        """SELECT count(*) AS row_count, 12 AS column_count, count(*) * 12 * 8 AS estimated_bytes
FROM transactions""",
        _TX,
    ),
)
def size_estimate(spark, sf_dir):
    return A.size_estimate(V.transactions(spark, sf_dir))


@query(
    "dashboard_kpis",
    with_tables(
        """SELECT count(*) AS total_transactions, round(avg(isFraud * 100e0), 4) AS fraud_rate_pct,
  count(*) FILTER (risk_level = 'HIGH') AS high_risk,
  count(*) FILTER (amount > 100000) AS high_amount, round(avg(amount), 4) AS avg_amount
FROM indicators""",
        "indicators",
    ),
)
def dashboard_kpis(spark, sf_dir):
    return rounded(A.dashboard_kpis(_indicators(spark, sf_dir)), fraud_rate_pct=4, avg_amount=4)


@query(
    "risk_level_counts",
    with_tables("SELECT risk_level, count(*) AS tx_count FROM indicators GROUP BY 1", "indicators"),
)
def risk_level_counts(spark, sf_dir):
    return A.risk_level_counts(_indicators(spark, sf_dir))


@query(
    "amount_band_counts",
    with_tables(
        """SELECT CASE WHEN amount <= 10000 THEN 'LOW' WHEN amount <= 50000 THEN 'MEDIUM'
  ELSE 'HIGH' END AS risk_level, count(*) AS tx_count FROM transactions WHERE amount > 0 GROUP BY 1""",
        _TX,
    ),
)
def amount_band_counts(spark, sf_dir):
    return A.amount_band_counts(V.transactions(spark, sf_dir))


def _histogram_sql(value: str, by: str, bins: int) -> str:
    return with_tables(
        f"""SELECT CAST(least(CASE WHEN hi > lo THEN floor(({value} - lo) / ((hi - lo) / {bins}e0))
  ELSE 0 END, {bins - 1}) AS INT) AS bin, {by}, count(*) AS tx_count
FROM indicators, (SELECT min({value}) AS lo, max({value}) AS hi FROM indicators)
GROUP BY 1, 2""",
        "indicators",
    )


@query("amount_histogram", _histogram_sql("amount", "isFraud", 50))
def amount_histogram(spark, sf_dir):
    return A.histogram(V.transactions(spark, sf_dir), "amount", "isFraud", 50)


@query("probability_histogram", _histogram_sql("fraud_probability", "risk_level", 30))
def probability_histogram(spark, sf_dir):
    return A.histogram(_indicators(spark, sf_dir), "fraud_probability", "risk_level", 30)


@query(
    "step_timeline",
    with_tables(
        """SELECT * FROM (SELECT step, count(*) AS tx_count FROM transactions GROUP BY step
  ORDER BY step DESC LIMIT 60) ORDER BY step""",
        _TX,
    ),
)
def step_timeline(spark, sf_dir):
    return A.step_timeline(V.transactions(spark, sf_dir))


@query(
    "recent_transactions",
    with_tables(
        """SELECT tx_id, step, type, amount, risk_level, fraud_probability FROM indicators
ORDER BY step DESC, tx_id DESC LIMIT 20""",
        "indicators",
    ),
)
def recent_transactions(spark, sf_dir):
    return A.recent_transactions(_indicators(spark, sf_dir), time="step")


@query(
    "top_high_risk",
    with_tables(
        """SELECT tx_id, type, amount, fraud_probability, risk_level,
  CASE WHEN fraud_probability > 0.8e0 THEN 'alert-high' ELSE 'alert-medium' END AS alert_band
FROM reduced WHERE risk_level = 'HIGH' ORDER BY fraud_probability DESC, tx_id LIMIT 5""",
        "reduced",
    ),
)
def top_high_risk(spark, sf_dir):
    return A.top_high_risk(_reduced(spark, sf_dir)).select(
        "tx_id", "type", "amount", "fraud_probability", "risk_level", "alert_band"
    )


@query(
    "top_alerts",
    with_tables(
        """SELECT tx_id, nameOrig, type, amount, fraud_probability, risk_level, isFraud
FROM reduced WHERE is_fraud AND fraud_probability > 0.7e0
ORDER BY fraud_probability DESC, tx_id LIMIT 10""",
        "reduced",
    ),
)
def top_alerts(spark, sf_dir):
    return H.top_alerts(_reduced(spark, sf_dir)).select(
        "tx_id", "nameOrig", "type", "amount", "fraud_probability", "risk_level", "isFraud"
    )


@query(
    "customer_history",
    with_tables(
        """SELECT nameOrig, last_transaction, transaction_count, round(avg_amount, 4) AS avg_amount,
  round(std_amount, 4) AS std_amount, fraud_count FROM history""",
        "history",
    ),
)
def customer_history(spark, sf_dir):
    known = H.customer_history(V.transactions(spark, sf_dir))
    return rounded(known, avg_amount=4, std_amount=4)


@query(
    "customer_stats",
    with_tables(
        """SELECT 'C121' AS nameOrig, count(amount) AS transaction_count,
  CAST(coalesce(sum(isFraud), 0) AS BIGINT) AS fraud_count,
  round(coalesce(avg(amount), 0e0), 4) AS avg_amount FROM transactions WHERE nameOrig = 'C121'""",
        _TX,
    ),
)
def customer_stats(spark, sf_dir):
    return rounded(H.customer_stats(V.transactions(spark, sf_dir), "C121"), avg_amount=4)


@query(
    "fp_metrics",
    with_tables(
        """SELECT n AS predictions_made, fp AS false_positives, tp AS true_positives,
  tn AS true_negatives, fn AS false_negatives, round(fp / n, 6) AS current_fp_rate,
  round((0.15e0 - fp / n) / 0.15e0 * 100, 4) AS reduction_percentage
FROM (SELECT count(*) AS n, count(*) FILTER (is_fraud AND isFraud = 0) AS fp,
  count(*) FILTER (is_fraud AND isFraud = 1) AS tp,
  count(*) FILTER (NOT is_fraud AND isFraud = 0) AS tn,
  count(*) FILTER (NOT is_fraud AND isFraud = 1) AS fn FROM reduced)""",
        "reduced",
    ),
)
def fp_metrics(spark, sf_dir):
    return rounded(
        H.fp_metrics(_reduced(spark, sf_dir)), current_fp_rate=6, reduction_percentage=4
    )


@query(
    "fp_rate_running",
    with_tables(
        """, _running AS (
  SELECT step, tx_id, row_number() OVER o AS rn, row_number() OVER o AS n,
    CAST(sum(CASE WHEN is_fraud AND isFraud = 0 THEN 1 ELSE 0 END) OVER o AS BIGINT) AS fp
  FROM reduced WINDOW o AS (ORDER BY step, tx_id ROWS UNBOUNDED PRECEDING)),
_rates AS (SELECT *, fp / n AS fp_rate FROM _running),
_walk AS (
  SELECT CAST(0 AS BIGINT) AS rn, 0.5e0 AS threshold
  UNION ALL
  SELECT r.rn, CASE WHEN r.n < 100 THEN w.threshold
    WHEN r.fp_rate > 0.105e0 * 1.2e0 THEN least(0.8e0, w.threshold + 0.05e0)
    WHEN r.fp_rate < 0.105e0 * 0.8e0 THEN greatest(0.3e0, w.threshold - 0.05e0)
    ELSE w.threshold END
  FROM _walk w JOIN _rates r ON r.rn = w.rn + 1)
SELECT r.step, r.tx_id, r.n AS predictions_made, r.fp AS false_positives, round(r.fp_rate, 6) AS fp_rate,
  round(w.threshold, 6) AS threshold
FROM _rates r JOIN _walk w ON r.rn = w.rn""",
        "reduced",
        recursive=True,
    ),
)
def fp_rate_running(spark, sf_dir):
    return rounded(H.fp_rate_running(_reduced(spark, sf_dir)), fp_rate=6, threshold=6)


_CONFUSION = """round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END, 6) AS recall,
  round(CASE WHEN tp > 0 THEN 2e0 * tp / (2e0 * tp + fp + fn) ELSE 0e0 END, 6) AS f1"""
_COUNTS = """count(*) FILTER (hit AND isFraud = 1) AS tp, count(*) FILTER (NOT hit AND isFraud = 0) AS tn,
  count(*) FILTER (hit AND isFraud = 0) AS fp, count(*) FILTER (NOT hit AND isFraud = 1) AS fn"""


@query(
    "confusion_metrics",
    with_tables(
        f"""SELECT tp, tn, fp, fn, {_CONFUSION}
FROM (SELECT {_COUNTS} FROM (SELECT isFraud, is_fraud AS hit FROM indicators))""",
        "indicators",
    ),
)
def confusion_metrics(spark, sf_dir):
    scored = _indicators(spark, sf_dir)
    found = A.confusion_metrics(scored, F.col("is_fraud"), F.col("isFraud") == 1)
    return rounded(found, accuracy=6, precision=6, recall=6, f1=6)


@query(
    "metric_targets",
    with_tables(
        f""", _each AS (
  SELECT 'indicator' AS model, isFraud, is_fraud AS hit FROM indicators
  UNION ALL SELECT 'history', isFraud, is_fraud FROM reduced
  UNION ALL SELECT 'fallback', isFraud, amount > 100000 FROM transactions),
_scores AS (
  SELECT model, tp, tn, fp, fn, {_CONFUSION}
  FROM (SELECT model, {_COUNTS} FROM _each GROUP BY model))
SELECT *, precision >= 0.95e0 AS precision_pass, recall >= 0.90e0 AS recall_pass,
  precision >= 0.95e0 AND recall >= 0.90e0 AS overall_pass FROM _scores""",
        "reduced",
    ),
)
def metric_targets(spark, sf_dir):
    scored = _reduced(spark, sf_dir)
    decisions = {
        "indicator": F.col("base_probability") > 0.5,
        "history": F.col("is_fraud"),
        "fallback": S.fallback_score() > 0.5,
    }
    tall = scored.select(
        "isFraud",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("model"), d.alias("hit")) for m, d in decisions.items()])
        ).alias("d"),
    ).select("isFraud", "d.*")
    found = A.confusion_metrics(tall, F.col("hit"), F.col("isFraud") == 1, by=("model",))
    return A.metric_targets(rounded(found, accuracy=6, precision=6, recall=6, f1=6))


@query(
    "business_kpis",
    with_tables(
        """SELECT round(caught / frauds * 100e0, 4) AS detection_rate_pct,
  round(saved, 2) AS avoided_losses, round(saved / 100000e0, 4) AS roi,
  round(blocked / n * 100e0, 4) AS false_positive_pct, round(scored / n * 100e0, 4) AS coverage_pct
FROM (SELECT count(*) AS n, count(fraud_probability) AS scored,
  count(*) FILTER (isFraud = 1) AS frauds, count(*) FILTER (is_fraud AND isFraud = 1) AS caught,
  count(*) FILTER (is_fraud AND isFraud = 0) AS blocked,
  coalesce(sum(amount) FILTER (is_fraud AND isFraud = 1), 0e0) AS saved FROM reduced)""",
        "reduced",
    ),
)
def business_kpis(spark, sf_dir):
    return rounded(
        A.business_kpis(_reduced(spark, sf_dir)), detection_rate_pct=4, avoided_losses=2, roi=4,
        false_positive_pct=4, coverage_pct=4,
    )


@query(
    "batch_score_summary",
    with_tables(
        f""", _in AS (SELECT * FROM dirty), transactions2 AS (SELECT * FROM _in),
{_ADDITIVE.replace("FROM transactions)", "FROM transactions2)")}
SELECT count(*) AS batch_size,
  count(*) FILTER (amount IS NOT NULL AND type IS NOT NULL) AS successful_predictions,
  count(*) FILTER (amount IS NULL OR type IS NULL) AS failed_predictions,
  count(*) FILTER (amount IS NOT NULL AND type IS NOT NULL AND p >= 0.5e0) AS fraud_count
FROM _points""",
        "dirty",
    ),
)
def batch_score_summary(spark, sf_dir):
    required = ("step", "type", "amount", "oldbalanceOrg", "newbalanceOrig")
    checked = A.with_request_errors(V.dirty_transactions(spark, sf_dir), required)
    return A.batch_score_summary(checked.withColumn("is_fraud", S.additive_score() >= 0.5))


@query(
    "latency_summary",
    with_tables(
        """SELECT round(avg(response_time_ms), 4) AS avg_latency_ms,
  max(response_time_ms) AS max_latency_ms,
  round(quantile_cont(response_time_ms, 0.5), 6) AS median_latency_ms,
  round(quantile_cont(response_time_ms, 0.95), 6) AS p95_latency_ms,
  round(quantile_cont(response_time_ms, 0.99), 6) AS p99_latency_ms,
  avg(response_time_ms) < 100 AS latency_pass FROM request_log""",
        "request_log",
    ),
)
def latency_summary(spark, sf_dir):
    return rounded(
        O.latency_summary(V.request_log(spark, sf_dir)), avg_latency_ms=4, median_latency_ms=6,
        p95_latency_ms=6, p99_latency_ms=6,
    )


@query(
    "throughput_summary",
    with_tables(
        """SELECT ok AS total_requests, bad AS errors, secs AS duration_seconds,
  round(ok / secs, 8) AS throughput_tx_s, round(bad / (ok + bad), 6) AS fail_ratio,
  ok / secs >= 100000 AS throughput_pass
FROM (SELECT count(*) FILTER (status_code = 200) AS ok,
  count(*) FILTER (status_code <> 200) AS bad,
  date_diff('microsecond', min("timestamp"), max("timestamp")) / 1e6 AS secs FROM request_log)""",
        "request_log",
    ),
)
def throughput_summary(spark, sf_dir):
    return rounded(
        O.throughput_summary(V.request_log(spark, sf_dir)), throughput_tx_s=8, fail_ratio=6
    )


@query(
    "api_metrics",
    with_tables(
        """, _last AS (SELECT * FROM request_log ORDER BY "timestamp" DESC, request_id DESC LIMIT 100)
SELECT count(*) AS total_requests, count(*) FILTER (status_code >= 400) AS error_count,
  round(count(*) FILTER (status_code >= 400) / count(*) * 100e0, 4) AS error_rate_percent,
  round((SELECT avg(response_time_ms) FROM _last), 4) AS avg_response_time_ms,
  (SELECT count(*) FROM _last) AS recent_requests
FROM request_log""",
        "request_log",
    ),
)
def api_metrics(spark, sf_dir):
    return rounded(
        O.api_metrics(V.request_log(spark, sf_dir)), error_rate_percent=4, avg_response_time_ms=4
    )


@query(
    "metric_average_last_n",
    with_tables(
        """SELECT round(avg(cpu_percent), 4) AS avg_cpu_percent,
  round(avg(memory_percent), 4) AS avg_memory_percent,
  round(avg(disk_usage_percent), 4) AS avg_disk_usage_percent, count(*) AS sample_size
FROM (SELECT * FROM host_metrics ORDER BY "timestamp" DESC, sample_id DESC LIMIT 10)""",
        "host_metrics",
    ),
)
def metric_average_last_n(spark, sf_dir):
    return rounded(
        O.metric_average_last_n(V.host_metrics(spark, sf_dir)), avg_cpu_percent=4,
        avg_memory_percent=4, avg_disk_usage_percent=4,
    )


@query(
    "threshold_alerts",
    with_tables(
        """SELECT sample_id, "timestamp", 'CPU_HIGH' AS alert_type, 'HIGH' AS severity,
  cpu_percent AS value, 80e0 AS threshold FROM host_metrics WHERE cpu_percent > 80
UNION ALL SELECT sample_id, "timestamp", 'MEMORY_HIGH', 'HIGH', memory_percent, 85e0
FROM host_metrics WHERE memory_percent > 85
UNION ALL SELECT sample_id, "timestamp", 'DISK_HIGH', 'MEDIUM', disk_usage_percent, 90e0
FROM host_metrics WHERE disk_usage_percent > 90""",
        "host_metrics",
    ),
)
def threshold_alerts(spark, sf_dir):
    return O.threshold_alerts(V.host_metrics(spark, sf_dir))


@query(
    "minute_volume",
    with_tables(
        """, _counts AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS volume
  FROM tx_events GROUP BY 1),
_spine AS (SELECT unnest(generate_series((SELECT min(minute) FROM _counts),
  (SELECT max(minute) FROM _counts), INTERVAL 1 MINUTE)) AS minute)
SELECT s.minute, coalesce(c.volume, 0) AS volume
FROM _spine s LEFT JOIN _counts c ON s.minute = c.minute""",
        "tx_events",
    ),
)
def minute_volume(spark, sf_dir):
    return O.minute_volume(V.transaction_events(spark, sf_dir))


@query(
    "service_targets",
    with_tables(
        """SELECT endpoint, round(avg(response_time_ms), 4) AS avg_latency_ms,
  avg(response_time_ms) < 100 AS latency_pass,
  round(count(*) / (date_diff('microsecond', min("timestamp"), max("timestamp")) / 1e6), 8) AS throughput_tx_s,
  count(*) / (date_diff('microsecond', min("timestamp"), max("timestamp")) / 1e6) >= 100000 AS throughput_pass
FROM request_log GROUP BY endpoint""",
        "request_log",
    ),
)
def service_targets(spark, sf_dir):
    """Latency and throughput targets per endpoint."""
    seconds = F.timestamp_diff("MICROSECOND", F.min("timestamp"), F.max("timestamp")) / 1e6
    summary = V.request_log(spark, sf_dir).groupBy("endpoint").agg(
        F.avg("response_time_ms").alias("avg_latency_ms"),
        (F.count(F.lit(1)) / seconds).alias("throughput_tx_s"),
    )
    return rounded(A.service_targets(summary), avg_latency_ms=4, throughput_tx_s=8)


@query(
    "metric_files",
    with_tables(
        """SELECT sample_id, cpu_percent, memory_percent, disk_usage_percent FROM host_metrics""",
        "host_metrics",
    ),
)
def metric_files(spark, sf_dir):
    """Host metrics appended to a file and read again."""
    path = work_path(spark, "metrics")
    metrics = V.host_metrics(spark, sf_dir)
    O.save_metrics(metrics, path)
    stored = spark.read.schema(metrics.schema).json(path)
    return stored.select("sample_id", "cpu_percent", "memory_percent", "disk_usage_percent")
