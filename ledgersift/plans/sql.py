"""Check SQL: the same tables as ``sources.views`` as common table expressions."""

from __future__ import annotations

_PARTS = {
    "transactions": (
        (),
        """_tx_base AS (
  SELECT o.o_orderkey AS tx_id,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) AS INT) + 1 AS step,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
      WHEN '3-MEDIUM' THEN 'CASH_IN' WHEN '4-NOT SPECIFIED' THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
    o.o_totalprice * o.o_totalprice / 200000e0 AS amount,
    GREATEST(c.c_acctbal, 0e0) * CAST(1 + o.o_orderkey % 50 AS DOUBLE) AS oldbalanceOrg,
    'C' || CAST(o.o_custkey AS VARCHAR) AS nameOrig,
    'M' || CAST(o.o_orderkey * 7919 % 997 AS VARCHAR) AS nameDest,
    CASE WHEN o.o_orderkey % 3 = 0 THEN 0e0
         ELSE CAST(o.o_orderkey % 1000 * 100 AS DOUBLE) END AS oldbalanceDest,
    o.o_orderstatus AS st
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
_tx_after AS (
  SELECT *,
    CASE WHEN st = 'P' THEN 0e0
         WHEN type = 'CASH_IN' THEN oldbalanceOrg + amount
         WHEN st = 'O' THEN oldbalanceOrg - amount
         ELSE GREATEST(oldbalanceOrg - amount, 0e0) END AS newbalanceOrig,
    CASE WHEN st = 'F' THEN oldbalanceDest ELSE oldbalanceDest + amount END AS newbalanceDest
  FROM _tx_base),
transactions AS (
  SELECT tx_id, step, type, amount, oldbalanceOrg, newbalanceOrig, nameOrig, nameDest,
    oldbalanceDest, newbalanceDest,
    CASE WHEN (type IN ('TRANSFER','CASH_OUT') AND amount > 100000 AND newbalanceOrig = 0
               AND tx_id % 4 <> 0) OR tx_id % 500 = 0 THEN 1 ELSE 0 END AS isFraud,
    CASE WHEN type = 'TRANSFER' AND amount > 200000 AND st = 'P' THEN 1 ELSE 0 END
      AS isFlaggedFraud
  FROM _tx_after)""",
    ),
    "dirty": (
        ("transactions",),
        """_dirty_once AS (
  SELECT * REPLACE (
    CASE WHEN tx_id % 97 = 0 THEN NULL WHEN tx_id % 131 = 0 THEN -amount ELSE amount END AS amount,
    CASE WHEN tx_id % 211 = 0 THEN NULL ELSE type END AS type)
  FROM transactions),
dirty AS (
  SELECT * FROM _dirty_once UNION ALL SELECT * FROM _dirty_once WHERE tx_id % 101 = 0)""",
    ),
    "tx_events": (
        (),
        """tx_events AS (
  SELECT event_id AS tx_id, ts,
    CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'signup' THEN 'CASH_OUT'
      WHEN 'view' THEN 'CASH_IN' WHEN 'click' THEN 'PAYMENT' ELSE 'DEBIT' END AS type,
    value * 1000e0 AS amount, 'C' || CAST(user_id AS VARCHAR) AS nameOrig
  FROM events)""",
    ),
    "request_log": (
        (),
        """request_log AS (
  SELECT event_id AS request_id, ts AS "timestamp", event_type AS endpoint,
    value AS response_time_ms, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code
  FROM events)""",
    ),
    "host_metrics": (
        (),
        """host_metrics AS (
  SELECT event_id AS sample_id, ts AS "timestamp", value % 100e0 AS cpu_percent,
    value * 1.7e0 % 100e0 AS memory_percent, value * 2.3e0 % 100e0 AS disk_usage_percent
  FROM events)""",
    ),
    "indicators": (
        ("transactions",),
        """_hits AS (
  SELECT *,
    CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END
    + CASE WHEN amount > 100000 THEN 1 ELSE 0 END
    + CASE WHEN oldbalanceOrg = 0 THEN 1 ELSE 0 END
    + CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END
    + CASE WHEN oldbalanceDest = 0 AND newbalanceDest > amount * 0.9e0 THEN 1 ELSE 0 END
      AS fraud_indicators
  FROM transactions),
_prob AS (
  SELECT *, CASE WHEN fraud_indicators >= 3 THEN 0.95e0 WHEN fraud_indicators = 2 THEN 0.70e0
    WHEN fraud_indicators = 1 THEN 0.40e0 ELSE 0.10e0 END AS fraud_probability
  FROM _hits),
indicators AS (
  SELECT *, fraud_probability > 0.5e0 AS is_fraud,
    CASE WHEN fraud_probability > 0.7e0 THEN 'HIGH' WHEN fraud_probability > 0.3e0 THEN 'MEDIUM'
      ELSE 'LOW' END AS risk_level
  FROM _prob)""",
    ),
    "history": (
        ("transactions",),
        """history AS (
  SELECT nameOrig, max(step) AS last_transaction, count(amount) AS transaction_count,
    avg(amount) AS avg_amount, coalesce(stddev_samp(amount), 0e0) AS std_amount,
    CAST(sum(isFraud) AS BIGINT) AS fraud_count
  FROM transactions GROUP BY nameOrig)""",
    ),
    "reduced": (
        ("indicators", "history"),
        """_profiled AS (
  SELECT i.* EXCLUDE (fraud_probability, is_fraud, risk_level, fraud_indicators),
    i.fraud_probability AS p0, coalesce(h.transaction_count, 0) AS n,
    coalesce(h.fraud_count, 0) AS f, coalesce(h.avg_amount, 0e0) AS mean,
    coalesce(h.std_amount, 0e0) AS std
  FROM indicators i LEFT JOIN history h ON i.nameOrig = h.nameOrig),
_measured AS (
  SELECT *, f / greatest(n, 1) AS share, abs(amount - mean) / greatest(std, 1e0) AS z
  FROM _profiled),
_trusted AS (
  SELECT *, CASE WHEN n > 10 AND f = 0 THEN p0 * 0.7e0 WHEN n > 5 AND share < 0.1e0
    THEN p0 * 0.85e0 WHEN share > 0.5e0 THEN p0 * 1.3e0 ELSE p0 END AS t
  FROM _measured),
_adjusted AS (
  SELECT *, greatest(least(
    CASE WHEN amount > 200000 THEN CASE WHEN n > 50 AND f = 0 THEN p0 * 0.9e0 ELSE p0 END
      WHEN amount > 100000 THEN CASE WHEN n > 20 AND f = 0 THEN p0 * 0.8e0
        WHEN n > 10 AND f = 0 THEN p0 * 0.85e0 WHEN share > 0.5e0 THEN p0 * 1.2e0 ELSE p0 END
      ELSE CASE WHEN mean > 0 AND z < 2 THEN t * 0.8e0 WHEN mean > 0 AND z > 3 THEN t * 1.2e0
        ELSE t END END, 0.99e0), 0.01e0) AS fraud_probability,
    CASE WHEN n > 20 AND f = 0 THEN 0.65e0 WHEN n > 10 AND f = 0 THEN 0.6e0
      WHEN share > 0.3e0 THEN 0.4e0 ELSE 0.5e0 END AS dynamic_threshold
  FROM _trusted),
reduced AS (
  SELECT *, fraud_probability > dynamic_threshold AS is_fraud,
    (amount < 10000 AND fraud_probability > 0.7e0)
      OR (n > 10 AND f = 0 AND fraud_probability > 0.6e0)
      OR (mean > 0 AND z < 1.5e0 AND fraud_probability > 0.6e0) AS is_false_positive,
    CASE WHEN fraud_probability >= 0.7e0 THEN 'HIGH' WHEN fraud_probability >= 0.3e0
      THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
    n / greatest(f, 1) AS customer_trust_score
  FROM _adjusted)""",
    ),
    "account_cache": (
        ("tx_events",),
        """_newest AS (
  SELECT *, row_number() OVER (PARTITION BY nameOrig ORDER BY ts DESC, tx_id DESC) AS rn
  FROM tx_events),
account_cache AS (
  SELECT 'account:' || nameOrig AS cache_key, tx_id, type, amount, ts AS cached_at,
    ts + INTERVAL 1800 SECOND AS expires_at
  FROM _newest WHERE rn = 1)""",
    ),
    "lookups": (
        ("transactions", "account_cache"),
        """lookups AS (
  SELECT t.tx_id, a.cache_key IS NOT NULL AS cache_hit,
    coalesce(a.amount, t.amount) AS amount, coalesce(a.type, t.type) AS type
  FROM transactions t LEFT JOIN account_cache a ON 'account:' || t.nameOrig = a.cache_key
    AND a.expires_at > (SELECT max(ts) FROM events))""",
    ),
}


def with_tables(body: str, *tables: str, recursive: bool = False) -> str:
    """``body`` preceded by the named tables and what they build on."""
    order: list[str] = []

    def add(name: str) -> None:
        needs, _ = _PARTS[name]
        for need in needs:
            add(need)
        if name not in order:
            order.append(name)

    for name in tables:
        add(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ",\n".join(_PARTS[name][1] for name in order) + "\n" + body
