"""Row features, rule scores, lookups and filters over all transactions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgersift.functions import features as X
from ledgersift.functions import scoring as S
from ledgersift.operators import analytics as A
from ledgersift.operators import cache as C
from ledgersift.operators import history as H
from ledgersift.operators import layout as L
from ledgersift.plans.catalog import query, rounded
from ledgersift.plans.sql import with_tables
from ledgersift.schema import BALANCE_COLUMNS, TYPES, TX_SCHEMA
from ledgersift.sources import views as V

_TX = "transactions"


@query(
    "row_features",
    with_tables(
        """SELECT tx_id,
  CASE WHEN oldbalanceOrg = 0 THEN 0e0
    ELSE CAST(CAST(amount / oldbalanceOrg AS FLOAT) AS DOUBLE) END AS ratio_etl,
  CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0e0 END AS ratio_guarded,
  amount / greatest(oldbalanceOrg, 1e0) AS ratio_floor1,
  CASE WHEN amount > 100000 THEN 1 ELSE 0 END AS is_large_amount,
  CASE WHEN type IN ('TRANSFER','CASH_OUT') AND amount > 100000 THEN 'HIGH'
       WHEN type IN ('TRANSFER','CASH_OUT') AND amount > 50000 THEN 'MEDIUM'
       ELSE 'LOW' END AS risk_category,
  newbalanceOrig - oldbalanceOrg AS balance_change_orig,
  oldbalanceOrg - newbalanceOrig AS balance_outflow_orig,
  newbalanceDest - oldbalanceDest AS balance_change_dest,
  CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS is_zero_balance_orig
FROM transactions""",
        _TX,
    ),
)
def row_features(spark, sf_dir):
    return V.transactions(spark, sf_dir).select(
        "tx_id",
        X.amount_ratio("etl").cast("double").alias("ratio_etl"),
        X.amount_ratio("guarded").alias("ratio_guarded"),
        X.amount_ratio("floor1").alias("ratio_floor1"),
        X.is_large_amount().alias("is_large_amount"),
        X.risk_category().alias("risk_category"),
        X.balance_change_orig().alias("balance_change_orig"),
        X.balance_outflow_orig().alias("balance_outflow_orig"),
        X.balance_change_dest().alias("balance_change_dest"),
        X.is_zero_balance_orig().alias("is_zero_balance_orig"),
    )


_ONE_HOT = ", ".join(f"CASE WHEN type = '{t}' THEN 1 ELSE 0 END AS type_{t}" for t in TYPES)


@query("one_hot_type", with_tables(f"SELECT tx_id, {_ONE_HOT} FROM transactions", _TX))
def one_hot_type(spark, sf_dir):
    columns = [c.alias(name) for name, c in X.one_hot_type().items()]
    return V.transactions(spark, sf_dir).select("tx_id", *columns)


@query("fraud_filter", with_tables("SELECT * FROM transactions WHERE isFraud = 1", _TX))
def fraud_filter(spark, sf_dir):
    return A.fraud_only(V.transactions(spark, sf_dir))


RISK_SQL = """
  CASE WHEN type IN ('TRANSFER','CASH_OUT') THEN 1 ELSE 0 END AS is_high_risk_type,
  CASE WHEN amount > 1000000 THEN 1.0e0 WHEN amount > 500000 THEN 0.8e0
       WHEN amount > 100000 THEN 0.6e0 WHEN amount > 50000 THEN 0.4e0
       ELSE 0.2e0 END AS amount_risk_score,
  CASE WHEN abs(newbalanceOrig - oldbalanceOrg) > oldbalanceOrg * 0.5e0 THEN 1.0e0
       WHEN abs(newbalanceOrig - oldbalanceOrg) > oldbalanceOrg * 0.3e0 THEN 0.6e0
       ELSE 0.2e0 END AS balance_change_risk"""
COMBINED_SQL = """
  is_high_risk_type * 0.4e0 + amount_risk_score * 0.4e0 + balance_change_risk * 0.2e0
    AS combined_risk_score"""


@query(
    "risk_features",
    with_tables(
        f"SELECT *, {COMBINED_SQL} FROM (SELECT tx_id, {RISK_SQL} FROM transactions)", _TX
    ),
)
def risk_features(spark, sf_dir):
    return X.with_risk_features(V.transactions(spark, sf_dir)).select(
        "tx_id", "is_high_risk_type", "amount_risk_score", "balance_change_risk",
        "combined_risk_score",
    )


@query(
    "fallback_score",
    with_tables(
        """SELECT *, CASE WHEN fraud_probability > 0.5e0 THEN 1e0 ELSE 0e0 END AS prediction
FROM (SELECT tx_id, CASE WHEN amount > 100000 THEN 0.8e0 WHEN amount > 50000 THEN 0.5e0
  ELSE 0.1e0 END AS fraud_probability FROM transactions)""",
        _TX,
    ),
)
def fallback_score(spark, sf_dir):
    scored = V.transactions(spark, sf_dir).select(
        "tx_id", S.fallback_score().alias("fraud_probability")
    )
    hit = F.when(F.col("fraud_probability") > 0.5, 1.0).otherwise(0.0)
    return scored.withColumn("prediction", hit)


_ADDITIVE = """_points AS (
  SELECT tx_id, type, amount, least(greatest(
    CASE WHEN amount > 100000 THEN 0.3e0 WHEN amount > 50000 THEN 0.2e0 ELSE 0e0 END
    + CASE WHEN type = 'TRANSFER' THEN 0.2e0 ELSE 0e0 END
    + CASE WHEN amount / greatest(oldbalanceOrg, 1e0) > 0.5e0 THEN 0.2e0 ELSE 0e0 END,
    0e0), 1e0) AS p
  FROM transactions)"""


@query(
    "additive_score",
    with_tables(
        f""", {_ADDITIVE}
SELECT tx_id, round(p, 4) AS fraud_probability, p >= 0.5e0 AS is_fraud,
  CASE WHEN p >= 0.8e0 THEN 'HIGH' WHEN p >= 0.5e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM _points""",
        _TX,
    ),
)
def additive_score(spark, sf_dir):
    p = F.col("p")
    scored = V.transactions(spark, sf_dir).select("tx_id", S.additive_score().alias("p"))
    return scored.select(
        "tx_id",
        F.round(p, 4).alias("fraud_probability"),
        (p >= 0.5).alias("is_fraud"),
        S.additive_risk_level(p).alias("risk_level"),
    )


@query(
    "indicator_score",
    with_tables(
        """SELECT tx_id, fraud_indicators, fraud_probability, is_fraud, risk_level
FROM indicators""",
        "indicators",
    ),
)
def indicator_score(spark, sf_dir):
    return H.indicator_scores(V.transactions(spark, sf_dir)).select(
        "tx_id", "fraud_indicators", "fraud_probability", "is_fraud", "risk_level"
    )


@query(
    "fp_reduction",
    with_tables(
        """SELECT tx_id, nameOrig, n AS transaction_count, f AS fraud_count, p0 AS base_probability,
  fraud_probability, dynamic_threshold, is_fraud, is_false_positive, risk_level,
  customer_trust_score
FROM reduced""",
        "reduced",
    ),
)
def fp_reduction(spark, sf_dir):
    return H.score_with_history(V.transactions(spark, sf_dir)).select(
        "tx_id", "nameOrig", "transaction_count", "fraud_count", "base_probability",
        "fraud_probability", "dynamic_threshold", "is_fraud", "is_false_positive", "risk_level",
        "customer_trust_score",
    )


_PAST = """SELECT t.tx_id, count(h.amount) AS transaction_count,
  CAST(coalesce(sum(h.isFraud), 0) AS BIGINT) AS fraud_count,
  round(coalesce(avg(h.amount), 0e0), 4) AS avg_amount,
  round(coalesce(stddev_samp(h.amount), 0e0), 4) AS std_amount
FROM transactions t LEFT JOIN transactions h ON t.nameOrig = h.nameOrig AND h.step < t.step
GROUP BY t.tx_id"""


@query("past_history", with_tables(_PAST, _TX))
def past_history(spark, sf_dir):
    known = H.with_past_history(V.transactions(spark, sf_dir)).select(
        "tx_id", "profile.transaction_count", "profile.fraud_count", "profile.avg_amount",
        "profile.std_amount",
    )
    return rounded(known, avg_amount=4, std_amount=4)


@query(
    "simple_fp_flag",
    with_tables(
        """SELECT tx_id, fraud_probability, (amount < 10000 AND fraud_probability > 0.7e0)
  OR (amount < 50000 AND fraud_probability > 0.8e0) AS is_false_positive FROM indicators""",
        "indicators",
    ),
)
def simple_fp_flag(spark, sf_dir):
    scored = H.indicator_scores(V.transactions(spark, sf_dir))
    flag = S.simple_false_positive(F.col("fraud_probability"), F.col("amount"))
    return scored.select("tx_id", "fraud_probability", flag.alias("is_false_positive"))


@query(
    "amount_band",
    with_tables(
        """SELECT tx_id, CASE WHEN amount <= 0 THEN NULL WHEN amount <= 10000 THEN 'LOW'
  WHEN amount <= 50000 THEN 'MEDIUM' WHEN amount > 50000 THEN 'HIGH' END AS amount_band
FROM dirty""",
        "dirty",
    ),
)
def amount_band(spark, sf_dir):
    return V.dirty_transactions(spark, sf_dir).select("tx_id", X.amount_band().alias("amount_band"))


@query(
    "model_features",
    with_tables(
        f"""SELECT tx_id, a AS amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest,
  newbalanceDest, step, a / greatest(oldbalanceOrg, 1e0) AS amount_ratio,
  oldbalanceOrg - newbalanceOrig AS balance_change_orig,
  newbalanceDest - oldbalanceDest AS balance_change_dest,
  CASE WHEN a > 100000 THEN 1 ELSE 0 END AS is_large_amount,
  CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS is_zero_balance_orig, {_ONE_HOT}
FROM (SELECT *, coalesce(amount, 0e0) AS a FROM dirty)""",
        "dirty",
    ),
)
def model_features(spark, sf_dir):
    return X.model_features(V.dirty_transactions(spark, sf_dir))


_INPUTS = {c: c for c in ("tx_id", "step", "type", "amount", *BALANCE_COLUMNS)} | {
    "guarded": "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0e0 END",
    "floor1": "amount / greatest(oldbalanceOrg, 1e0)",
    "is_large_amount": "CASE WHEN amount > 100000 THEN 1 ELSE 0 END",
    "balance_change_orig": "oldbalanceOrg - newbalanceOrig",
    "balance_change_dest": "newbalanceDest - oldbalanceDest",
}


def _inputs_sql(columns, ratio):
    sql = _INPUTS | {"amount_ratio": _INPUTS[ratio]}
    return ", ".join(f"{sql[c]} AS {c}" for c in columns)


@query(
    "model_inputs_8",
    with_tables(f"SELECT tx_id, {_inputs_sql(X.MODEL_COLUMNS_8, 'guarded')} FROM transactions", _TX),
)
def model_inputs_8(spark, sf_dir):
    return X.model_features(V.transactions(spark, sf_dir), X.MODEL_COLUMNS_8)


@query(
    "model_inputs_10",
    with_tables(f"SELECT tx_id, {_inputs_sql(X.CACHE_COLUMNS_10, 'floor1')} FROM transactions", _TX),
)
def model_inputs_10(spark, sf_dir):
    return X.model_features(V.transactions(spark, sf_dir), X.CACHE_COLUMNS_10)


@query(
    "cache_lookup_features",
    with_tables(
        f""", _mid AS (SELECT floor((min(step) + max(step)) / 2) AS middle FROM transactions),
_ten AS (SELECT tx_id, step, nameOrig, {_inputs_sql(X.CACHE_COLUMNS_10, "floor1")} FROM transactions),
_entry AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nameOrig ORDER BY step DESC, tx_id DESC) AS r
  FROM _ten WHERE step <= (SELECT middle FROM _mid)) WHERE r = 1)
SELECT q.tx_id, c.step IS NOT NULL AND q.step < c.step + 90 AS cache_hit,
  {", ".join(f"CASE WHEN c.step IS NOT NULL AND q.step < c.step + 90 THEN c.{c} ELSE q.{c} END AS {c}" for c in X.CACHE_COLUMNS_10)}
FROM _ten q LEFT JOIN _entry c USING (nameOrig) WHERE q.step > (SELECT middle FROM _mid)""",
        _TX,
    ),
)
def cache_lookup_features(spark, sf_dir):
    """Ten features from the sender's entry (90 days), computed from the request on a miss."""
    tx = V.transactions(spark, sf_dir)
    at = F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00'") + F.make_dt_interval(F.col("step"))
    rows = X.model_features(tx, X.CACHE_COLUMNS_10, ("tx_id", "step", "nameOrig")).withColumn("ts", at)
    middle = tx.select(F.floor((F.min("step") + F.max("step")) / 2)).scalar()
    older = rows.filter(F.col("step") <= middle).drop("step")
    cache = C.latest_features(older, "nameOrig", ttl=90 * 86400).drop("tx_id")
    requests = rows.filter(F.col("step") > middle).select(
        "tx_id", F.concat(F.lit("account:"), "nameOrig").alias("cache_key"), *X.CACHE_COLUMNS_10,
        F.col("ts").alias("request_ts"),
    )
    found = C.cache_lookup(requests, cache, features=X.CACHE_COLUMNS_10)
    return found.select("tx_id", "cache_hit", *X.CACHE_COLUMNS_10)


@query(
    "search_transactions",
    with_tables(
        """SELECT tx_id, nameOrig, type, amount, isFraud, is_fraud AS ml_is_fraud,
  fraud_probability AS ml_fraud_probability, risk_level AS ml_risk_level
FROM reduced WHERE regexp_matches(nameOrig, 'c12', 'i') OR regexp_matches(type, 'c12', 'i')
ORDER BY tx_id LIMIT 20""",
        "reduced",
    ),
)
def search_transactions(spark, sf_dir):
    return H.search_scored(V.transactions(spark, sf_dir), "c12", 20).select(
        "tx_id", "nameOrig", "type", "amount", "isFraud",
        F.col("is_fraud").alias("ml_is_fraud"),
        F.col("fraud_probability").alias("ml_fraud_probability"),
        F.col("risk_level").alias("ml_risk_level"),
    )


@query(
    "dashboard_filter",
    with_tables(
        """SELECT tx_id, type, amount, risk_level, fraud_probability FROM indicators
WHERE risk_level IN ('HIGH') AND type IN ('TRANSFER','CASH_OUT')""",
        "indicators",
    ),
)
def dashboard_filter(spark, sf_dir):
    scored = H.indicator_scores(V.transactions(spark, sf_dir))
    chosen = A.filter_choices(scored, risk_level=["HIGH"], type=["TRANSFER", "CASH_OUT"])
    return chosen.select("tx_id", "type", "amount", "risk_level", "fraud_probability")


@query("json_roundtrip", with_tables("SELECT * FROM transactions", _TX))
def json_roundtrip(spark, sf_dir):
    tx = V.transactions(spark, sf_dir)
    messages = tx.select(F.to_json(F.struct(*tx.columns)).alias("value"))
    parsed = messages.select(F.from_json("value", TX_SCHEMA).alias("data")).select("data.*")
    return parsed.select(*tx.columns)


_LOOKUP_SQL = with_tables(
    """SELECT t.tx_id, t.type, t.amount, r.risk_score FROM transactions t
LEFT JOIN (VALUES ('CASH_IN', 0.1e0), ('CASH_OUT', 0.8e0), ('DEBIT', 0.05e0),
  ('PAYMENT', 0.02e0), ('TRANSFER', 0.9e0)) r(type, risk_score) ON t.type = r.type""",
    _TX,
)


@query("risk_lookup_join", _LOOKUP_SQL)
def risk_lookup_join(spark, sf_dir):
    joined = L.join_risk(V.transactions(spark, sf_dir), L.risk_lookup(spark))
    return joined.select("tx_id", "type", "amount", "risk_score")


@query("risk_lookup_broadcast", _LOOKUP_SQL)
def risk_lookup_broadcast(spark, sf_dir):
    joined = L.join_risk(V.transactions(spark, sf_dir), L.risk_lookup(spark), broadcast=True)
    return joined.select("tx_id", "type", "amount", "risk_score")


def _account_cache(spark, sf_dir):
    return C.latest_features(V.transaction_events(spark, sf_dir), "nameOrig")


def _lookups(spark, sf_dir):
    """Every transaction asks for its sender's cached features at the end of the stream."""
    now = V.table(spark, sf_dir, "events").select(F.max("ts")).scalar()
    requests = V.transactions(spark, sf_dir).select(
        "tx_id",
        F.concat(F.lit("account:"), "nameOrig").alias("cache_key"),
        "amount",
        "type",
        now.alias("request_ts"),
    )
    return C.cache_lookup(requests, _account_cache(spark, sf_dir))


@query(
    "latest_features",
    with_tables(
        "SELECT cache_key, tx_id, type, amount, cached_at, expires_at FROM account_cache",
        "account_cache",
    ),
)
def latest_features(spark, sf_dir):
    return _account_cache(spark, sf_dir)


@query(
    "cache_lookup",
    with_tables("SELECT tx_id, cache_hit, amount, type FROM lookups", "lookups"),
)
def cache_lookup(spark, sf_dir):
    return _lookups(spark, sf_dir).select("tx_id", "cache_hit", "amount", "type")


@query(
    "cache_hit_stats",
    with_tables(
        """SELECT count(*) FILTER (cache_hit) AS hits, count(*) FILTER (NOT cache_hit) AS misses,
  count(*) AS total_requests, round(count(*) FILTER (cache_hit) / count(*) * 100e0, 4)
  AS hit_rate_percent FROM lookups""",
        "lookups",
    ),
)
def cache_hit_stats(spark, sf_dir):
    return rounded(C.cache_hit_stats(_lookups(spark, sf_dir)), hit_rate_percent=4)


@query(
    "cache_invalidate",
    with_tables(
        "SELECT cache_key, tx_id, type, amount FROM account_cache "
        "WHERE NOT cache_key LIKE 'account:C1%'",
        "account_cache",
    ),
)
def cache_invalidate(spark, sf_dir):
    kept = C.cache_invalidate(_account_cache(spark, sf_dir), "account:C1*")
    return kept.select("cache_key", "tx_id", "type", "amount")


@query(
    "cache_invalidate_count",
    with_tables(
        """SELECT count(*) FILTER (cache_key LIKE 'account:C1%') AS deleted,
  count(*) FILTER (NOT cache_key LIKE 'account:C1%') AS kept FROM account_cache""",
        "account_cache",
    ),
)
def cache_invalidate_count(spark, sf_dir):
    return C.invalidated_count(_account_cache(spark, sf_dir), "account:C1*")


@query(
    "account_risk_history",
    with_tables(
        """SELECT nameOrig, recency, tx_id, step, fraud_probability, risk_level FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY nameOrig ORDER BY step DESC, tx_id DESC) AS INT)
    AS recency FROM indicators) WHERE recency <= 10""",
        "indicators",
    ),
)
def account_risk_history(spark, sf_dir):
    return C.account_risk_history(H.indicator_scores(V.transactions(spark, sf_dir)), 10)
