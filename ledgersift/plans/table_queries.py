"""Windows, quality, drift, selection, sampling, layout and file queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgersift.functions import features as X
from ledgersift.operators import analytics as A
from ledgersift.operators import drift as D
from ledgersift.operators import layout as L
from ledgersift.operators import quality as Q
from ledgersift.operators import sampling as P
from ledgersift.operators import selection as E
from ledgersift.operators import windows as W
from ledgersift.plans.catalog import CHECKS, query, rounded
from ledgersift.plans.etl import run_etl
from ledgersift.plans.row_queries import COMBINED_SQL, RISK_SQL
from ledgersift.plans.sql import with_tables
from ledgersift.schema import CRITICAL_COLUMNS, NUMERIC_FEATURES
from ledgersift.session import work_path
from ledgersift.sources import views as V
from ledgersift.sources.feature_tables import FeatureTables
from ledgersift.sources.files import load_features, read_transactions_csv, write_partitioned

_TX = "transactions"
_COLUMNS = (
    ("tx_id", "bigint"), ("step", "int"), ("type", "string"), ("amount", "double"),
    ("oldbalanceOrg", "double"), ("newbalanceOrig", "double"), ("nameOrig", "string"),
    ("nameDest", "string"), ("oldbalanceDest", "double"), ("newbalanceDest", "double"),
    ("isFraud", "int"), ("isFlaggedFraud", "int"),
)
_NUMERIC = [c for c, kind in _COLUMNS if kind != "string"]

# ---------------------------------------------------------------- windows

_ROLLING_SQL = """
  count(*) OVER r AS tx_count_last_10, sum(amount) OVER r AS amount_sum_last_10,
  avg(amount) OVER r AS amount_avg_last_10, lag(amount) OVER o AS prev_amount,
  step - lag(step) OVER o AS time_since_last_tx,
  CASE WHEN lag(amount) OVER o IS NULL THEN 0e0 ELSE amount - lag(amount) OVER o END AS amount_change,
  CASE WHEN step - lag(step) OVER o = 0 THEN 0e0 ELSE 1e0 / (step - lag(step) OVER o) END
    AS tx_frequency"""
_RUNNING_SQL = """
  avg(amount) OVER k AS type_amount_avg, max(amount) OVER k AS type_amount_max,
  stddev_samp(amount) OVER k AS type_amount_std,
  CASE WHEN avg(amount) OVER k = 0 THEN 0e0 ELSE amount / avg(amount) OVER k END
    AS amount_to_type_avg_ratio"""
_FRAMES = """WINDOW o AS (PARTITION BY nameOrig ORDER BY step, tx_id),
  r AS (PARTITION BY nameOrig ORDER BY step, tx_id ROWS BETWEEN 10 PRECEDING AND CURRENT ROW),
  k AS (PARTITION BY nameOrig, type ORDER BY step)"""
_ROLLING = (
    "tx_count_last_10", "amount_sum_last_10", "amount_avg_last_10", "prev_amount",
    "time_since_last_tx", "amount_change", "tx_frequency",
)
_RUNNING = ("type_amount_avg", "type_amount_max", "type_amount_std", "amount_to_type_avg_ratio")
_RISK = ("is_high_risk_type", "amount_risk_score", "balance_change_risk", "combined_risk_score")
_ROUND = {
    "amount_sum_last_10": 4, "amount_avg_last_10": 4, "type_amount_avg": 4,
    "type_amount_std": 4, "amount_to_type_avg_ratio": 6,
}


def _rounded_columns(columns) -> str:
    shown = {c: f"round({c}, {d}) AS {c}" for c, d in _ROUND.items()}
    shown["time_since_last_tx"] = "CAST(time_since_last_tx AS DOUBLE) AS time_since_last_tx"
    return ", ".join(shown.get(c, c) for c in columns)


def _window_sql(inner: str, columns) -> str:
    return with_tables(
        f"""SELECT tx_id, {_rounded_columns(columns)}
FROM (SELECT *, {inner} FROM transactions {_FRAMES})""",
        _TX,
    )


def _chosen(df, columns):
    if "time_since_last_tx" in columns:
        # A nullable integer would reach a client as double or as object, depending on it.
        df = df.withColumn("time_since_last_tx", F.col("time_since_last_tx").cast("double"))
    return rounded(df.select("tx_id", *columns), **{c: d for c, d in _ROUND.items() if c in columns})


@query("temporal_features", _window_sql(_ROLLING_SQL, _ROLLING))
def temporal_features(spark, sf_dir):
    return _chosen(W.temporal_features(V.transactions(spark, sf_dir)), _ROLLING)


@query("type_account_features", _window_sql(_RUNNING_SQL, _RUNNING))
def type_account_features(spark, sf_dir):
    return _chosen(W.type_account_features(V.transactions(spark, sf_dir)), _RUNNING)


@query(
    "account_features",
    with_tables(
        f"""SELECT tx_id, {_rounded_columns(_ROLLING + _RUNNING + _RISK[:3])}, {COMBINED_SQL}
FROM (SELECT *, {_ROLLING_SQL}, {_RUNNING_SQL}, {RISK_SQL} FROM transactions {_FRAMES})""",
        _TX,
    ),
)
def account_features(spark, sf_dir):
    """The combined feature table; ``feature_pipeline`` is its other name."""
    return _chosen(W.account_features(V.transactions(spark, sf_dir)), _ROLLING + _RUNNING + _RISK)


query("feature_pipeline", CHECKS["account_features"])(account_features)


# ---------------------------------------------------------------- quality


def _dirty(spark, sf_dir):
    return V.dirty_transactions(spark, sf_dir)


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


@query(
    "null_counts",
    with_tables(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM dirty"
            for c, _ in _COLUMNS
        ),
        "dirty",
    ),
)
def null_counts(spark, sf_dir):
    return Q.null_counts(_dirty(spark, sf_dir))


_DUPLICATES = """_dup AS (
  SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty))
    AS distinct_rows FROM dirty)"""


@query(
    "duplicate_count",
    with_tables(
        f""", {_DUPLICATES}
SELECT total_rows, distinct_rows, total_rows - distinct_rows AS duplicate_count,
  round((total_rows - distinct_rows) / total_rows * 100e0, 6) AS duplicate_pct FROM _dup""",
        "dirty",
    ),
)
def duplicate_count(spark, sf_dir):
    return rounded(Q.duplicate_count(_dirty(spark, sf_dir)), duplicate_pct=6)


def _profile_sql(column: str, kind: str) -> str:
    numeric = kind != "string"

    def stat(fn: str, digits: int | None = None) -> str:
        if not numeric:
            return "CAST(NULL AS DOUBLE)"
        value = f"{fn}(CAST({column} AS DOUBLE))"
        return f"round({value}, {digits})" if digits else value

    return f"""SELECT '{column}' AS column_name, '{kind}' AS data_type,
  count(*) FILTER ({column} IS NULL) AS null_count,
  round(count(*) FILTER ({column} IS NULL) / count(*) * 100e0, 6) AS null_percentage,
  count(DISTINCT {column}) + CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END AS unique_count,
  {stat('min')} AS min_value, {stat('max')} AS max_value, {stat('avg', 4)} AS mean_value,
  {stat('stddev_samp', 4)} AS std_value FROM dirty"""


@query("column_profile", with_tables(_union(_profile_sql(*c) for c in _COLUMNS), "dirty"))
def column_profile(spark, sf_dir):
    profile = Q.column_profile(_dirty(spark, sf_dir))
    return rounded(profile, null_percentage=6, mean_value=4, std_value=4)


@query(
    "describe",
    with_tables(
        _union(
            f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
  CAST(max({c}) AS DOUBLE) AS max FROM transactions"""
            for c in _NUMERIC
        ),
        _TX,
    ),
)
def describe(spark, sf_dir):
    return rounded(Q.describe(V.transactions(spark, sf_dir)), mean=4, stddev=4)


def _check_sql(name: str, pct: str, limit: str, source: str, fail: str = "FAIL") -> str:
    return f"""SELECT '{name}' AS check_name,
  CASE WHEN {pct} <= {limit} THEN 'PASS' ELSE '{fail}' END AS status,
  {limit} AS expected_value, round({pct}, 6) AS actual_value FROM {source}"""


_NULLS_SQL = _check_sql(
    "Null Values Check", "nulls / cells * 100e0", "5e0",
    "(SELECT " + " + ".join(f"count(*) FILTER ({c} IS NULL)" for c, _ in _COLUMNS)
    + f" AS nulls, count(*) * {len(_COLUMNS)} AS cells FROM dirty)",
)
_DUPS_SQL = _check_sql(
    "Duplicate Check", "(total_rows - distinct_rows) / total_rows * 100e0", "1e0", "_dup"
)
_MISMATCH = "type = 'CASH_OUT' AND newbalanceOrig <> oldbalanceOrg - amount"
_BALANCE_SQL = _check_sql(
    "Balance Consistency Check", "bad / n * 100e0", "1e0",
    f"(SELECT count(*) FILTER ({_MISMATCH}) AS bad, "
    "count(*) FILTER (type = 'CASH_OUT') AS n FROM dirty)",
)


def _outlier_sql(c: str) -> str:
    return _check_sql(
        f"Outlier Check ({c})", "pct", "5e0",
        f"""(SELECT count(*) FILTER ({c} < m - s * 3e0 OR {c} > m + s * 3e0) / count(*) * 100e0 AS pct
    FROM dirty, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM dirty))""",
        "WARNING",
    )


@query("check_nulls", with_tables(_NULLS_SQL, "dirty"))
def check_nulls(spark, sf_dir):
    return rounded(Q.check_nulls(_dirty(spark, sf_dir)), actual_value=6)


@query("check_duplicates", with_tables(f", {_DUPLICATES} {_DUPS_SQL}", "dirty"))
def check_duplicates(spark, sf_dir):
    return rounded(Q.check_duplicates(_dirty(spark, sf_dir)), actual_value=6)


@query(
    "check_outliers",
    with_tables(
        _union(
            [
                *[_outlier_sql(c) for c in _NUMERIC],
                """SELECT 'Outlier Check (type)', 'WARNING', 0e0, 0e0""",
            ]
        ),
        "dirty",
    ),
)
def check_outliers(spark, sf_dir):
    return rounded(Q.check_outliers(_dirty(spark, sf_dir), [*_NUMERIC, "type"]), actual_value=6)


@query(
    "check_range",
    with_tables(
        _check_sql(
            "Range Check (amount)",
            "(SELECT count(*) FILTER (amount < 0 OR amount > 1000000) / count(*) * 100e0 FROM dirty)",
            "0e0", "(SELECT 1)",
        ),
        "dirty",
    ),
)
def check_range(spark, sf_dir):
    return rounded(Q.check_range(_dirty(spark, sf_dir), "amount", 0.0, 1000000.0), actual_value=6)


@query("check_balance", with_tables(_BALANCE_SQL, "dirty"))
def check_balance(spark, sf_dir):
    return rounded(Q.check_balance(_dirty(spark, sf_dir)), actual_value=6)


@query(
    "check_transfer_balance",
    with_tables(
        """SELECT count(*) FILTER (newbalanceOrig <> oldbalanceOrg - amount
  OR newbalanceDest <> oldbalanceDest + amount) AS inconsistent, count(*) AS transfers
FROM dirty WHERE type = 'TRANSFER'""",
        "dirty",
    ),
)
def check_transfer_balance(spark, sf_dir):
    return Q.check_transfer_balance(_dirty(spark, sf_dir))


@query(
    "negative_counts",
    with_tables(
        _union(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < 0) AS negative_count FROM dirty"
            for c in _NUMERIC
        ),
        "dirty",
    ),
)
def negative_counts(spark, sf_dir):
    return Q.negative_counts(_dirty(spark, sf_dir))


_ALL_CHECKS = f"""_checks AS ({_union([_NULLS_SQL, _DUPS_SQL, _BALANCE_SQL,
    *[_outlier_sql(c) for c in _NUMERIC if c != 'tx_id']])})"""


@query(
    "run_all_checks", with_tables(f", {_DUPLICATES}, {_ALL_CHECKS} SELECT * FROM _checks", "dirty")
)
def run_all_checks(spark, sf_dir):
    return rounded(Q.run_all_checks(_dirty(spark, sf_dir)), actual_value=6)


@query(
    "check_summary",
    with_tables(
        f", {_DUPLICATES}, {_ALL_CHECKS} SELECT status, count(*) AS checks FROM _checks GROUP BY 1",
        "dirty",
    ),
)
def check_summary(spark, sf_dir):
    return Q.check_summary(Q.run_all_checks(_dirty(spark, sf_dir)))


@query(
    "anomaly_alerts",
    with_tables(
        f", {_DUPLICATES}, {_ALL_CHECKS} SELECT * FROM _checks WHERE status <> 'PASS'", "dirty"
    ),
)
def anomaly_alerts(spark, sf_dir):
    return rounded(Q.anomaly_alerts(Q.run_all_checks(_dirty(spark, sf_dir))), actual_value=6)


@query(
    "quality_score",
    with_tables(
        f""", {_DUPLICATES}, _issues AS (SELECT
  {" + ".join(f"count(*) FILTER ({c} IS NULL)" for c, _ in _COLUMNS)} AS total_nulls,
  (SELECT total_rows - distinct_rows FROM _dup) AS duplicates,
  count(*) FILTER ({_MISMATCH}) AS inconsistent FROM dirty),
_scored AS (SELECT *, 100e0 - least(total_nulls / 1000e0, 20e0) - least(duplicates / 10000e0, 15e0)
  - least(inconsistent / 10000e0, 10e0) AS q FROM _issues)
SELECT total_nulls, duplicates, inconsistent, round(q, 6) AS quality_score,
  CASE WHEN q >= 90 THEN 'A' WHEN q >= 75 THEN 'B' WHEN q >= 60 THEN 'C' ELSE 'D' END AS grade,
  q >= 75 AS passed FROM _scored""",
        "dirty",
    ),
)
def quality_score(spark, sf_dir):
    return rounded(Q.quality_score(_dirty(spark, sf_dir)), quality_score=6)


_ISSUES = {f"null:{c}": f"{c} IS NULL" for c in CRITICAL_COLUMNS}
_ISSUES |= {"negative_amount": "amount < 0", "cash_out_mismatch": _MISMATCH}


@query(
    "validate_transactions",
    with_tables(
        "SELECT * FROM ("
        + _union(
            f"SELECT '{name}' AS issue, count(*) FILTER ({test}) AS row_count FROM dirty"
            for name, test in _ISSUES.items()
        )
        + ") WHERE row_count > 0",
        "dirty",
    ),
)
def validate_transactions(spark, sf_dir):
    return Q.validate_transactions(_dirty(spark, sf_dir))


# ---------------------------------------------------------------- drift, selection

_FEATURES = [c for c in _NUMERIC if c != "tx_id"]
_MIDDLE = "(SELECT floor((min(step) + max(step)) / 2) FROM transactions)"


def _stats_sql(where: str) -> str:
    return _union(
        f"""SELECT '{c}' AS feature, coalesce(avg({c}), 0e0) AS mean,
  coalesce(stddev_samp({c}), 0e0) AS std, coalesce(CAST(min({c}) AS DOUBLE), 0e0) AS min,
  coalesce(CAST(max({c}) AS DOUBLE), 0e0) AS max, count({c}) AS count FROM transactions {where}"""
        for c in _FEATURES
    )


@query(
    "feature_statistics",
    with_tables(
        f"""SELECT feature, round(mean, 4) AS mean, round(std, 4) AS std, min, max, count
FROM ({_stats_sql("")})""",
        _TX,
    ),
)
def feature_statistics(spark, sf_dir):
    return rounded(D.feature_statistics(V.transactions(spark, sf_dir)), mean=4, std=4)


_ALERTS = f"""_b AS ({_stats_sql(f"WHERE step <= {_MIDDLE}")}),
_c AS ({_stats_sql(f"WHERE step > {_MIDDLE}")}),
_measures AS (
  SELECT feature, 'MEAN_DRIFT' AS alert_type, b.mean AS baseline_value, c.mean AS current_value,
    0.10e0 AS threshold FROM _b b JOIN _c c USING (feature)
  UNION ALL SELECT feature, 'STD_DRIFT', b.std, c.std, 0.15e0 FROM _b b JOIN _c c USING (feature)
  UNION ALL SELECT feature, 'DISTRIBUTION_DRIFT', b.max - b.min, c.max - c.min, 0.20e0
  FROM _b b JOIN _c c USING (feature)),
_alerts AS (
  SELECT *, CASE WHEN drift_score > threshold * 2e0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
  FROM (SELECT *, CASE WHEN baseline_value <> 0
    THEN abs(current_value - baseline_value) / abs(baseline_value) END AS drift_score
    FROM _measures) WHERE drift_score > threshold)"""


def _alerts(spark, sf_dir):
    """Drift of the later half of the steps against the earlier half."""
    tx = V.transactions(spark, sf_dir)
    middle = tx.select(F.floor((F.min("step") + F.max("step")) / 2)).scalar()
    before = D.feature_statistics(tx.filter(F.col("step") <= middle))
    after = D.feature_statistics(tx.filter(F.col("step") > middle))
    return D.drift_alerts(before, after)


@query(
    "drift_alerts",
    with_tables(
        f""", {_ALERTS} SELECT feature, alert_type, round(baseline_value, 4) AS baseline_value,
  round(current_value, 4) AS current_value, threshold, round(drift_score, 6) AS drift_score, severity
FROM _alerts""",
        _TX,
    ),
)
def drift_alerts(spark, sf_dir):
    return rounded(_alerts(spark, sf_dir), baseline_value=4, current_value=4, drift_score=6)


@query(
    "drift_summary",
    with_tables(
        f""", {_ALERTS} SELECT count(*) AS total_alerts,
  count(*) FILTER (severity = 'HIGH') AS high_severity,
  count(*) FILTER (severity = 'MEDIUM') AS medium_severity FROM _alerts""",
        _TX,
    ),
)
def drift_summary(spark, sf_dir):
    return D.drift_summary(_alerts(spark, sf_dir))


# The table that features are selected from: raw and derived columns, one of them with gaps.
_DERIVED_SQL = """_features AS (SELECT *,
  CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0e0 END AS ratio_guarded,
  amount / greatest(oldbalanceOrg, 1e0) AS ratio_floor1,
  CASE WHEN amount > 100000 THEN 1 ELSE 0 END AS is_large_amount,
  newbalanceOrig - oldbalanceOrg AS balance_change_orig,
  newbalanceDest - oldbalanceDest AS balance_change_dest,
  CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS is_zero_balance_orig,
  CASE WHEN tx_id % 97 = 0 THEN NULL ELSE amount END AS known_amount FROM transactions)"""


def _feature_table(spark, sf_dir):
    gaps = F.when(F.col("tx_id") % 97 != 0, F.col("amount"))
    return V.transactions(spark, sf_dir).withColumns(
        {
            "ratio_guarded": X.amount_ratio("guarded"),
            "ratio_floor1": X.amount_ratio("floor1"),
            "is_large_amount": X.is_large_amount(),
            "balance_change_orig": X.balance_change_orig(),
            "balance_change_dest": X.balance_change_dest(),
            "is_zero_balance_orig": X.is_zero_balance_orig(),
            "known_amount": gaps,
        }
    )


_SELECTABLE = [
    *NUMERIC_FEATURES, "ratio_guarded", "ratio_floor1", "is_large_amount", "balance_change_orig",
    "balance_change_dest", "is_zero_balance_orig", "known_amount",
]
_VARIANCE = f"{_DERIVED_SQL}, _variance AS (" + _union(
    f"SELECT '{c}' AS feature, {i} AS position, coalesce(var_samp({c}), 0e0) AS variance FROM _features"
    for i, c in enumerate(_SELECTABLE)
) + ")"
_CORRELATION = "_corr AS (" + _union(
    f"SELECT '{a}' AS feature1, '{b}' AS feature2, corr({a}, {b}) AS r FROM _features"
    for i, a in enumerate(_SELECTABLE)
    for b in _SELECTABLE[i + 1 :]
) + ")"
_IMPORTANCE = "_importance AS (" + _union(
    f"SELECT '{c}' AS feature, coalesce(abs(corr({c}, isFraud)), 0e0) AS importance FROM _features"
    for c in _SELECTABLE
) + ")"


_SELECTION = """_dropped AS (SELECT DISTINCT feature2 AS feature FROM _corr WHERE abs(r) >= 0.95e0
  AND feature1 IN (SELECT feature FROM _variance WHERE variance >= 0.01e0)),
_table AS (
  SELECT v.feature, v.position, variance, importance, variance >= 0.01e0 AS keep,
    variance >= 0.01e0 AND v.feature NOT IN (SELECT feature FROM _dropped) AS ok
  FROM _variance v JOIN _importance i USING (feature)),
_ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY ok ORDER BY importance DESC, position)
  AS INT) AS place FROM _table)"""


@query(
    "feature_variance",
    with_tables(
        f""", {_VARIANCE} SELECT feature, round(variance, 2) AS variance,
  variance >= 0.01e0 AS keep FROM _variance""",
        _TX,
    ),
)
def feature_variance(spark, sf_dir):
    found = E.feature_variance(_feature_table(spark, sf_dir), _SELECTABLE).drop("position")
    return rounded(found, variance=2)


@query(
    "correlation_matrix",
    with_tables(
        f", {_DERIVED_SQL}, {_CORRELATION} SELECT feature1, feature2, round(r, 6) AS correlation FROM _corr", _TX
    ),
)
def correlation_matrix(spark, sf_dir):
    matrix = E.correlation_matrix(_feature_table(spark, sf_dir), _SELECTABLE)
    return rounded(matrix, correlation=6)


@query(
    "correlated_features",
    with_tables(
        f""", {_DERIVED_SQL}, {_CORRELATION} SELECT feature1, feature2, round(abs(r), 6) AS correlation
FROM _corr WHERE abs(r) >= 0.95e0""",
        _TX,
    ),
)
def correlated_features(spark, sf_dir):
    matrix = E.correlation_matrix(_feature_table(spark, sf_dir), _SELECTABLE)
    return rounded(E.correlated_features(matrix), correlation=6)


@query(
    "feature_importance",
    with_tables(
        f", {_DERIVED_SQL}, {_IMPORTANCE} SELECT feature, round(importance, 6) AS importance FROM _importance", _TX
    ),
)
def feature_importance(spark, sf_dir):
    found = E.feature_importance(_feature_table(spark, sf_dir), _SELECTABLE).drop("position")
    return rounded(found, importance=6)


@query(
    "select_features",
    with_tables(
        f""", {_VARIANCE}, {_CORRELATION}, {_IMPORTANCE}, {_SELECTION}
SELECT feature, CASE WHEN NOT keep THEN 'low_variance' WHEN NOT ok THEN 'correlated'
  WHEN place <= 4 THEN 'selected' ELSE 'below_top_n' END AS status, round(variance, 2) AS variance,
  round(importance, 6) AS importance, CASE WHEN ok THEN place END AS rank FROM _ranked""",
        _TX,
    ),
)
def select_features(spark, sf_dir):
    chosen = E.select_features(_feature_table(spark, sf_dir), _SELECTABLE, top_n=4)
    return rounded(chosen, variance=2, importance=6)


# ---------------------------------------------------------------- sampling, layout


@query(
    "balanced_sample",
    with_tables(
        """SELECT tx_id, isFraud, amount FROM (SELECT *, row_number() OVER (PARTITION BY isFraud
  ORDER BY md5('42:' || tx_id), tx_id) AS place FROM transactions)
WHERE place <= CASE WHEN isFraud = 1 THEN 5000 ELSE 50000 END""",
        _TX,
    ),
)
def balanced_sample(spark, sf_dir):
    sample = P.balanced_sample(V.transactions(spark, sf_dir), fraud_rows=5000, normal_rows=50000)
    return sample.select("tx_id", "isFraud", "amount")


@query(
    "sample_fraction",
    with_tables(
        f"""SELECT tx_id, amount FROM transactions
WHERE substr(md5('42:' || tx_id), 1, 8) < '{int(0.1 * 2**32):08x}'""",
        _TX,
    ),
)
def sample_fraction(spark, sf_dir):
    return P.sample_fraction(V.transactions(spark, sf_dir), 0.1).select("tx_id", "amount")


@query(
    "train_test_split",
    with_tables(
        f"""SELECT tx_id, CASE WHEN substr(md5('42:' || tx_id), 1, 8) < '{int(0.8 * 2**32):08x}'
  THEN 'train' ELSE 'test' END AS split FROM transactions""",
        _TX,
    ),
)
def train_test_split(spark, sf_dir):
    train, test = P.train_test_split(V.transactions(spark, sf_dir))
    parts = [d.select("tx_id", F.lit(n).alias("split")) for d, n in ((train, "train"), (test, "test"))]
    return parts[0].unionByName(parts[1])


_LAYOUT_SQL = with_tables(
    "SELECT count(*) AS total_rows, {} AS partitions, TRUE AS in_order FROM transactions", _TX
)


def _report_figures(report, partitions):
    """What SQL can know of a layout: rows, planned partitions, and that the figures fit."""
    rows = F.round(F.col("avg_rows") * F.col("partitions")).cast("bigint")
    fits = (F.col("min_rows") <= F.col("avg_rows")) & (F.col("avg_rows") <= F.col("max_rows"))
    return report.select(rows.alias("total_rows"), partitions.alias("partitions"), fits.alias("in_order"))


@query("partition_report", _LAYOUT_SQL.replace("{}", "16"))
def partition_report(spark, sf_dir):
    report = L.partition_report(L.by_amount_range(V.transactions(spark, sf_dir), 16), 16)
    return _report_figures(report, F.col("partitions"))


@query("salted_partition_report", _LAYOUT_SQL.replace("{}", "1"))
def salted_partition_report(spark, sf_dir):
    """Adaptive execution may merge partitions again; at least one is filled."""
    report = L.partition_report(L.by_type(V.transactions(spark, sf_dir), salts=16))
    return _report_figures(report, F.least(F.col("partitions"), F.lit(1)))


# ---------------------------------------------------------------- files and tables

_ALL_TX = with_tables("SELECT * FROM transactions", _TX)
_NO_ID = with_tables("SELECT * EXCLUDE (tx_id) FROM transactions", _TX)


def _as_csv(spark, sf_dir, amount=None) -> str:
    path = work_path(spark, "csv")
    tx = V.transactions(spark, sf_dir)
    if amount is not None:
        tx = tx.withColumn("amount", amount)
    ordered = ["step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest",
               "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud"]
    tx.select(*ordered).write.option("header", True).csv(path)
    return path


@query("csv_scan", _NO_ID)
def csv_scan(spark, sf_dir):
    return read_transactions_csv(spark, _as_csv(spark, sf_dir))


@query("write_partitioned", _ALL_TX)
def write_partitioned_query(spark, sf_dir):
    path = work_path(spark, "partitioned")
    write_partitioned(V.transactions(spark, sf_dir), path)
    return spark.read.parquet(path)


def _feature_tables(spark, sf_dir) -> FeatureTables:
    tables = FeatureTables(spark, work_path(spark, "features"))
    tables.create(V.transactions(spark, sf_dir), "transactions")
    return tables


@query(
    "feature_table_write",
    with_tables(
        """SELECT 'transactions' AS name, 'table' AS feature_type, 1 AS version, count(*) AS row_count
FROM transactions""",
        _TX,
    ),
)
def feature_table_write(spark, sf_dir):
    tables = _feature_tables(spark, sf_dir)
    rows = tables.load("transactions").count()
    found = tables.metadata().select("name", "feature_type", "version")
    return found.withColumn("row_count", F.lit(rows).cast("bigint"))


@query("feature_table_read", _ALL_TX)
def feature_table_read(spark, sf_dir):
    return _feature_tables(spark, sf_dir).load("transactions")


@query(
    "feature_version",
    with_tables(
        """SELECT 'type_stats' AS name, 2 AS version, count(DISTINCT type) AS rows_now,
  count(DISTINCT type) FILTER (amount > 1000000) AS rows_before FROM transactions""",
        _TX,
    ),
)
def feature_version(spark, sf_dir):
    """Two versions of one table; the older one stays readable."""
    tables = FeatureTables(spark, work_path(spark, "features"))
    tx = V.transactions(spark, sf_dir)
    for part in (tx.filter(F.col("amount") > 1000000), tx):
        tables.create(A.type_stats(part), "type_stats")
    before, now = tables.load("type_stats", 1).count(), tables.load("type_stats").count()
    return tables.versions("type_stats").select(
        "name", "version", F.lit(now).cast("bigint").alias("rows_now"),
        F.lit(before).cast("bigint").alias("rows_before"),
    )


@query(
    "selected_features",
    with_tables(
        f""", {_VARIANCE}, {_CORRELATION}, {_IMPORTANCE}, {_SELECTION}
SELECT feature AS column_name, (SELECT count(*) FROM transactions) AS row_count FROM _ranked
WHERE ok AND place <= 4 UNION ALL SELECT 'isFraud', count(*) FROM transactions""",
        _TX,
    ),
)
def selected_features(spark, sf_dir):
    """The selected columns, saved as a feature table and read again."""
    source = _feature_table(spark, sf_dir)
    chosen = E.select_features(source, _SELECTABLE, top_n=4)
    tables = FeatureTables(spark, work_path(spark, "features"))
    tables.create(E.apply_selection(source, chosen), "selected")
    saved = tables.load("selected")
    rows = saved.count()
    return spark.createDataFrame([(c, rows) for c in saved.columns], "column_name string, row_count bigint")


@query(
    "drift_files",
    with_tables(
        f""", {_ALERTS} SELECT 'baseline' AS file, count(*) AS row_count FROM _b
UNION ALL SELECT 'alerts', count(*) FROM _alerts""",
        _TX,
    ),
)
def drift_files(spark, sf_dir):
    """The first call stores a baseline, the second one finds it; alerts go to a file."""
    tx = V.transactions(spark, sf_dir)
    middle = tx.select(F.floor((F.min("step") + F.max("step")) / 2)).first()[0]
    baseline, alerts = work_path(spark, "baseline"), work_path(spark, "alerts")
    D.monitor_drift(tx.filter(F.col("step") <= middle), None, baseline)
    found = D.monitor_drift(tx.filter(F.col("step") > middle), None, baseline)
    D.save_alerts(found, alerts)
    stored = D.load_baseline(spark, baseline)
    names = "feature string, alert_type string"
    return stored.agg(F.lit("baseline").alias("file"), F.count(F.lit(1)).alias("row_count")).unionByName(
        spark.read.schema(names).json(alerts).agg(
            F.lit("alerts").alias("file"), F.count(F.lit(1)).alias("row_count")
        )
    )


@query("load_features", _NO_ID)
def load_features_query(spark, sf_dir):
    """No feature table exists at the first path, so the CSV is read."""
    return load_features(spark, work_path(spark, "absent"), _as_csv(spark, sf_dir))


@query(
    "etl_run_metrics",
    with_tables(
        f"""SELECT count(*) AS total_records, count(*) FILTER (tx_id % 50 <> 0) AS processed_records,
  count(*) FILTER (tx_id % 50 = 0) AS error_records,
  count(*) FILTER (tx_id % 50 <> 0 AND isFraud = 1) AS fraud_records,
  CASE WHEN count(*) FILTER (tx_id % 50 <> 0 AND {_MISMATCH}) > 0 THEN 1 ELSE 0 END AS warnings,
  round(100e0 * count(*) FILTER (tx_id % 50 <> 0) / count(*), 6) AS success_rate_pct FROM transactions""",
        _TX,
    ),
)
def etl_run_metrics(spark, sf_dir):
    """Load a CSV file in which every fiftieth row has an amount that is no number."""
    amount = F.when(F.col("tx_id") % 50 == 0, "oops").otherwise(F.col("amount").cast("string"))
    source = _as_csv(spark, sf_dir, amount)
    metrics = run_etl(spark, source, work_path(spark, "etl"))
    metrics = rounded(metrics, success_rate_pct=6)
    return metrics.drop("stages", "seconds")
