"""Quantiles, samples, cache, quality checks, selection, drift and logs."""

import math
import random

import numpy as np
import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from ledgersift.operators import analytics as A
from ledgersift.operators import cache as C
from ledgersift.operators import drift as D
from ledgersift.operators import history as H
from ledgersift.operators import layout as L
from ledgersift.operators import opslog as O
from ledgersift.operators import quality as Q
from ledgersift.operators import sampling as P
from ledgersift.operators import selection as E
from ledgersift.operators import sketches as S
from ledgersift.operators.quantiles import exact_quantiles

PS = [0.0, 0.5, 0.95, 0.99, 1.0]


@pytest.mark.parametrize("kind", ["uniform", "skewed", "constant", "few", "wide", "single"])
def test_exact_quantiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(-5, 5, 3000),
        "skewed": rng.lognormal(0, 4, 3000),
        "constant": np.full(500, 2.5),
        "few": rng.integers(0, 4, 1000).astype(float),
        "wide": 10.0 ** rng.uniform(-30, 30, 800),
        "single": np.array([7.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    got = exact_quantiles(df.withColumnRenamed("v", "x"), "x", PS, collected=20, accuracy=50)
    assert got == pytest.approx(list(np.quantile(values, PS)), rel=1e-12)


def test_exact_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    assert exact_quantiles(empty, "x", [0.5]) == [None]


@pytest.mark.parametrize("collected", [3, 10_000])
def test_quantiles_with_wide_and_odd_values(spark, collected):
    rng = random.Random(8)
    finite = [rng.choice([1.0, -1.0]) * 10.0 ** rng.randrange(-300, 300) for _ in range(600)] + [5.0] * 400
    odd = [math.inf] * 40 + [-math.inf] * 30 + [math.nan] * 20
    df = spark.createDataFrame([(v,) for v in finite + odd], "x double").repartition(3)
    order = [-math.inf] * 30 + sorted(finite) + [math.inf] * 40 + [math.nan] * 20
    ps = [k / (len(order) - 1) for k in (0, 29, 30, 200, 555, 1029, 1030, 1069, 1070, len(order) - 1)]
    got = exact_quantiles(df, "x", ps, collected=collected, accuracy=100)
    for p, value in zip(ps, got):
        want = order[round(p * (len(order) - 1))]
        assert value == pytest.approx(want, rel=1e-6) or (math.isnan(want) and math.isnan(value))


def test_latency_summary(spark):
    rng = random.Random(5)
    values = [rng.expovariate(0.02) if i % 97 else None for i in range(2000)]
    log = spark.createDataFrame([(v,) for v in values], "response_time_ms double")
    filled = [9999.0 if v is None else v for v in values]
    for settings in ({}, {"collected": 50, "accuracy": 100}):
        got = O.latency_summary(log, **settings).first()
        assert got.max_latency_ms == 9999.0
        assert got.avg_latency_ms == pytest.approx(np.mean(filled))
        for name, p in (("median", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert got[f"{name}_latency_ms"] == pytest.approx(np.quantile(filled, p))
    with_odd = log.union(spark.createDataFrame([(math.nan,), (math.inf,)], log.schema))
    assert math.isnan(O.latency_summary(with_odd).first().avg_latency_ms)


def test_exact_sample(make_tx):
    df = make_tx([{"isFraud": int(i % 5 == 0)} for i in range(500)])
    ids = {r.tx_id for r in P.exact_sample(df, 77).collect()}
    assert len(ids) == 77
    assert ids == {r.tx_id for r in P.exact_sample(df.repartition(7), 77).collect()}
    by_hash = df.withColumn("h", P.row_hash()).orderBy("h").limit(77)
    assert ids == {r.tx_id for r in by_hash.collect()}
    assert P.exact_sample(df, 10_000).count() == 500
    both = P.balanced_sample(df, fraud_rows=20, normal_rows=50)
    assert {r.isFraud: r["count"] for r in both.groupBy("isFraud").count().collect()} == {1: 20, 0: 50}


def test_split_is_whole_and_stable(make_tx):
    df = make_tx([{}] * 1000)
    train, test = P.train_test_split(df)
    assert train.count() + test.count() == 1000
    assert 740 < train.count() < 860
    again = P.train_test_split(df.repartition(9))[0]
    assert train.select("tx_id").exceptAll(again.select("tx_id")).count() == 0
    assert P.sample_fraction(df, 1.0).count() == 1000
    assert P.sample_fraction(df, 0.5, id_col=None).count() < 1000


def test_cache_expiry_and_fallback(spark):
    events = spark.sql(
        """SELECT * FROM VALUES
        (1L, TIMESTAMP_NTZ '2024-01-01 10:00:00', 'PAYMENT', 5D, 'C1'),
        (2L, TIMESTAMP_NTZ '2024-01-01 10:10:00', 'TRANSFER', 9D, 'C1'),
        (3L, TIMESTAMP_NTZ '2024-01-01 09:00:00', 'DEBIT', 7D, 'C2')
        AS t(tx_id, ts, type, amount, nameOrig)"""
    )
    cache = C.latest_features(events, "nameOrig")
    assert rows_by(cache, "cache_key")["account:C1"].amount == 9.0
    requests = spark.sql(
        """SELECT id AS tx_id, concat('account:C', id) AS cache_key, 1D AS amount, 'X' AS type,
        TIMESTAMP_NTZ '2024-01-01 10:30:00' AS request_ts FROM range(1, 4)"""
    )
    got = rows_by(C.cache_lookup(requests, cache, hot_rows=0))
    assert [(got[i].cache_hit, got[i].amount) for i in (1, 2, 3)] == [
        (True, 9.0), (False, 1.0), (False, 1.0),
    ]
    early = requests.withColumn("request_ts", F.expr("TIMESTAMP_NTZ '2024-01-01 10:05:00'"))
    assert not rows_by(C.cache_lookup(early, cache))[1].cache_hit  # cached only later
    stats = C.cache_hit_stats(C.cache_lookup(requests, cache)).first()
    assert (stats.hits, stats.misses) == (1, 2)
    assert C.cache_invalidate(cache, "account:C?").count() == 0
    assert C.cache_invalidate(cache, "account:[^C]*").count() == 2
    assert C.cache_invalidate(cache, "*").count() == 0


def test_glob():
    import re

    for pattern, yes, no in (
        ("a.b*[1-3]?", "a.bxx2z", "aXb2z"), (r"a\*b", "a*b", "axb"), ("a[b", "a[b", "ab"), ("k[^0-9]", "kx", "k5"),
        ("x\n*", "x\ny\nz", "xy"), ("*", "", None),
    ):
        assert re.search(C.glob_to_regex(pattern), yes), pattern
        assert no is None or not re.search(C.glob_to_regex(pattern), no), pattern


def test_validation_counts_bad_rows(make_tx):
    bad = make_tx(
        [
            {"type": "CASH_IN", "amount": -100.0},
            {"type": "CASH_OUT", "amount": 5.0, "oldbalanceOrg": 10.0, "newbalanceOrig": 5.0},
            {"type": "CASH_OUT", "amount": 5.0, "oldbalanceOrg": 10.0, "newbalanceOrig": 6.0},
            {"nameDest": None},
        ]
    )
    got = {r.issue: r.row_count for r in Q.validate_transactions(bad).collect()}
    assert got == {"negative_amount": 1, "cash_out_mismatch": 1, "null:nameDest": 1}
    assert Q.check_balance(bad).first().actual_value == 50.0
    assert Q.check_balance(bad, tolerance=2.0).first().status == "PASS"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "NaN"), (float("nan"), None)], "x double, s string")
    got = {r.column_name: r.null_count for r in Q.null_counts(df).collect()}
    assert got == {"x": 1, "s": 1}


def test_empty_table_checks(make_tx):
    empty = make_tx([{}]).limit(0)
    assert Q.check_nulls(empty).first().actual_value == 0.0
    assert Q.duplicate_count(empty).first().duplicate_pct == 0.0
    assert {r.status for r in Q.check_outliers(empty).collect()} == {"WARNING"}
    assert A.fraud_kpis(empty).first().fraud_rate_pct == 0.0
    assert H.fp_metrics(H.score_with_history(empty)).first().reduction_percentage == 0.0


def test_outlier_warnings(make_tx):
    df = make_tx([{"amount": 1.0 if i else 1000.0, "step": 3} for i in range(50)])
    got = rows_by(Q.check_outliers(df, ["amount", "step", "type"]), "check_name")
    assert got["Outlier Check (amount)"].actual_value == 2.0
    assert got["Outlier Check (amount)"].status == "PASS"
    assert got["Outlier Check (step)"].status == "WARNING"
    assert got["Outlier Check (type)"].expected_value == 0.0


def test_profile_counts_null_as_value(make_tx):
    got = rows_by(Q.column_profile(make_tx([{"type": None}, {}, {}])), "column_name")
    assert got["type"].unique_count == 2
    assert got["type"].null_percentage == pytest.approx(100 / 3)
    assert got["amount"].std_value == 0.0


def test_selection(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        a = rng.random() * 10
        rows.append((a, a * 2, 1.0, rng.random() * 10, int(a > 5)))
    df = spark.createDataFrame(rows, "a double, twice double, flat double, noise double, isFraud int")
    names = ["a", "twice", "flat", "noise"]
    got = rows_by(E.select_features(df, names, top_n=1), "feature")
    assert {n: r.status for n, r in got.items()} == {
        "a": "selected", "twice": "correlated", "flat": "low_variance", "noise": "below_top_n",
    }
    assert E.apply_selection(df, E.select_features(df, names)).columns == ["a", "noise", "isFraud"]
    pairs = {(r.feature1, r.feature2): r.correlation for r in E.correlation_matrix(df, names).collect()}
    assert pairs["a", "twice"] == pytest.approx(1.0) and pairs["a", "flat"] is None


def test_many_correlations(spark):
    """Any number of columns, with nulls, NaN and constants, against numpy."""
    rng = random.Random(2)
    names = list("abcdefghijklm")
    rows = [[rng.random() * 1e6 + 1e9 for _ in names[:-1]] + [1.0] for _ in range(200)]
    holes = [[None if (i + j) % 9 == 0 else v for j, v in enumerate(r)] for i, r in enumerate(rows)]
    odd = [[math.nan if v is None else v for v in r] for r in holes]
    for data in (rows, holes, odd):
        df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names))
        got = {(r[0], r[1]): r[2] for r in E.correlation_matrix(df, names).collect()}
        assert len(got) == 78
        table = np.array([[math.nan if v is None else v for v in r] for r in data])
        for (a, b), value in got.items():
            x, y = table[:, names.index(a)], table[:, names.index(b)]
            both = ~np.isnan(x) & ~np.isnan(y)
            if "m" in (a, b):
                assert value is None
            else:
                assert value == pytest.approx(np.corrcoef(x[both], y[both])[0, 1], abs=1e-6)
    label = df.withColumn("isFraud", F.lit(1))
    assert {r.importance for r in E.feature_importance(label, names).collect()} == {0.0}


def test_drift(spark, tmp_path, make_tx):
    before = make_tx([{"amount": float(i)} for i in range(10, 20)])
    after = before.withColumn("amount", F.col("amount") * 1.5)
    path = str(tmp_path / "baseline")
    assert D.monitor_drift(before, ["amount", "step"], path) is None
    alerts = D.monitor_drift(after, ["amount", "step"], path)
    got = {r.alert_type: r.severity for r in alerts.collect()}
    assert got == {"MEAN_DRIFT": "HIGH", "STD_DRIFT": "HIGH", "DISTRIBUTION_DRIFT": "HIGH"}
    assert D.monitor_drift(before, ["amount", "step"], path).count() == 0
    D.save_alerts(alerts, str(tmp_path / "alerts"))
    assert spark.read.json(str(tmp_path / "alerts")).count() == 3
    assert "STD_DRIFT" in D.report(alerts)


def test_top_alerts_and_timeline(make_tx):
    tx = make_tx([{"step": s, "type": "TRANSFER", "amount": 2e5, "newbalanceOrig": 0.0} for s in (3, 1, 2)])
    scored = H.score_with_history(tx)
    assert [r.tx_id for r in H.top_alerts(scored, limit=2).collect()] == [0, 1]
    assert [r.step for r in A.step_timeline(tx, last=2).collect()] == [2, 3]
    assert A.search_transactions(tx, "TRANS", regex=False).count() == 3


@pytest.mark.parametrize("range_rows", [500_000, 700])
def test_fp_rate_walk(make_tx, range_rows):
    """Against a plain loop over the rows; many steps, several ranges."""
    rng = random.Random(6)
    rows = [{"step": 1, "type": "TRANSFER", "amount": 150000.0, "nameOrig": f"A{i}"} for i in range(150)]
    rows += [{"step": 2 + i % 2500, "amount": 1.0, "nameOrig": f"B{i}"} for i in range(2500)]
    rows += [
        {"step": 2000 + i, "type": "TRANSFER", "amount": 150000.0, "nameOrig": f"D{i}"}
        for i in range(2000) if rng.random() < 0.4
    ]
    scored = H.score_with_history(make_tx(rows))
    got = {r.tx_id: r for r in H.fp_rate_running(scored, range_rows=range_rows).collect()}
    n = fp = 0
    threshold, seen = 0.5, set()
    for r in sorted(scored.select("tx_id", "step", "is_fraud", "isFraud").collect(), key=lambda r: (r.step, r.tx_id)):
        n, fp = n + 1, fp + (r.is_fraud and r.isFraud == 0)
        if n >= 100 and fp / n > 0.105 * 1.2:
            threshold = min(0.8, threshold + 0.05)
        elif n >= 100 and fp / n < 0.105 * 0.8:
            threshold = max(0.3, threshold - 0.05)
        row = got[r.tx_id]
        assert (row.predictions_made, row.false_positives) == (n, fp)
        assert row.threshold == pytest.approx(threshold)
        seen.add(round(threshold, 2))
    assert len(got) == len(rows) and len(seen) > 3


@pytest.mark.parametrize("seed", range(20))
def test_composed_moves(seed):
    """Composed clamped shifts, cut anywhere, against one move after another."""
    rng = random.Random(seed)
    moves = [rng.choice([-1, -1, 0, 1] if seed % 2 else [-1, 0, 1, 1]) for _ in range(rng.randrange(1, 200))]
    at = first = rng.randrange(H.LEAST_STEPS, H.MOST_STEPS + 1)
    wanted = []
    for move in moves:
        at = min(H.MOST_STEPS, max(H.LEAST_STEPS, at + move))
        wanted.append(at)
    assert H._applied(*H._clamped(np.array(moves)), first).tolist() == wanted
    cut = rng.randrange(len(moves))
    parts = [H._clamped(np.array(part)) for part in (moves[:cut], moves[cut:]) if part]
    ends = H._composed(*(np.array([part[k][-1] for part in parts]) for k in range(3)))
    assert H._applied(*ends, first).tolist()[-1] == wanted[-1]


def test_fp_rate_of_no_rows(make_tx):
    assert H.fp_rate_running(H.score_with_history(make_tx([{}]).where("false"))).count() == 0


def test_stored_sketches_take_new_parts(spark, tmp_path):
    """Two columns, one with more values than a sketch has slots; parts share values, and one is run again."""
    path, exact = str(tmp_path / "sketches"), 90_000
    rows = spark.range(150_000).select(
        F.when(F.col("id") % 10 > 0, F.col("id") % 100_000).alias("many"), (F.col("id") % 7).alias("few"), "id"
    )
    part = F.floor(F.col("id") / 30_000)
    days = [rows.filter(part == k) for k in range(5)]
    S.add_parts(S.distinct_sketches(rows.filter(part < 4), ["many", "few"], part), path)
    before = rows_by(S.united_counts(S.stored_sketches(spark, path)), "column")
    assert (before["few"].parts, before["few"].rows, before["few"].distinct) == (4, 120_000, 7)
    for _ in range(2):
        S.add_parts(S.distinct_sketches(days[4], ["many", "few"], part), path)
    got = rows_by(S.united_counts(S.stored_sketches(spark, path)), "column")
    both = rows_by(S.united_counts(S.distinct_sketches(rows, ["many", "few"], part)), "column")
    assert got == both
    assert (got["many"].parts, got["many"].rows, got["many"].nulls) == (5, 150_000, 15_000)
    assert abs(got["many"].distinct - exact) <= S.relative_error() * exact
    last = S.united_counts(S.stored_sketches(spark, path).filter("part >= 3 AND column = 'many'")).first()
    assert abs(last.distinct - 54_000) <= S.relative_error() * 54_000
    assert S.united_counts(S.distinct_sketches(rows.where("false"), ["few"], part)).count() == 0


def test_partition_report(make_tx):
    tx = make_tx([{}] * 100)
    even = L.partition_report(L.by_type(tx, salts=4)).first()
    assert even.max_rows <= 100
    one = L.partition_report(tx.repartition(4, F.lit(1)), 4).first()
    assert (one.min_rows, one.max_rows, one.skew_ratio, one.skewed) == (0, 100, 4.0, True)


def test_minute_volume_fills_gaps(spark):
    events = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-01 10:00:59'), "
        "(TIMESTAMP_NTZ '2024-01-01 10:03:00') AS t(ts)"
    )
    assert [r.volume for r in O.minute_volume(events).orderBy("minute").collect()] == [1, 0, 0, 1]
