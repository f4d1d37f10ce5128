"""Hot-account paths must equal the plain ones and brute force."""

import random
from statistics import mean, stdev

import pytest
from conftest import rows_by
from pyspark.sql import functions as F

from ledgersift.operators import history as H
from ledgersift.operators import windows as W
from ledgersift.operators.skew import hot_keys, left_join_lookup, split_hot

NEVER = 10**9


@pytest.fixture(scope="module")
def skewed(make_tx):
    """One sender with a third of the rows, ties in step, missing values."""
    rng = random.Random(7)
    rows = []
    for i in range(900):
        rows.append(
            {
                "nameOrig": "HOT" if i % 3 == 0 else None if i % 50 == 1 else f"C{rng.randrange(60)}",
                "step": rng.randrange(1, 15),
                "type": rng.choice(["TRANSFER", "PAYMENT", None]),
                "amount": None if i % 41 == 0 else round(rng.uniform(0, 5000), 2),
                "isFraud": int(rng.random() < 0.1),
            }
        )
    rng.shuffle(rows)
    return make_tx(rows).repartition(5)


def same(plain, split, columns):
    a, b = rows_by(plain), rows_by(split)
    assert a.keys() == b.keys()
    for key in a:
        for c in columns:
            want, got = a[key][c], b[key][c]
            if want is None or got is None:
                assert want == got, (key, c)
            else:
                assert got == pytest.approx(want, rel=1e-9, abs=1e-6), (key, c)


@pytest.mark.parametrize("hot_rows", [11, 40, 150])
def test_temporal_features(skewed, hot_rows):
    columns = [
        "tx_count_last_10", "amount_sum_last_10", "amount_avg_last_10", "prev_amount",
        "time_since_last_tx", "amount_change", "tx_frequency",
    ]
    same(
        W.temporal_features(skewed, hot_rows=NEVER),
        W.temporal_features(skewed, hot_rows=hot_rows),
        columns,
    )


def test_temporal_features_against_brute_force(skewed):
    rows = [r for r in skewed.collect() if r.nameOrig == "HOT"]
    rows.sort(key=lambda r: (r.step, r.tx_id))
    got = rows_by(W.temporal_features(skewed, hot_rows=30))
    for i, r in enumerate(rows):
        frame = [x.amount for x in rows[max(0, i - 10) : i + 1]]
        known = [a for a in frame if a is not None]
        assert got[r.tx_id].tx_count_last_10 == len(frame)
        if known:
            assert got[r.tx_id].amount_sum_last_10 == pytest.approx(sum(known))
        assert got[r.tx_id].prev_amount == (rows[i - 1].amount if i else None)


def test_type_account_features(skewed):
    columns = ["type_amount_avg", "type_amount_max", "type_amount_std", "amount_to_type_avg_ratio"]
    same(
        W.type_account_features(skewed, hot_rows=NEVER),
        W.type_account_features(skewed, hot_rows=30),
        columns,
    )


def test_account_features(skewed):
    plain = W.account_features(skewed, hot_rows=NEVER)
    split = W.account_features(skewed, hot_rows=30)
    assert plain.columns == split.columns
    same(plain, split, ["amount_sum_last_10", "type_amount_std", "combined_risk_score"])


def test_history_join_is_whole(skewed):
    plain = H.score_with_history(skewed, hot_rows=NEVER)
    split = H.score_with_history(skewed, hot_rows=30)
    given = H.score_with_history(skewed, H.customer_history(skewed), hot_rows=30)
    columns = ["transaction_count", "fraud_count", "avg_amount", "std_amount", "fraud_probability"]
    same(plain, split, columns)
    same(plain, given, columns)
    assert split.count() == 900


def test_past_history_against_brute_force(skewed):
    everything = skewed.collect()
    for hot_rows in (NEVER, 30):
        got = rows_by(H.with_past_history(skewed, hot_rows=hot_rows))
        for r in everything:
            before = [x for x in everything if x.nameOrig == r.nameOrig and x.step < r.step]
            amounts = [x.amount for x in before if x.amount is not None]
            known = got[r.tx_id].profile
            assert known.transaction_count == len(amounts)
            assert known.fraud_count == sum(x.isFraud for x in before)
            assert known.avg_amount == pytest.approx(mean(amounts) if amounts else 0.0)
            spread = stdev(amounts) if len(amounts) > 1 else 0.0
            assert known.std_amount == pytest.approx(spread, abs=1e-6)


def test_hot_keys_are_few(skewed):
    assert [r[0] for r in hot_keys(skewed, "nameOrig", 100).collect()] == ["HOT"]
    ordinary, hot = split_hot(skewed, "nameOrig", 100)
    assert ordinary.count() + hot.count() == 900
    assert split_hot(skewed, "nameOrig", NEVER)[1] is None


def test_lookup_misses_stay_null(spark, skewed):
    lookup = spark.createDataFrame([("C1", 5)], "nameOrig string, extra int")
    got = left_join_lookup(skewed, lookup, "nameOrig", "tx_id", hot_rows=30)
    assert got.count() == 900
    assert got.filter(F.col("extra").isNotNull()).select("nameOrig").distinct().count() == 1


def test_rows_of_hot_keys_spread(skewed):
    """After the rewrite no join key holds more than a sliver of the hot rows."""
    plan = H.score_with_history(skewed, hot_rows=30)._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64(tx_id" in plan and "Cross" not in plan
