"""Sender history and the false-positive reduction built on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.functions import scoring as S
from ledgersift.operators.analytics import search_transactions
from ledgersift.operators.skew import HOT_ROWS, left_join_lookup, salted_join, split_hot
from ledgersift.operators.windows import _with_surrogates, merge_cells, step_cells
from ledgersift.session import work_path

BASELINE_FP_RATE = 0.15
TARGET_FP_RATE = 0.105

_PROFILE = ("transaction_count", "fraud_count", "avg_amount", "std_amount")


def _counted_history(tx: DataFrame) -> DataFrame:
    return tx.groupBy("nameOrig").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("step").alias("last_transaction"),
        F.count("amount").alias("transaction_count"),
        F.avg("amount").alias("avg_amount"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("std_amount"),
        F.sum("isFraud").alias("fraud_count"),
    )


def customer_history(tx: DataFrame) -> DataFrame:
    """One row per sender: activity, amount statistics, frauds."""
    return _counted_history(tx).drop("_rows")


def _profile(n: Column, fraud: Column, mean: Column, std: Column) -> Column:
    """All that scoring needs to know about a sender."""
    return F.struct(
        n.alias("transaction_count"),
        fraud.alias("fraud_count"),
        mean.alias("avg_amount"),
        std.alias("std_amount"),
        S.trust_factors(n, fraud).alias("trust"),
        S.is_trusted(n, fraud).alias("trusted"),
        S.dynamic_threshold(n, fraud).alias("dynamic_threshold"),
        S.trust_score(n, fraud).alias("customer_trust_score"),
    )


def _unknown_sender() -> Column:
    none, zero = F.lit(0).cast("bigint"), F.lit(0.0)
    return _profile(none, none, zero, zero)


def with_history(tx: DataFrame, history: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach each sender's history as ``profile``; senders without one get zeros."""
    profile = _profile(*[F.col(c) for c in _PROFILE]).alias("profile")
    hot, cold = None, history
    if "_rows" in history.columns:
        # The history was counted over these very rows, so it knows the hot senders.
        # Both sides test the same count, so one aggregation serves them.
        hot = history.filter(F.col("_rows") > hot_rows).select("nameOrig", profile)
        cold = history.filter(F.col("_rows") <= hot_rows)
    lookup = cold.select("nameOrig", profile)
    joined = left_join_lookup(
        tx, lookup, "nameOrig", "tx_id", hot_lookup=hot, hot_rows=hot_rows
    )
    # Exploding one element keeps the optimizer from copying this expression into
    # every later use and pushed filter, which would outgrow the JIT's method limit.
    known = F.explode(F.array(F.coalesce("profile", _unknown_sender())))
    return joined.select(*tx.columns, known.alias("profile"))


def with_past_history(tx: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach the history each sender had before the current step."""
    ordinary, hot = split_hot(tx, "nameOrig", hot_rows)
    past = Window.partitionBy("nameOrig").orderBy("step").rangeBetween(
        Window.unboundedPreceding, -1
    )
    result = ordinary.withColumns(
        {
            "transaction_count": F.count("amount").over(past),
            "fraud_count": F.sum("isFraud").over(past),
            "avg_amount": F.avg("amount").over(past),
            "std_amount": F.stddev_samp("amount").over(past),
        }
    )
    if hot is not None:
        keyed = _with_surrogates(hot, "nameOrig")
        merged = merge_cells(step_cells(keyed, "_key"), ["_key"], last=-1).select(
            "_key",
            "_step",
            F.col("_count").alias("transaction_count"),
            F.col("_fraud").alias("fraud_count"),
            F.col("_avg").alias("avg_amount"),
            F.col("_std").alias("std_amount"),
        )
        joined = salted_join(keyed, merged, ["_key", "_step"], spread_by="tx_id")
        result = result.unionByName(joined.select(*result.columns))
    zero = {"transaction_count": 0, "fraud_count": 0, "avg_amount": 0.0, "std_amount": 0.0}
    known = result.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in zero.items()})
    return known.withColumn("profile", _profile(*[F.col(c) for c in _PROFILE])).drop(*_PROFILE)


def indicator_scores(tx: DataFrame) -> DataFrame:
    """Base rule score of every transaction."""
    hits = tx.withColumn("fraud_indicators", S.indicator_count())
    scored = hits.withColumn(
        "fraud_probability", S.indicator_probability(F.col("fraud_indicators"))
    )
    p = F.col("fraud_probability")
    return scored.withColumns({"is_fraud": p > 0.5, "risk_level": S.indicator_level(p)})


def reduce_false_positives(profiled: DataFrame) -> DataFrame:
    """Adjusted score, threshold, decision and flags from the sender's ``profile``."""
    base = profiled.withColumn("base_probability", S.indicator_probability(S.indicator_count()))
    amount, known = F.col("amount"), F.col("profile")
    mean, std = known["avg_amount"], known["std_amount"]
    adjusted = S.adjust_probability(F.col("base_probability"), amount, known["trust"], mean, std)
    scored = base.withColumn("fraud_probability", adjusted)
    p = F.col("fraud_probability")
    return scored.select(
        *[c for c in scored.columns if c != "profile"],
        *[known[c].alias(c) for c in _PROFILE],
        known["dynamic_threshold"].alias("dynamic_threshold"),
        known["customer_trust_score"].alias("customer_trust_score"),
        (p > known["dynamic_threshold"]).alias("is_fraud"),
        S.likely_false_positive(p, amount, known["trusted"], mean, std).alias(
            "is_false_positive"
        ),
        S.history_risk_level(p).alias("risk_level"),
    )


def score_with_history(
    tx: DataFrame,
    history: DataFrame | None = None,
    as_of: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Score transactions with their sender's history (all of it, or the past only)."""
    if as_of:
        return reduce_false_positives(with_past_history(tx, hot_rows))
    known = _counted_history(tx) if history is None else history
    return reduce_false_positives(with_history(tx, known, hot_rows))


def fp_metrics(scored: DataFrame, baseline: float = BASELINE_FP_RATE) -> DataFrame:
    """Confusion counts of the reduced decision and its gain over the baseline rate."""
    hit, fraud = F.col("is_fraud"), F.col("isFraud") == 1
    counts = scored.agg(
        F.count(F.lit(1)).alias("predictions_made"),
        F.count_if(hit & ~fraud).alias("false_positives"),
        F.count_if(hit & fraud).alias("true_positives"),
        F.count_if(~hit & ~fraud).alias("true_negatives"),
        F.count_if(~hit & fraud).alias("false_negatives"),
    )
    total = F.col("predictions_made")
    rate = F.when(total > 0, F.col("false_positives") / total).otherwise(0.0)
    gain = F.when(total > 0, (F.lit(baseline) - F.col("current_fp_rate")) / baseline * 100)
    return counts.withColumn("current_fp_rate", rate).withColumn(
        "reduction_percentage", gain.otherwise(0.0)
    )


def customer_stats(tx: DataFrame, customer: str) -> DataFrame:
    """History of one sender as one row; zeros when the sender is unknown."""
    mine = tx.filter(F.col("nameOrig") == customer)
    return mine.agg(
        F.lit(customer).alias("nameOrig"),
        F.count("amount").alias("transaction_count"),
        F.coalesce(F.sum("isFraud"), F.lit(0)).alias("fraud_count"),
        F.coalesce(F.avg("amount"), F.lit(0.0)).alias("avg_amount"),
    )


def search_scored(tx: DataFrame, term: str = "", limit: int = 20) -> DataFrame:
    """Search hits with their reduced score; only the hits' senders are aggregated."""
    found = search_transactions(tx, term, limit)
    # At most ``limit`` names.
    names = F.broadcast(found.select("nameOrig").distinct())
    history = customer_history(tx.join(names, "nameOrig", "left_semi"))
    return score_with_history(found, history)


def top_alerts(scored: DataFrame, limit: int = 10, minimum: float = 0.7) -> DataFrame:
    """The highest-scored frauds."""
    alerts = scored.filter(F.col("is_fraud") & (F.col("fraud_probability") > minimum))
    return alerts.orderBy(F.desc("fraud_probability"), "tx_id").limit(limit)


# The threshold moves in whole steps of this width, between these numbers of steps.
THRESHOLD_STEP, LEAST_STEPS, MOST_STEPS = 0.05, 6, 16
# Rows of one ordered range; a range is walked by one task.
RANGE_ROWS = 500_000


def _moves(false_hits: np.ndarray, made: int, false: int, target: float, warm_up: int) -> tuple:
    """Counts after each row, and whether the threshold then goes up (1), down (-1) or stays."""
    n = made + np.arange(1, len(false_hits) + 1, dtype=np.int64)
    fp = false + np.cumsum(false_hits, dtype=np.int64)
    rate = fp / n
    move = np.where(rate > target * 1.2, 1, np.where(rate < target * 0.8, -1, 0))
    return n, fp, rate, np.where(n < warm_up, 0, move)


def _then(low, high, shift, low2, high2, shift2) -> tuple:
    """The clamped shift equal to one clamped shift after another (x -> min(high, max(low, x + shift)))."""
    hold = lambda x: np.minimum(high2, np.maximum(low2, x + shift2))
    return hold(low), hold(high), shift + shift2


def _composed(low: np.ndarray, high: np.ndarray, shift: np.ndarray) -> tuple:
    """All shifts up to each place as one clamped shift, in about log2(n) doublings of the reach."""
    reach = 1
    while reach < len(shift):
        earlier = [x[:-reach] for x in (low, high, shift)]
        joined = _then(*earlier, *[x[reach:] for x in (low, high, shift)])
        low, high, shift = (np.concatenate([x[:reach], y]) for x, y in zip((low, high, shift), joined))
        reach *= 2
    return low, high, shift


def _clamped(moves: np.ndarray) -> tuple:
    """Clamped shift of all moves up to each place, held between the least and most steps."""
    limits = (np.full(len(moves), edge, dtype=np.int64) for edge in (LEAST_STEPS, MOST_STEPS))
    return _composed(*limits, moves.astype(np.int64))


def _applied(low, high, shift, at):
    return np.minimum(high, np.maximum(low, at + shift))


def fp_rate_running(
    scored: DataFrame, target: float = TARGET_FP_RATE, start: float = 0.5, warm_up: int = 100,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """False-positive rate after each prediction and the threshold that follows it.

    The threshold moves by 0.05 after every row in (step, tx_id) order: up to 0.8 while
    the rate is over 1.2 times the target, down to 0.3 while it is under 0.8 times.

    One move is a clamped shift, and clamped shifts compose to clamped shifts, so the walk
    is an associative scan of (low, high, shift). The rows are written once in ordered
    ranges. One row per range comes back with its counts, which give every range what was
    before it; a second one with the composition of its moves, which gives every range its
    own beginning. Both go back as a table joined on the range, so ranges are scanned
    independently, whatever the number of rows.
    """
    spark = scored.sparkSession
    false_hit = F.coalesce(F.col("is_fraud") & (F.col("isFraud") == 0), F.lit(False)).cast("int")
    rows = scored.select("step", "tx_id", false_hit.alias("_fp"))
    ranges = max(1, -(-rows.count() // range_rows))
    path = work_path(spark, "ranges")
    ordered = rows.repartitionByRange(ranges, "step", "tx_id")
    ordered.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.schema("step int, tx_id bigint, _fp int, _range int").parquet(path)

    counts = stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.sum("_fp").alias("fp"))
    known = sorted(counts.collect(), key=lambda r: r["_range"])
    if not known:
        known = [{"_range": 0, "n": 0, "fp": 0}]
    numbers = [r["_range"] for r in known]
    made, false = (np.cumsum([0] + [r[c] for r in known[:-1]]).tolist() for c in ("n", "fp"))

    def by_range(begins: list[int]):
        """Rows of a range beside the counts and the threshold it begins with."""
        kind = "_range int, _made bigint, _false bigint, _at bigint"
        starts = spark.createDataFrame(list(zip(numbers, made, false, begins)), kind)
        return stored.join(starts, "_range").groupBy("_range")

    def moves_of(group: pd.DataFrame) -> tuple:
        group = group.sort_values(["step", "tx_id"], kind="stable")
        first = (int(group[c].iloc[0]) for c in ("_made", "_false"))
        return group, _moves(group["_fp"].to_numpy(), *first, target, warm_up)

    def whole(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        low, high, shift = _clamped(moves_of(group)[1][3])
        return pd.DataFrame({"_range": [key[0]], "low": low[-1:], "high": high[-1:], "shift": shift[-1:]})

    first = round(start / THRESHOLD_STEP)
    begins = [first] * len(numbers)
    if len(numbers) > 1:
        kind = "_range int, low bigint, high bigint, shift bigint"
        found = by_range(begins).applyInPandas(whole, kind).toPandas().sort_values("_range")
        ends = _composed(*(found[c].to_numpy() for c in ("low", "high", "shift")))
        begins = [first, *_applied(*ends, first).tolist()[:-1]]

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        group, (n, fp, rate, moves) = moves_of(group)
        steps = _applied(*_clamped(moves), int(group["_at"].iloc[0]))
        counted = {"predictions_made": n, "false_positives": fp, "fp_rate": rate}
        return group[["step", "tx_id"]].assign(**counted, threshold=steps * THRESHOLD_STEP)

    kind = "step int, tx_id bigint, predictions_made bigint, false_positives bigint, fp_rate double, threshold double"
    return by_range(begins).applyInPandas(walk, kind)
