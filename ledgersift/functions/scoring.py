"""Rule scores. Pure Column expressions over transaction and history columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgersift.functions.features import amount_ratio
from ledgersift.schema import RISKY_TYPES


def fallback_score() -> Column:
    """Score used while no model is loaded."""
    a = F.col("amount")
    return F.when(a > 100000.0, 0.8).when(a > 50000.0, 0.5).otherwise(0.1)


def additive_score(noise_seed: int | None = None) -> Column:
    """Sum of rule points, clipped to [0, 1]; noise only when a seed is given."""
    a = F.col("amount")
    points = (
        F.when(a > 100000.0, 0.3).when(a > 50000.0, 0.2).otherwise(0.0)
        + F.when(F.col("type") == "TRANSFER", 0.2).otherwise(0.0)
        + F.when(amount_ratio("floor1") > 0.5, 0.2).otherwise(0.0)
    )
    if noise_seed is not None:
        points = points + (F.rand(noise_seed) - 0.5) * 0.2
    return F.least(F.greatest(points, F.lit(0.0)), F.lit(1.0))


def additive_risk_level(p: Column) -> Column:
    return F.when(p >= 0.8, "HIGH").when(p >= 0.5, "MEDIUM").otherwise("LOW")


def indicator_count() -> Column:
    """How many of the five fraud indicators a transaction shows."""
    rules = [
        F.col("type").isin(*RISKY_TYPES),
        F.col("amount") > 100000.0,
        F.col("oldbalanceOrg") == 0,
        F.col("newbalanceOrig") == 0,
        (F.col("oldbalanceDest") == 0) & (F.col("newbalanceDest") > F.col("amount") * 0.9),
    ]
    total = F.lit(0)
    for rule in rules:
        total = total + F.when(rule, 1).otherwise(0)
    return total


# Probability for 0, 1, 2, 3 and more indicators.
_BY_HITS = (0.10, 0.40, 0.70, 0.95, 0.95, 0.95)


def indicator_probability(hits: Column) -> Column:
    return F.array(*[F.lit(p) for p in _BY_HITS])[hits]


def indicator_level(p: Column) -> Column:
    return F.when(p > 0.7, "HIGH").when(p > 0.3, "MEDIUM").otherwise("LOW")


def _deviation(amount: Column, mean: Column, std: Column) -> Column:
    return F.abs(amount - mean) / F.greatest(std, F.lit(1.0))


def _fraud_share(n: Column, fraud: Column) -> Column:
    return fraud / F.greatest(n, F.lit(1))


def trust_factors(n: Column, fraud: Column) -> Column:
    """What a sender's record does to a probability, per amount class.

    Depends on the sender only, so it is computed once per sender, not per row.
    """
    clean = fraud == 0
    share = _fraud_share(n, fraud)
    very_large = F.when((n > 50) & clean, 0.9).otherwise(1.0)
    large = (
        F.when((n > 20) & clean, 0.8)
        .when((n > 10) & clean, 0.85)
        .when(share > 0.5, 1.2)
        .otherwise(1.0)
    )
    normal = (
        F.when((n > 10) & clean, 0.7)
        .when((n > 5) & (share < 0.1), 0.85)
        .when(share > 0.5, 1.3)
        .otherwise(1.0)
    )
    return F.struct(
        very_large.alias("very_large"), large.alias("large"), normal.alias("normal")
    )


def adjust_probability(
    p: Column, amount: Column, trust: Column, mean: Column, std: Column
) -> Column:
    """Scale a base probability by ``trust_factors`` and amount deviation, in [0.01, 0.99].

    The rules only choose factors, so the probability stays in one place of the
    expression however often the result is used.
    """
    z = _deviation(amount, mean, std)
    by_sender = (
        F.when(amount > 200000.0, trust["very_large"])
        .when(amount > 100000.0, trust["large"])
        .otherwise(trust["normal"])
    )
    by_amount = (
        F.when((amount > 100000.0) | (mean <= 0), 1.0)
        .when(z < 2, 0.8)
        .when(z > 3, 1.2)
        .otherwise(1.0)
    )
    return F.greatest(F.least(p * by_sender * by_amount, F.lit(0.99)), F.lit(0.01))


def dynamic_threshold(n: Column, fraud: Column) -> Column:
    clean = fraud == 0
    return (
        F.when((n > 20) & clean, 0.65)
        .when((n > 10) & clean, 0.6)
        .when(_fraud_share(n, fraud) > 0.3, 0.4)
        .otherwise(0.5)
    )


def is_trusted(n: Column, fraud: Column) -> Column:
    return (n > 10) & (fraud == 0)


def likely_false_positive(
    p: Column, amount: Column, trusted: Column, mean: Column, std: Column
) -> Column:
    small = (amount < 10000.0) & (p > 0.7)
    usual = (mean > 0) & (_deviation(amount, mean, std) < 1.5)
    return F.coalesce(small | ((trusted | usual) & (p > 0.6)), F.lit(False))


def history_risk_level(p: Column) -> Column:
    return F.when(p >= 0.7, "HIGH").when(p >= 0.3, "MEDIUM").otherwise("LOW")


def trust_score(n: Column, fraud: Column) -> Column:
    return n / F.greatest(fraud, F.lit(1))


def simple_false_positive(p: Column, amount: Column) -> Column:
    """Flag that needs no history: a small amount with a high score."""
    flagged = ((amount < 10000.0) & (p > 0.7)) | ((amount < 50000.0) & (p > 0.8))
    return F.coalesce(flagged, F.lit(False))
