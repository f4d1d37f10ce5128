"""Per-row features. Every function takes Columns and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.schema import LARGE_AMOUNT, RISKY_TYPES, TYPES


def _zero() -> Column:
    return F.lit(0.0)


def amount_ratio(variant: str = "guarded", amount="amount", balance="oldbalanceOrg") -> Column:
    """Amount over the sender's opening balance.

    ``etl``: 0 on null or zero balance, single precision; ``guarded``: 0 unless
    the balance is positive; ``floor1``: the balance counts as at least 1.
    """
    a, b = F.col(amount), F.col(balance)
    if variant == "etl":
        unusable = a.isNull() | b.isNull() | (b == 0)
        return F.when(unusable, _zero()).otherwise(a / b).cast("float")
    if variant == "guarded":
        return F.when(b > 0, a / b).otherwise(_zero())
    if variant == "floor1":
        return a / F.greatest(b, F.lit(1.0))
    raise ValueError(f"unknown amount_ratio variant: {variant}")


def is_large_amount(threshold: float = LARGE_AMOUNT) -> Column:
    return F.when(F.col("amount") > threshold, 1).otherwise(0)


def is_risky_type() -> Column:
    return F.when(F.col("type").isin(*RISKY_TYPES), 1).otherwise(0)


def risk_category() -> Column:
    risky = F.col("type").isin(*RISKY_TYPES)
    return (
        F.when(risky & (F.col("amount") > 100000.0), "HIGH")
        .when(risky & (F.col("amount") > 50000.0), "MEDIUM")
        .otherwise("LOW")
    )


def balance_change_orig() -> Column:
    """New minus old: negative when money left the sender."""
    return F.col("newbalanceOrig") - F.col("oldbalanceOrg")


def balance_outflow_orig() -> Column:
    """Old minus new: the sign the models and the stream use."""
    return F.col("oldbalanceOrg") - F.col("newbalanceOrig")


def balance_change_dest() -> Column:
    return F.col("newbalanceDest") - F.col("oldbalanceDest")


def is_zero_balance_orig() -> Column:
    return F.when(F.col("newbalanceOrig") == 0, 1).otherwise(0)


def one_hot_type() -> dict[str, Column]:
    return {f"type_{t}": F.when(F.col("type") == t, 1).otherwise(0) for t in TYPES}


def amount_risk_score() -> Column:
    a = F.col("amount")
    return (
        F.when(a > 1000000.0, 1.0)
        .when(a > 500000.0, 0.8)
        .when(a > 100000.0, 0.6)
        .when(a > 50000.0, 0.4)
        .otherwise(0.2)
    )


def balance_change_risk() -> Column:
    moved = F.abs(balance_change_orig())
    old = F.col("oldbalanceOrg")
    return F.when(moved > old * 0.5, 1.0).when(moved > old * 0.3, 0.6).otherwise(0.2)


def amount_band() -> Column:
    """Right-closed amount bands; amounts of 0 or less fall in none."""
    a = F.col("amount")
    return (
        F.when(a <= 0, F.lit(None).cast("string"))
        .when(a <= 10000.0, "LOW")
        .when(a <= 50000.0, "MEDIUM")
        .when(a > 50000.0, "HIGH")
    )


def with_etl_features(df: DataFrame) -> DataFrame:
    """All row features of the batch load, added in one projection."""
    return df.withColumns(
        {
            "amount_ratio": amount_ratio("etl"),
            "is_large_amount": is_large_amount(),
            "risk_category": risk_category(),
            "balance_change_orig": balance_change_orig(),
            "balance_change_dest": balance_change_dest(),
            **one_hot_type(),
        }
    )


def with_risk_features(df: DataFrame) -> DataFrame:
    """Risk type, amount and balance scores and their weighted sum."""
    df = df.withColumns(
        {
            "is_high_risk_type": is_risky_type(),
            "amount_risk_score": amount_risk_score(),
            "balance_change_risk": balance_change_risk(),
        }
    )
    combined = (
        F.col("is_high_risk_type") * F.lit(0.4)
        + F.col("amount_risk_score") * F.lit(0.4)
        + F.col("balance_change_risk") * F.lit(0.2)
    )
    return df.withColumn("combined_risk_score", combined)


def with_stream_features(df: DataFrame) -> DataFrame:
    """The four features the scoring stream derives per message."""
    return df.withColumns(
        {
            "amount_ratio": amount_ratio("guarded"),
            "balance_outflow_orig": balance_outflow_orig(),
            "balance_change_dest": balance_change_dest(),
            "is_large_amount": is_large_amount(),
        }
    )


# The three model column lists.
MODEL_COLUMNS_16 = (
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "step",
    "amount_ratio", "balance_change_orig", "balance_change_dest", "is_large_amount",
    "is_zero_balance_orig", "type_CASH_IN", "type_CASH_OUT", "type_DEBIT", "type_PAYMENT",
    "type_TRANSFER",
)
MODEL_COLUMNS_8 = (
    "step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest",
    "amount_ratio", "is_large_amount",
)
CACHE_COLUMNS_10 = (
    "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "type",
    "amount_ratio", "balance_change_orig", "balance_change_dest", "is_large_amount",
)


def with_defaults(df: DataFrame) -> DataFrame:
    """Replace missing inputs by the defaults of the request path."""
    wanted = {"amount": 0.0, "step": 1, "type": "UNKNOWN"}
    wanted |= dict.fromkeys(
        ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"), 0.0
    )
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in wanted.items() if c in df.columns}
    )


def model_features(df: DataFrame, columns=MODEL_COLUMNS_16, keep=("tx_id",)) -> DataFrame:
    """Project the numeric model columns, with request-path defaults for nulls.

    ``balance_change_orig`` is old minus new here, as the models expect.
    """
    ratio = "guarded" if tuple(columns) == MODEL_COLUMNS_8 else "floor1"
    derived = {
        "amount_ratio": amount_ratio(ratio),
        "balance_change_orig": balance_outflow_orig(),
        "balance_change_dest": balance_change_dest(),
        "is_large_amount": is_large_amount(),
        "is_zero_balance_orig": is_zero_balance_orig(),
        **one_hot_type(),
    }
    full = with_defaults(df)
    return full.select(
        *keep, *[derived[c].alias(c) if c in derived else F.col(c) for c in columns]
    )


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric columns, in table order."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]
