"""Schemas and fixed values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Transaction types, in their documented order.
TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
RISKY_TYPES = ("TRANSFER", "CASH_OUT")

# Type -> risk score lookup.
RISK_SCORES = (
    ("CASH_IN", 0.1),
    ("CASH_OUT", 0.8),
    ("DEBIT", 0.05),
    ("PAYMENT", 0.02),
    ("TRANSFER", 0.9),
)

LARGE_AMOUNT = 100000.0

_CORE = [
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", T.DoubleType()),
    T.StructField("newbalanceOrig", T.DoubleType()),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", T.DoubleType()),
    T.StructField("newbalanceDest", T.DoubleType()),
    T.StructField("isFraud", T.IntegerType()),
]

# A batch file as published: no id column.
CSV_SCHEMA = T.StructType([*_CORE, T.StructField("isFlaggedFraud", T.IntegerType())])

# Our table form: CSV_SCHEMA plus the tie-breaking id.
TX_SCHEMA = T.StructType([T.StructField("tx_id", T.LongType()), *CSV_SCHEMA.fields])

# One JSON message on the wire.
MESSAGE_SCHEMA = T.StructType([*_CORE, T.StructField("timestamp", T.TimestampType())])

CRITICAL_COLUMNS = tuple(f.name for f in _CORE)

BALANCE_COLUMNS = ("oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")

# Numeric inputs of the statistics, drift and selection operators.
NUMERIC_FEATURES = ("step", "amount", *BALANCE_COLUMNS)
