"""Preparation stages that are saved with the model, and the labelled split."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.functions.features import MODEL_COLUMNS_8
from ledgersift.operators.sampling import train_test_split

_DERIVED = {
    "amount_ratio": "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0D END",
    "is_large_amount": "CASE WHEN amount > 100000 THEN 1 ELSE 0 END",
    "balance_change_orig": "oldbalanceOrg - newbalanceOrig",
    "balance_change_dest": "newbalanceDest - oldbalanceDest",
}

# The wider list adds the two balance changes.
ADVANCED_COLUMNS_10 = (*MODEL_COLUMNS_8, "balance_change_orig", "balance_change_dest")


def preparation(
    columns: list[str], wanted: tuple[str, ...] = MODEL_COLUMNS_8, with_type: bool = False
) -> list:
    """Stages from raw columns to a standardised ``features`` vector.

    Derived columns are added when ``columns`` lacks them; wanted columns that
    can be neither found nor derived are left out.
    """
    missing = [c for c in wanted if c not in columns and c in _DERIVED]
    inputs = [c for c in wanted if c in columns or c in missing]
    stages: list = []
    if missing:
        derived = ", ".join(f"{_DERIVED[c]} AS {c}" for c in missing)
        stages.append(SQLTransformer(statement=f"SELECT *, {derived} FROM __THIS__"))
    if with_type and "type" in columns:
        # Alphabetical order gives the same code to a type in every run.
        stages += [
            StringIndexer(
                inputCol="type", outputCol="type_index", stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            OneHotEncoder(inputCol="type_index", outputCol="type_vector"),
        ]
        inputs.append("type_vector")
    stages += [
        VectorAssembler(inputCols=inputs, outputCol="features_raw"),
        StandardScaler(
            inputCol="features_raw", outputCol="features", withMean=True, withStd=True
        ),
    ]
    return stages


def labelled(df: DataFrame, fraud_weight: float = 1.0) -> DataFrame:
    """Add ``label`` and ``weight`` from the fraud flag."""
    label = F.col("isFraud").cast("double")
    weight = F.when(F.col("isFraud") == 1, fraud_weight).otherwise(1.0)
    return df.withColumns({"label": label, "weight": weight})


def full_pipeline(
    estimator: Estimator,
    columns: list[str],
    wanted: tuple[str, ...] = MODEL_COLUMNS_8,
    with_type: bool = False,
) -> Pipeline:
    """Preparation and classifier in one, so that raw rows can be scored later."""
    return Pipeline(stages=[*preparation(columns, wanted, with_type), estimator])


def split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Labelled train and test rows, split by id before anything is fitted."""
    return train_test_split(labelled(df), train, seed)
