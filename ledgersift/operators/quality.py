"""Data profiling and quality checks: single-pass aggregates, then small reshapes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersift.functions.features import numeric_columns
from ledgersift.operators.analytics import ratio, rows
from ledgersift.schema import CRITICAL_COLUMNS


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN where the type has one."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def unpivot_one_row(wide: DataFrame, names: list[str], measures: dict[str, str]) -> DataFrame:
    """Turn one row of ``<measure>_<name>`` columns into one row per name.

    ``measures`` maps each measure prefix to its output type.
    """
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(name).alias("column_name"),
            *[F.col(f"{m}_{name}").cast(t).alias(m) for m, t in measures.items()],
        )
        for position, name in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def null_counts(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(f"null_count_{c}") for c in df.columns])
    return unpivot_one_row(wide, df.columns, {"null_count": "bigint"}).drop("position")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Total, distinct and surplus rows. Copies combine before the shuffle."""
    copies = df.groupBy(*df.columns).agg(rows().alias("_n"))
    counted = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"), rows().alias("distinct_rows")
    )
    surplus = F.col("total_rows") - F.col("distinct_rows")
    return counted.withColumn("duplicate_count", surplus).withColumn(
        "duplicate_pct", ratio(F.col("duplicate_count"), F.col("total_rows"), 100.0)
    )


def _typed_value(df: DataFrame, column: str) -> list[Column]:
    """The value as whole number, double or text, whichever holds its type exactly."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType):
        slot, target = "whole", "bigint"
    elif isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        slot, target = "real", "double"
    else:
        slot, target = "text", "string"
    slots = {"whole": "bigint", "real": "double", "text": "string"}
    return [
        (F.col(column).cast(target) if name == slot else F.lit(None).cast(t)).alias(name)
        for name, t in slots.items()
    ]


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct values per column, null counting as one value.

    Rows become (column, value) pairs; equal pairs combine before the shuffle,
    so a value that fills a column costs one row per task.
    """
    entries = [
        F.struct(F.lit(i).alias("i"), *_typed_value(df, c)) for i, c in enumerate(df.columns)
    ]
    pairs = df.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
    counted = pairs.distinct().groupBy("i").agg(rows().alias("unique_count"))
    names = F.array(*[F.lit(c) for c in df.columns])
    return counted.select(names[F.col("i")].alias("column_name"), "unique_count")


def column_profile(df: DataFrame) -> DataFrame:
    """Type, nulls, distinct values and numeric statistics of every column."""
    numeric = set(numeric_columns(df))
    stats = []
    for c in df.columns:
        value = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        stats += [
            F.count_if(F.col(c).isNull()).alias(f"null_count_{c}"),
            F.min(value).alias(f"min_value_{c}"),
            F.max(value).alias(f"max_value_{c}"),
            F.avg(value).alias(f"mean_value_{c}"),
            F.stddev_samp(value).alias(f"std_value_{c}"),
        ]
    wide = df.agg(rows().alias("_total"), *stats)
    measures = {"null_count": "bigint"} | dict.fromkeys(
        ("min_value", "max_value", "mean_value", "std_value"), "double"
    )
    with_total = wide.withColumns({f"total_{c}": F.col("_total") for c in df.columns})
    profile = unpivot_one_row(with_total, df.columns, {"total": "bigint", **measures})
    kinds = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())]
    )
    joined = profile.join(distinct_counts(df), "column_name")
    return joined.select(
        "column_name",
        kinds[F.col("column_name")].alias("data_type"),
        "null_count",
        ratio(F.col("null_count"), F.col("total"), 100.0).alias("null_percentage"),
        "unique_count",
        *list(measures)[1:],
    )


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """count, mean, stddev, min, max per column, one row per column."""
    chosen = columns or numeric_columns(df)
    makers = {
        "count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max,
    }
    wide = df.agg(*[f(c).alias(f"{m}_{c}") for c in chosen for m, f in makers.items()])
    kinds = {m: "bigint" if m == "count" else "double" for m in makers}
    return unpivot_one_row(wide, chosen, kinds).drop("position")


@dataclass
class Check:
    """Aggregates of one check, and its percentage as an expression over them."""

    name: str
    counts: dict[str, Column]
    percentage: Column
    limit: float = 0.0
    failure: str = "FAIL"


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks in one aggregate, one result row per check.

    A check whose percentage is null could not be made: it warns and expects 0.
    """
    counts = [c.alias(name) for check in checks for name, c in check.counts.items()]
    wide = df.agg(rows().alias("_rows"), *counts)
    entries = []
    for check in checks:
        pct = check.percentage
        status = F.when(pct <= check.limit, "PASS").when(pct.isNull(), "WARNING")
        entries.append(
            F.struct(
                F.lit(check.name).alias("check_name"),
                status.otherwise(check.failure).alias("status"),
                F.when(pct.isNull(), 0.0).otherwise(check.limit).alias("expected_value"),
                F.coalesce(pct, F.lit(0.0)).alias("actual_value"),
            )
        )
    return wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def _null_check(df: DataFrame, max_pct: float = 5.0) -> Check:
    nulls = reduce(Column.__add__, [F.col(c).isNull().cast("int") for c in df.columns])
    return Check(
        "Null Values Check",
        {"nulls": F.sum(nulls), "cells": rows() * len(df.columns)},
        ratio(F.col("nulls"), F.col("cells"), 100.0),
        max_pct,
    )


def check_nulls(df: DataFrame, max_pct: float = 5.0) -> DataFrame:
    """Share of missing cells over all cells."""
    return run_checks(df, [_null_check(df, max_pct)])


def check_duplicates(df: DataFrame, max_pct: float = 1.0) -> DataFrame:
    """Share of surplus copies over all rows."""
    pct = F.max("duplicate_pct")
    check = Check("Duplicate Check", {"duplicates": pct}, F.col("duplicates"), max_pct)
    return run_checks(duplicate_count(df), [check])


def check_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Share of values outside [low, high]; only none at all passes."""
    outside = (F.col(column) < low) | (F.col(column) > high)
    counts = {"outside": F.count_if(outside), "n": rows()}
    pct = ratio(F.col("outside"), F.col("n"), 100.0)
    return run_checks(df, [Check(f"Range Check ({column})", counts, pct)])


def cash_out_mismatch(tolerance: float = 0.0) -> Column:
    """CASH_OUT whose sender balance is not old minus amount."""
    return (F.col("type") == "CASH_OUT") & _unbalanced_origin(tolerance)


def _unbalanced_origin(tolerance: float) -> Column:
    expected = F.col("oldbalanceOrg") - F.col("amount")
    if tolerance:
        return F.abs(F.col("newbalanceOrig") - expected) > tolerance
    return F.col("newbalanceOrig") != expected


def _balance_check(max_pct: float = 1.0, tolerance: float = 0.0) -> Check:
    counts = {
        "mismatches": F.count_if(cash_out_mismatch(tolerance)),
        "cash_outs": F.count_if(F.col("type") == "CASH_OUT"),
    }
    pct = ratio(F.col("mismatches"), F.col("cash_outs"), 100.0)
    return Check("Balance Consistency Check", counts, pct, max_pct)


def check_balance(df: DataFrame, max_pct: float = 1.0, tolerance: float = 0.0) -> DataFrame:
    """Share of CASH_OUT rows whose sender balance does not add up."""
    return run_checks(df, [_balance_check(max_pct, tolerance)])


def check_transfer_balance(df: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """TRANSFER rows where the sender or the receiver does not balance."""
    expected = F.col("oldbalanceDest") + F.col("amount")
    if tolerance:
        receiver = F.abs(F.col("newbalanceDest") - expected) > tolerance
    else:
        receiver = F.col("newbalanceDest") != expected
    transfer = F.col("type") == "TRANSFER"
    return df.agg(
        F.count_if(transfer & (_unbalanced_origin(tolerance) | receiver)).alias("inconsistent"),
        F.count_if(transfer).alias("transfers"),
    )


_MOMENTS = {"mean": F.avg, "std": F.stddev_samp}


def _outlier_checks(df: DataFrame, columns: list[str], sigmas: float) -> list[Check]:
    """Checks with their bounds; the means and deviations are computed here, as one row."""
    tested = [c for c in columns if c in numeric_columns(df)]
    moments = [f(c).alias(f"{m}_{c}") for c in tested for m, f in _MOMENTS.items()]
    stats = df.agg(rows().alias("n"), *moments).first()
    checks = []
    for c in columns:
        std = stats[f"std_{c}"] if c in tested else None
        counts, pct = {}, F.lit(None).cast("double")
        if std:
            low, high = (stats[f"mean_{c}"] + sign * sigmas * std for sign in (-1, 1))
            counts = {f"outliers_{c}": F.count_if((F.col(c) < low) | (F.col(c) > high))}
            pct = F.col(f"outliers_{c}") / F.lit(float(stats.n)) * 100.0
        checks.append(Check(f"Outlier Check ({c})", counts, pct, 5.0, failure="WARNING"))
    return checks


def check_outliers(
    df: DataFrame, columns: list[str] | None = None, sigmas: float = 3.0
) -> DataFrame:
    """Share of values beyond mean +/- ``sigmas`` deviations, all columns in two passes.

    Columns that are not numeric or do not vary are reported as WARNING.
    """
    chosen = numeric_columns(df) if columns is None else columns
    return run_checks(df, _outlier_checks(df, chosen, sigmas))


def negative_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    chosen = columns or numeric_columns(df)
    wide = df.agg(*[F.count_if(F.col(c) < 0).alias(f"negative_count_{c}") for c in chosen])
    return unpivot_one_row(wide, chosen, {"negative_count": "bigint"}).drop("position")


def run_all_checks(df: DataFrame, ids: tuple[str, ...] = ("tx_id",)) -> DataFrame:
    """Null, duplicate, balance and outlier checks, one row each.

    Outliers are sought in every numeric column but ``ids``. Three passes: means and
    deviations, all counts, and the duplicate groups.
    """
    outliers = _outlier_checks(df, numeric_columns(df, ids), 3.0)
    counted = run_checks(df, [_null_check(df), _balance_check(), *outliers])
    return counted.unionByName(check_duplicates(df))


def check_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy("status").agg(rows().alias("checks"))


def anomaly_alerts(checks: DataFrame) -> DataFrame:
    return checks.filter(F.col("status").isin("FAIL", "WARNING"))


def quality_score(df: DataFrame) -> DataFrame:
    """100 minus capped deductions for missing cells, duplicates and mismatches."""
    missing = reduce(Column.__add__, [is_missing(df, c).cast("int") for c in df.columns])
    groups = df.groupBy(*df.columns).agg(rows().alias("_n"))
    # Equal rows are equally incomplete, so every count follows from the row groups.
    totals = groups.agg(
        F.coalesce(F.sum(missing * F.col("_n")), F.lit(0)).alias("total_nulls"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(cash_out_mismatch(), F.col("_n"))), F.lit(0)).alias(
            "inconsistent"
        ),
    )
    deductions = [("total_nulls", 1000.0, 20.0), ("duplicates", 10000.0, 15.0)]
    deductions.append(("inconsistent", 10000.0, 10.0))
    score = F.lit(100.0)
    for name, unit, cap in deductions:
        score = score - F.least(F.col(name) / unit, F.lit(cap))
    q = F.col("quality_score")
    grade = F.when(q >= 90, "A").when(q >= 75, "B").when(q >= 60, "C").otherwise("D")
    return totals.withColumn("quality_score", score).withColumns(
        {"grade": grade, "passed": q >= 75}
    )


def validate_transactions(df: DataFrame) -> DataFrame:
    """One row per validation issue with its row count; zero counts are left out."""
    tests = {f"null:{c}": F.col(c).isNull() for c in CRITICAL_COLUMNS}
    tests["negative_amount"] = F.col("amount") < 0
    tests["cash_out_mismatch"] = cash_out_mismatch()
    names = list(tests)
    wide = df.agg(*[F.count_if(t).alias(f"rows_{i}") for i, t in enumerate(tests.values())])
    entries = [
        F.struct(F.lit(n).alias("issue"), F.col(f"rows_{i}").alias("row_count"))
        for i, n in enumerate(names)
    ]
    tall = wide.select(F.explode(F.array(*entries)).alias("r")).select("r.*")
    return tall.filter(F.col("row_count") > 0)


def report(checks: DataFrame) -> str:
    """Plain-text report of a check table (a handful of rows)."""
    lines = ["DATA QUALITY REPORT"]
    for row in checks.collect():
        lines.append(
            f"{row.status:8} {row.check_name}: {row.actual_value:.4f} "
            f"(expected {row.expected_value})"
        )
    return "\n".join(lines)
