"""Feature selection by variance, pairwise correlation and label correlation."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersift.operators.gram import pair_sums
from ledgersift.operators.quality import unpivot_one_row

VARIANCE_FLOOR = 0.01
CORRELATION_LIMIT = 0.95


def _number(column: str) -> Column:
    """The column as double; NaN counts as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def column_spread(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample variance of each column, 0 where there is none; NaN counts as missing.

    One job, one row brought back.
    """
    parts = {"mean": F.avg, "variance": F.var_samp}
    row = df.agg(*[f(_number(c)).alias(f"{m}_{c}") for c in columns for m, f in parts.items()]).first()
    return {c: (row[f"mean_{c}"] or 0.0, row[f"variance_{c}"] or 0.0) for c in columns}


def feature_variance(
    df: DataFrame, features: list[str], minimum: float = VARIANCE_FLOOR
) -> DataFrame:
    wide = df.agg(*[F.var_samp(_number(c)).alias(f"variance_{c}") for c in features])
    tall = unpivot_one_row(wide, features, {"variance": "double"})
    variance = F.coalesce(F.col("variance"), F.lit(0.0))
    return tall.select(
        F.col("column_name").alias("feature"),
        "position",
        variance.alias("variance"),
        (variance >= minimum).alias("keep"),
    )


def correlation_matrix(df: DataFrame, features: list[str]) -> DataFrame:
    """Pearson correlation of every pair (first before second), nulls dropped pairwise."""
    sums = pair_sums(df, features)
    rows = [(a, b, sums.correlation(a, b)) for a, b in combinations(features, 2)]
    return df.sparkSession.createDataFrame(
        rows, "feature1 string, feature2 string, correlation double"
    )


def correlated_features(matrix: DataFrame, limit: float = CORRELATION_LIMIT) -> DataFrame:
    return matrix.filter(F.abs("correlation") >= limit).select(
        "feature1", "feature2", F.abs("correlation").alias("correlation")
    )


def feature_importance(df: DataFrame, features: list[str], label: str = "isFraud") -> DataFrame:
    """Absolute correlation with the label; 0 where there is none."""
    sums = pair_sums(df, [*features, label])
    rows = [(c, i, abs(sums.correlation(c, label) or 0.0)) for i, c in enumerate(features)]
    return df.sparkSession.createDataFrame(rows, "feature string, position int, importance double")


def select_features(
    df: DataFrame,
    features: list[str],
    label: str = "isFraud",
    top_n: int = 50,
    min_variance: float = VARIANCE_FLOOR,
    max_correlation: float = CORRELATION_LIMIT,
) -> DataFrame:
    """Status and rank of every feature.

    Columns of low variance go first; then the second column of each strongly
    correlated pair of kept columns; the rest is ranked by label correlation,
    ties in column order. One scan gives all of it: what comes back is a few numbers
    per pair of columns.
    """
    sums = pair_sums(df, [*features, label])
    variance = {c: sums.variance(c) for c in features}
    kept = [c for c in features if variance[c] >= min_variance]
    strength = {(a, b): sums.correlation(a, b) for a, b in combinations(kept, 2)}
    dropped = {b for (_, b), r in strength.items() if r is not None and abs(r) >= max_correlation}
    importance = {c: abs(sums.correlation(c, label) or 0.0) for c in features}
    ranked = sorted((c for c in kept if c not in dropped), key=lambda c: -importance[c])
    rank = {c: i for i, c in enumerate(ranked, start=1)}

    def status(c: str) -> str:
        if c not in kept:
            return "low_variance"
        if c in dropped:
            return "correlated"
        return "selected" if rank[c] <= top_n else "below_top_n"

    rows = [(c, status(c), variance[c], importance[c], rank.get(c)) for c in features]
    return df.sparkSession.createDataFrame(
        rows, "feature string, status string, variance double, importance double, rank int"
    )


def apply_selection(df: DataFrame, result: DataFrame, label: str = "isFraud") -> DataFrame:
    """Project the selected features, best first, and the label."""
    chosen = result.filter(F.col("status") == "selected").orderBy("rank").select("feature")
    return df.select(*[row.feature for row in chosen.collect()], label)
