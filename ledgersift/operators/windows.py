"""Account windows: rolling rows, running statistics, and their skew-safe form.

Ordinary accounts use plain Spark windows. An account with more than
``hot_rows`` rows would be one sort in one task, so its rows are first numbered
with prefix counts and cut into chunks of ``hot_rows``; each chunk carries the
few rows before it, which makes the row frames exact. Running statistics of hot
accounts are merged from one cell per step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.functions.features import with_risk_features
from ledgersift.operators.skew import HOT_ROWS, salted_join, split_hot

ROLLING_BEFORE = 10
# Ids are unique, so a range this wide holds at most this many rows.
_ID_SPAN = 1 << 22
_TEMP_KEY = ["_key", "_step", "_id_range"]


def _rolling(df: DataFrame, *partition: str) -> DataFrame:
    ordered = Window.partitionBy(*partition).orderBy("step", "tx_id")
    frame = ordered.rowsBetween(-ROLLING_BEFORE, 0)
    df = df.withColumns(
        {
            "tx_count_last_10": F.count(F.lit(1)).over(frame),
            "amount_sum_last_10": F.sum("amount").over(frame),
            "amount_avg_last_10": F.avg("amount").over(frame),
            "prev_amount": F.lag("amount", 1).over(ordered),
            "time_since_last_tx": F.col("step") - F.lag("step", 1).over(ordered),
        }
    )
    gap = F.col("time_since_last_tx")
    no_previous = F.col("prev_amount").isNull()
    return df.withColumns(
        {
            "amount_change": F.when(no_previous, 0.0).otherwise(
                F.col("amount") - F.col("prev_amount")
            ),
            "tx_frequency": F.when(gap == 0, 0.0).otherwise(F.lit(1.0) / gap),
        }
    )


def _with_rank(df: DataFrame) -> DataFrame:
    """Number the rows of each account from 0 in (step, tx_id) order.

    Counts per (account, step, id range) are small; prefix sums over them give
    every cell its offset, and only rows within a cell are sorted.
    """
    df = df.withColumn("_id_range", F.floor(F.col("tx_id") / _ID_SPAN))
    cells = df.groupBy(*_TEMP_KEY).agg(F.count(F.lit(1)).alias("_n"))
    steps = cells.groupBy("_key", "_step").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_step")
    within = Window.partitionBy("_key", "_step").orderBy("_id_range")

    def prefix(window):
        upto = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(upto), F.lit(0))

    before_step = steps.select("_key", "_step", prefix(earlier).alias("_before"))
    offsets = cells.select(*_TEMP_KEY, prefix(within).alias("_within")).join(
        before_step, ["_key", "_step"]
    )
    in_cell = F.row_number().over(Window.partitionBy(*_TEMP_KEY).orderBy("tx_id"))
    return df.join(offsets, _TEMP_KEY).withColumn(
        "_rank", F.col("_before") + F.col("_within") + in_cell - 1
    )


def _with_surrogates(df: DataFrame, account: str) -> DataFrame:
    """Null-free copies of the grouping columns, so joins keep null groups."""
    return df.withColumns(
        {
            "_key": F.coalesce(F.col(account).cast("string"), F.lit("\x00")),
            "_step": F.coalesce(F.col("step"), F.lit(-(2**31))),
        }
    )


def _rolling_hot(hot: DataFrame, account: str, hot_rows: int) -> DataFrame:
    """``_rolling`` for accounts too large for one task: chunk by chunk."""
    size = max(hot_rows, ROLLING_BEFORE + 1)
    ranked = _with_rank(_with_surrogates(hot, account))
    own = F.floor(F.col("_rank") / size)
    near_end = F.col("_rank") % size >= size - ROLLING_BEFORE
    chunked = ranked.withColumn(
        "_chunk", F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    return _rolling(chunked, "_key", "_chunk").filter(F.col("_chunk") == own)


def temporal_features(
    df: DataFrame, account: str = "nameOrig", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Rolling and lag features over the 10 previous rows and the current one."""
    ordinary, hot = split_hot(df, account, hot_rows)
    result = _rolling(ordinary, account)
    if hot is None:
        return result
    return result.unionByName(_rolling_hot(hot, account, hot_rows).select(*result.columns))


def _running(df: DataFrame, *partition: str) -> DataFrame:
    # Default frame: all rows up to the current step, rows of that step included.
    w = Window.partitionBy(*partition).orderBy("step")
    return df.withColumns(
        {
            "type_amount_avg": F.avg("amount").over(w),
            "type_amount_max": F.max("amount").over(w),
            "type_amount_std": F.stddev_samp("amount").over(w),
        }
    )


def _with_ratio(df: DataFrame) -> DataFrame:
    mean = F.col("type_amount_avg")
    ratio = F.when(mean == 0, 0.0).otherwise(F.col("amount") / mean)
    return df.withColumn("amount_to_type_avg_ratio", ratio)


def step_cells(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key and step: count, mean, squared deviation, max, frauds."""
    spread = F.coalesce(F.var_pop("amount") * F.count("amount"), F.lit(0.0))
    return df.groupBy(*keys, "_step").agg(
        F.count("amount").alias("_n"),
        F.avg("amount").alias("_mean"),
        spread.alias("_m2"),
        F.max("amount").alias("_max"),
        F.sum("isFraud").alias("_fraud"),
    )


def merge_cells(cells: DataFrame, keys: list[str], last: int) -> DataFrame:
    """Merge the cells of each key from its first step on.

    ``last`` is 0 to include a cell's own step, -1 to stop before it. Means are
    shifted by the key's first mean, which keeps the sums of squares small.
    """
    ordered = Window.partitionBy(*keys).orderBy("_step")
    upto = ordered.rowsBetween(Window.unboundedPreceding, last)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shifted = cells.withColumn("_base", F.first("_mean", ignorenulls=True).over(whole))
    offset = F.coalesce(F.col("_mean") - F.col("_base"), F.lit(0.0))
    sums = shifted.select(
        *keys,
        "_step",
        "_base",
        F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_count"),
        F.sum(F.col("_n") * offset).over(upto).alias("_d1"),
        F.sum(F.col("_n") * offset * offset).over(upto).alias("_d2"),
        F.sum("_m2").over(upto).alias("_m2"),
        F.max("_max").over(upto).alias("_max"),
        F.coalesce(F.sum("_fraud").over(upto), F.lit(0)).alias("_fraud"),
        F.max("_step").over(upto).alias("_last_step"),
    )
    n = F.col("_count")
    squares = F.col("_m2") + F.col("_d2") - F.col("_d1") * F.col("_d1") / n
    variance = F.when(n > 1, F.greatest(squares, F.lit(0.0)) / (n - 1))
    return sums.select(
        *keys,
        "_step",
        "_count",
        F.when(n > 0, F.col("_base") + F.col("_d1") / n).alias("_avg"),
        F.sqrt(variance).alias("_std"),
        "_max",
        "_fraud",
        "_last_step",
    )


def _with_type_key(df: DataFrame, account: str) -> DataFrame:
    return _with_surrogates(df, account).withColumn(
        "_type", F.coalesce(F.col("type"), F.lit("\x00"))
    )


def _running_hot(rows: DataFrame, hot: DataFrame, account: str) -> DataFrame:
    """``_running`` for ``rows`` of hot accounts, from step cells of their input ``hot``."""
    keys = ["_key", "_type"]
    merged = merge_cells(step_cells(_with_type_key(hot, account), *keys), keys, last=0).select(
        *keys,
        "_step",
        F.col("_avg").alias("type_amount_avg"),
        F.col("_max").alias("type_amount_max"),
        F.col("_std").alias("type_amount_std"),
    )
    return salted_join(
        _with_type_key(rows, account), merged, [*keys, "_step"], spread_by="tx_id"
    )


def type_account_features(
    df: DataFrame, account: str = "nameOrig", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Running mean, max and deviation of amount per account and type."""
    ordinary, hot = split_hot(df, account, hot_rows)
    result = _running(ordinary, account, "type")
    if hot is not None:
        joined = _running_hot(hot, hot, account)
        result = result.unionByName(joined.select(*result.columns))
    return _with_ratio(result)


def account_features(
    df: DataFrame, account: str = "nameOrig", hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Temporal, type and risk features in one table.

    Without hot accounts the account windows come first, so that one exchange on
    the account serves the (account, type) windows too.
    """
    ordinary, hot = split_hot(df, account, hot_rows)
    result = _running(_rolling(ordinary, account), account, "type")
    if hot is not None:
        joined = _running_hot(_rolling_hot(hot, account, hot_rows), hot, account)
        result = result.unionByName(joined.select(*result.columns))
    return with_risk_features(_with_ratio(result))
