"""Samples and splits by a hash of the row id.

A hash decides per row, so the choice does not change when a task is run again
or the table is partitioned differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
_BUCKET_DIGITS = 4


def row_hash(id_col: str = "tx_id", seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def in_fraction(fraction: float, id_col: str = "tx_id", seed: int = SEED) -> Column:
    """True for about ``fraction`` of the rows: the hash prefix is below a bound."""
    if fraction >= 1:
        return F.lit(True)
    bound = format(int(fraction * 2**32), "08x")
    return F.substring(row_hash(id_col, seed), 1, 8) < bound


def sample_fraction(
    df: DataFrame, fraction: float, seed: int = SEED, id_col: str | None = "tx_id"
) -> DataFrame:
    """Bernoulli sample; without an id column Spark's own sampler is used."""
    if id_col is None:
        return df.sample(fraction, seed)
    return df.filter(in_fraction(fraction, id_col, seed))


def train_test_split(
    df: DataFrame, train: float = 0.8, seed: int = SEED, id_col: str = "tx_id"
) -> tuple[DataFrame, DataFrame]:
    chosen = in_fraction(train, id_col, seed)
    return df.filter(chosen), df.filter(~chosen)


def exact_sample_by(
    df: DataFrame, sizes: dict[int, int], label: str, id_col: str = "tx_id", seed: int = SEED
) -> DataFrame:
    """The ``sizes[v]`` rows of smallest hash among the rows of each label value ``v``.

    Rows are counted per label and hash prefix; only rows of the prefixes that
    make up the wanted number go on, and each prefix is ordered by itself.
    """
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col(label)]
    hashed = df.withColumn("_hash", row_hash(id_col, seed)).withColumn(
        "_bucket", F.substring("_hash", 1, _BUCKET_DIGITS)
    )
    keys = [label, "_bucket"]
    buckets = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most 65,536 rows per label value, whatever the table size.
    upto = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(upto), F.lit(0))
    reach = buckets.select(*keys, before.alias("_before"), wanted.alias("_wanted")).filter(
        F.col("_before") < F.col("_wanted")
    )
    order = Window.partitionBy(*keys).orderBy("_hash", id_col)
    placed = hashed.join(F.broadcast(reach), keys).withColumn(
        "_place", F.row_number().over(order)
    )
    return placed.filter(F.col("_before") + F.col("_place") <= F.col("_wanted")).select(
        *df.columns
    )


def exact_sample(df: DataFrame, n: int, id_col: str = "tx_id", seed: int = SEED) -> DataFrame:
    """The ``n`` rows of smallest hash (all rows when there are fewer)."""
    one = df.withColumn("_all", F.lit(1))
    return exact_sample_by(one, {1: n}, "_all", id_col, seed).drop("_all")


def balanced_sample(
    df: DataFrame,
    fraud_rows: int = 5000,
    normal_rows: int = 50000,
    label: str = "isFraud",
    id_col: str = "tx_id",
    seed: int = SEED,
) -> DataFrame:
    """Exact row counts per class, put together."""
    return exact_sample_by(df, {1: fraud_rows, 0: normal_rows}, label, id_col, seed)
