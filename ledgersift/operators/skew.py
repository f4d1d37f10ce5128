"""Help for keys that hold a large share of all rows.

A key is *hot* when it has more than ``hot_rows`` rows. There are at most
``rows / hot_rows`` hot keys whatever the data, so one row per hot key is a side
of proven size and may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000

# Rows of hot keys are spread over this many join keys that match nothing.
_SPREAD = 4096


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (counted with map-side combine)."""
    return df.groupBy(key).count().filter(F.col("count") > hot_rows).select(key)


def split_hot(
    df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Split ``df`` into rows of ordinary keys and rows of hot keys.

    Runs one counting job over the key column. Without hot keys the second part
    is None and the first is ``df`` itself, so that case keeps its simple plan.
    """
    hot = hot_keys(df, key, hot_rows).withColumnRenamed(key, "_hot_key")
    if hot.isEmpty():
        return df, None
    same = F.col(key).eqNullSafe(F.col("_hot_key"))
    return (
        df.join(F.broadcast(hot), same, "left_anti"),
        df.join(F.broadcast(hot), same, "left_semi"),
    )


def left_join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: str,
    hot_lookup: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join ``rows`` to ``lookup`` (one row per key) without a hot task.

    Rows of hot keys meet their lookup rows by broadcast; all others by an
    ordinary join on the key. Hot and null keys are rewritten to spread values
    before that second join, so their rows do not pile up in one partition.
    ``hot_lookup`` may be given when the lookup itself knows which keys are hot.
    """
    values = [c for c in lookup.columns if c != key]
    if hot_lookup is None:
        hot = hot_keys(rows.filter(F.col(key).isNotNull()), key, hot_rows)
        found = lookup.join(F.broadcast(hot), key)
        hot_lookup = hot.join(F.broadcast(found), key, "left")
    packed = hot_lookup.select(F.col(key), F.struct(*values).alias("_hot"))
    marked = rows.join(F.broadcast(packed), key, "left")

    spread = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)).cast("string"))
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    text_key = F.col(key).cast("string")
    marked = marked.withColumn("_join_key", F.when(settled, spread).otherwise(text_key))
    cold = lookup.select(
        F.col(key).cast("string").alias("_join_key"),
        *[F.col(v).alias(f"_cold_{v}") for v in values],
    )
    joined = marked.join(cold, "_join_key", "left")
    # A spread key matches nothing, so at most one of the two sides has a value.
    picked = [F.coalesce(F.col("_hot")[v], F.col(f"_cold_{v}")).alias(v) for v in values]
    return joined.select(*[F.col(c) for c in rows.columns], *picked)


def salted_join(
    rows: DataFrame, side: DataFrame, keys: list[str], spread_by: str, salts: int = 16
) -> DataFrame:
    """Inner join on ``keys`` with the smaller ``side`` copied ``salts`` times.

    Meant for rows of hot keys, where each row of ``side`` stands for many rows.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")
