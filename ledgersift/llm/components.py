"""Connected components by alternating stars, one shared table per round.

Round for round every node is tied to the smallest node it knows of; the edges end as
stars around the smallest node of each component. Nothing but two sums reaches the
driver. Hubs are joined, never collected, so a node with very many edges is split by
adaptive execution like any other skewed key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersift.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = both.where("b > a").join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b of one orderable type) that is not its own root.

    Loops and null ends are ignored; an empty table gives an empty result.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    # equal sums of 64-bit hashes, taken as decimals, mean that the round changed nothing
    state = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))]
    before = tuple(now.agg(*state).first())
    while before[0]:
        earlier, now = now, written(_small_star(_large_star(now)), "edges")
        discard(earlier)
        after = tuple(now.agg(*state).first())
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
