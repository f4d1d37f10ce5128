"""Exact areas under the ROC and the precision-recall curve.

Rows of one score are one group, counted before the shuffle. The groups are range-partitioned
by falling score and stored; one short row per range comes back with its counts, which
gives every range what is before it. So each range adds up its share of both areas for
itself, and ties count half, whatever the number of distinct scores.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersift.session import work_path

AREAS_SCHEMA = "curve string, positives bigint, negatives bigint, auc_roc double, auc_pr double"
#: Groups of one range, about.
RANGE_GROUPS = 1_000_000


def _stored_ranges(groups: DataFrame) -> DataFrame:
    """Groups (curve, score, pos, neg) in ranges of falling score, stored with the range's number."""
    spark = groups.sparkSession
    path = work_path(spark, "score-groups")
    groups.write.parquet(path)
    kind = groups.schema
    stored = spark.read.schema(kind).parquet(path)
    ranges = max(1, -(-stored.count() // RANGE_GROUPS))
    ranged = work_path(spark, "score-ranges")
    ordered = stored.repartitionByRange(ranges, "curve", F.desc("score"))
    ordered.withColumn("part", F.spark_partition_id()).write.parquet(ranged)
    return spark.read.schema(f"{kind.simpleString()[7:-1].replace(':', ' ')}, part int").parquet(ranged)


def areas(rows: DataFrame, score: Column | str = "score", label: Column | str = "label", curve: Column | str | None = None) -> DataFrame:
    """One row (see ``AREAS_SCHEMA``) for each value of ``curve``, or one for all rows.

    Rows without a score or label count nowhere. A curve without positives or negatives has
    no area (null). Precision before the first group is taken as that group's.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    name = F.lit("all") if curve is None else column(curve).cast("string")
    known = rows.select(name.alias("curve"), column(score).cast("double").alias("score"), column(label).cast("double").alias("label"))
    groups = (
        known.where("score IS NOT NULL AND label IS NOT NULL")
        .groupBy("curve", "score")
        .agg(F.count_if(F.col("label") > 0.5).alias("pos"), F.count_if(F.col("label") <= 0.5).alias("neg"))
    )
    stored = _stored_ranges(groups)
    before, seen = [], {}
    totals = stored.groupBy("curve", "part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    for r in sorted(totals.collect(), key=lambda r: (r["part"], r["curve"])):  # one for each range, and each curve that begins in it
        pos, neg = seen.get(r["curve"], (0, 0))
        before.append((r["curve"], r["part"], pos, neg))
        seen[r["curve"]] = (pos + r["pos"], neg + r["neg"])
    spark = rows.sparkSession
    offsets = spark.createDataFrame(before, "curve string, part int, pos_before bigint, neg_before bigint")
    ends = spark.createDataFrame([(c, p, n) for c, (p, n) in seen.items()], "curve string, positives bigint, negatives bigint")
    running = Window.partitionBy("curve", "part").orderBy(F.desc("score"))
    upto = {c: F.sum(c).over(running) for c in ("pos", "neg")}
    counted = stored.select("curve", "part", "pos", "neg", upto["pos"].alias("tp"), upto["neg"].alias("fp"))
    placed = (
        counted.join(F.broadcast(offsets), ["curve", "part"])
        .withColumn("tp", F.col("tp") + F.col("pos_before"))
        .withColumn("fp", F.col("fp") + F.col("neg_before"))
    )
    above_pos, above_neg = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    earlier = F.when(above_pos + above_neg > 0, above_pos / (above_pos + above_neg)).otherwise(precision)
    parts = placed.groupBy("curve").agg(
        F.sum(F.col("neg").cast("double") * (above_pos + F.col("pos") / 2)).alias("won"),
        F.sum(F.col("pos") * (precision + earlier) / 2).alias("under"),
    )
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    return parts.join(F.broadcast(ends), "curve").select(
        "curve", "positives", "negatives",
        F.when(both, F.col("won") / F.col("positives") / F.col("negatives")).alias("auc_roc"),
        F.when(both, F.col("under") / F.col("positives")).alias("auc_pr"),
    )


def prediction_score(predictions: DataFrame, column: str = "rawPrediction") -> Column:
    """The number by which a classifier orders rows: a score, or the second entry of a vector."""
    is_vector = isinstance(predictions.schema[column].dataType, VectorUDT)
    return vector_to_array(F.col(column))[1] if is_vector else F.col(column)


def prediction_areas(predictions: DataFrame) -> tuple[float, float]:
    """Area under ROC and under precision-recall of scored, labelled rows; 0 without an area."""
    row = areas(predictions, prediction_score(predictions)).first()
    return (row["auc_roc"] or 0.0, row["auc_pr"] or 0.0) if row else (0.0, 0.0)
