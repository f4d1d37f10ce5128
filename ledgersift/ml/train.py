"""Estimators, training, evaluation, comparison and tuning."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass
from itertools import product
from math import prod
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersift.functions.features import MODEL_COLUMNS_8
from ledgersift.ml.areas import areas, prediction_areas
from ledgersift.ml.binned_forest import RandomForestClassifier
from ledgersift.ml.boosting import BoostedTreesClassifier, GradientTreesClassifier
from ledgersift.ml.nested import COUNTS, prefix_scores
from ledgersift.ml.prepare import full_pipeline, labelled
from ledgersift.operators.analytics import confusion_metrics
from ledgersift.operators.layout import dealt, kept

log = logging.getLogger(__name__)

_COLUMNS = {"featuresCol": "features", "labelCol": "label"}

# The documented settings of each model.
SETTINGS = {
    "random_forest": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "gbt": {"maxIter": 100, "maxDepth": 5, "seed": 42},
    "logistic_regression": {"maxIter": 100, "regParam": 0.01},
    "decision_tree": {"maxDepth": 10, "seed": 42},
    "random_forest_advanced": {
        "numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2, "seed": 42,
    },
    "gbt_advanced": {"maxIter": 200, "maxDepth": 8, "stepSize": 0.1, "seed": 42},
    "boosted": {
        "maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "columnRate": 0.8, "seed": 42,
    },
    "boosted_weighted": {
        "maxIter": 100, "maxDepth": 8, "stepSize": 0.1, "subsamplingRate": 0.8, "columnRate": 0.8,
        "weightCol": "weight", "seed": 42,
    },
}
_CLASSES = {
    "random_forest": RandomForestClassifier,
    "gbt": GradientTreesClassifier,
    "logistic_regression": LogisticRegression,
    "decision_tree": DecisionTreeClassifier,
    "random_forest_advanced": RandomForestClassifier,
    "gbt_advanced": GradientTreesClassifier,
    "boosted": BoostedTreesClassifier,
    "boosted_weighted": BoostedTreesClassifier,
}
COMPARED = ("random_forest", "gbt", "logistic_regression", "decision_tree")

# Tuning grids.
GRIDS = {
    "random_forest": {"numTrees": (50, 100, 200), "maxDepth": (5, 10, 15)},
    "gbt": {"maxIter": (50, 100, 200), "maxDepth": (3, 5, 7)},
}
LARGE_GRIDS = {
    "random_forest": {
        "numTrees": (50, 100, 200, 300), "maxDepth": (5, 10, 15, 20),
        "minInstancesPerNode": (1, 2, 4),
    },
    "gbt": {
        "maxIter": (50, 100, 200), "maxDepth": (3, 5, 7, 10), "stepSize": (0.01, 0.1, 0.2),
    },
}

METRICS_SCHEMA = (
    "model string, tp bigint, tn bigint, fp bigint, fn bigint, accuracy double, "
    "precision double, recall double, f1 double, auc_roc double, auc_pr double, "
    "training_seconds double"
)


def make_estimator(name: str, **changes):
    if name not in SETTINGS:
        raise ValueError(f"unknown model: {name}")
    return _CLASSES[name](**_COLUMNS, **(SETTINGS[name] | changes))


def fit_dealt(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """The pipeline fitted to rows in even partitions, each in the order of the ids.

    Boosting deals its own table out.
    """
    if isinstance(pipeline.getStages()[-1], BoostedTreesClassifier) or "tx_id" not in rows.columns:
        return pipeline.fit(rows)
    with kept(dealt(rows, "tx_id", rows.count()).sortWithinPartitions("tx_id")) as (even,):
        return pipeline.fit(even)


@dataclass
class Trained:
    name: str
    model: PipelineModel
    seconds: float


def train(
    df: DataFrame,
    name: str,
    wanted: tuple[str, ...] = MODEL_COLUMNS_8,
    with_type: bool = False,
    fraud_weight: float = 10.0,
    **changes,
) -> Trained:
    """Fit preparation and classifier on labelled rows."""
    estimator = make_estimator(name, **changes)
    pipeline = full_pipeline(estimator, df.columns, wanted, with_type)
    rows = labelled(df, fraud_weight) if name == "boosted_weighted" else df
    started = time.monotonic()
    model = fit_dealt(pipeline, rows)
    return Trained(name, model, time.monotonic() - started)


def auc(predictions: DataFrame, metric: str = "areaUnderROC") -> float:
    """The exact area (see ``areas``); ties of the score count half."""
    return prediction_areas(predictions)[("areaUnderROC", "areaUnderPR").index(metric)]


def _in_threads(spark: SparkSession, work: Callable, items: list, parallelism: int) -> list:
    """``work`` of every item, several at a time: their jobs fill each other's gaps."""
    if parallelism <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)


def evaluate(trained: Trained, test: DataFrame) -> tuple:
    """One metrics row (see METRICS_SCHEMA)."""
    scored = trained.model.transform(test).select("label", "prediction", "rawPrediction")
    scored.persist()
    try:
        hit, fraud = F.col("prediction") == 1.0, F.col("label") == 1.0
        counts = confusion_metrics(scored, hit, fraud).first()
        both = prediction_areas(scored)
    finally:
        scored.unpersist()
    return (trained.name, *counts, *both, trained.seconds)


def metrics_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def compare_models(
    train_df: DataFrame,
    test_df: DataFrame,
    names: tuple[str, ...] = COMPARED,
    changes: dict[str, dict] | None = None,
    parallelism: int = 1,
) -> DataFrame:
    """One metrics row per model; a model that fails is logged and left out.

    With ``parallelism`` over 1 models are fitted side by side, and their times overlap.
    """

    def one(name: str) -> tuple | None:
        try:
            trained = train(train_df, name, **(changes or {}).get(name, {}))
            return evaluate(trained, test_df)
        except Exception:
            log.exception("training %s failed", name)
            return None

    spark = train_df.sparkSession
    return metrics_table(spark, [r for r in _in_threads(spark, one, list(names), parallelism) if r])


def best_model(comparison: DataFrame, metric: str = "f1") -> DataFrame:
    return comparison.orderBy(F.desc(metric), "model").limit(1)


def _with_folds(df: DataFrame, folds: int) -> DataFrame:
    """Fold number by id hash: the same rows whatever the partitioning."""
    return df.withColumn("fold", F.pmod(F.xxhash64("tx_id"), F.lit(folds)).cast("int"))


@dataclass
class Tuned:
    """The best point's model, fitted to all rows, and the mean area of every point."""

    bestModel: PipelineModel
    avgMetrics: list[float]


def _fold_areas(df: DataFrame, name: str, fold: int, settings: dict, shared: dict[str, list[int]]) -> list[float]:
    """Area under ROC on one fold of the models fitted to the others, one for each point of ``shared``.

    ``shared`` are numbers of trees and, for a forest, depths, in the order depth, number. The largest
    ensemble is fitted; the smaller ones are its first trees, cut at the depth.
    """
    largest = {p: values[-1] for p, values in shared.items()}
    rest, held = df.filter(F.col("fold") != fold), df.filter(F.col("fold") == fold)
    model = fit_dealt(full_pipeline(make_estimator(name, **settings, **largest), df.columns), rest)
    if not shared:
        return [auc(model.transform(held))]
    classifier, prepared = model.stages[-1], PipelineModel(stages=model.stages[:-1]).transform(held)
    count = next((c for c in COUNTS if c in shared), None)
    counts = shared[count] if count else [classifier.getNumTrees]
    scores = prefix_scores(classifier, prepared, counts, depths=shared.get("maxDepth"))
    scored = scores.select("label", F.posexplode("scores").alias("place", "score"))
    found = {int(r["curve"]): r["auc_roc"] or 0.0 for r in areas(scored, curve="place").collect()}  # one row for each point
    return [found.get(i, 0.0) for i in range(prod(len(v) for v in shared.values()))]


def tune(
    df: DataFrame,
    name: str,
    grid: dict[str, tuple] | str | None = None,
    folds: int = 3,
    parallelism: int = 4,
    **changes,
) -> tuple[Tuned, DataFrame]:
    """Grid search by area under ROC: the best model and one row per grid point.

    ``grid`` may be "large" for the larger documented one. Points that differ in the number
    of trees alone share their fits, those of a forest also if they differ in depth.
    """
    grids = LARGE_GRIDS if grid == "large" else GRIDS
    if not isinstance(grid, dict) and name not in grids:
        raise ValueError(f"no tuning grid for model: {name}")
    wanted = grid if isinstance(grid, dict) else grids[name]
    sharing = ("maxDepth",) * (_CLASSES.get(name) is RandomForestClassifier) + COUNTS
    shared = {p: sorted(set(wanted[p])) for p in sharing if p in wanted}
    others = [p for p in wanted if p not in shared]
    points = [dict(zip(others, values)) for values in product(*(wanted[p] for p in others))]
    with kept(_with_folds(df, folds)) as (folded,):
        jobs = [(fold, point) for point in reversed(points) for fold in range(folds)]  # the longest first
        work = lambda job: _fold_areas(folded, name, job[0], changes | job[1], shared)
        found = _in_threads(df.sparkSession, work, jobs, parallelism)
    means = {}
    for place, inner in enumerate(product(*shared.values())):
        for point in points:
            own = [f[place] for (_, p), f in zip(jobs, found) if p == point]
            means[inner, tuple(point.values())] = sum(own) / folds
    rows, settings = [], []
    for values in product(*wanted.values()):
        point = dict(zip(wanted, values))
        settings.append(point)
        mean = means[tuple(point[p] for p in shared), tuple(point[p] for p in others)]
        rows.append((", ".join(f"{p}={v}" for p, v in point.items()), mean))
    best = max(score for _, score in rows)
    chosen = settings[[score for _, score in rows].index(best)]
    model = fit_dealt(full_pipeline(make_estimator(name, **(changes | chosen)), df.columns), df)
    table = df.sparkSession.createDataFrame(
        [(text, score, score == best) for text, score in rows], "parameters string, auc_roc double, best boolean"
    )
    return Tuned(model, [score for _, score in rows]), table


def cross_validate(df: DataFrame, name: str, folds: int = 5, parallelism: int = 4, **changes) -> DataFrame:
    """Mean and deviation of area under ROC over the folds."""
    with kept(_with_folds(df, folds)) as (folded,):
        work = lambda fold: _fold_areas(folded, name, fold, changes, {})[0]
        found = _in_threads(df.sparkSession, work, list(range(folds)), parallelism)
    mean = sum(found) / folds
    deviation = (sum((x - mean) ** 2 for x in found) / max(folds - 1, 1)) ** 0.5
    return df.sparkSession.createDataFrame(
        [(name, folds, mean, deviation)], "model string, folds int, mean_auc double, std_auc double"
    )


def benchmark_model(train_df: DataFrame, test_df: DataFrame, name: str, **changes) -> DataFrame:
    """Fit time, time per scored row (all rows computed), and metrics."""
    trained = train(train_df, name, **changes)
    started = time.monotonic()
    trained.model.transform(test_df).write.format("noop").mode("overwrite").save()
    seconds = time.monotonic() - started
    table = metrics_table(train_df.sparkSession, [evaluate(trained, test_df)])
    n = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    return table.withColumn("seconds_per_prediction", F.lit(seconds) / n)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_info(model: PipelineModel, path: str = "") -> dict:
    return {"path": path, "stages": [type(s).__name__ for s in model.stages]}


def report(comparison: DataFrame) -> str:
    """Plain-text comparison, best F1 first (one line per model)."""
    lines = ["MODEL COMPARISON"]
    for r in comparison.orderBy(F.desc("f1"), "model").collect():
        lines.append(
            f"{r.model:20} auc={r.auc_roc:.4f} f1={r.f1:.4f} precision={r.precision:.4f} "
            f"recall={r.recall:.4f} seconds={r.training_seconds:.2f}"
        )
    return "\n".join(lines)
