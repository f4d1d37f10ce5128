"""Model training, evaluation and scoring over all transactions, at the documented settings.

What a fitted model predicts is beyond SQL. So these queries return what SQL can count
(rows, positives, folds, grid points) beside booleans that hold the measured figures
against what a useful model must reach.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgersift.functions.features import MODEL_COLUMNS_8
from ledgersift.ml import forest as I
from ledgersift.ml import score as M
from ledgersift.ml import train as R
from ledgersift.ml.prepare import ADVANCED_COLUMNS_10, labelled, preparation, split
from ledgersift.operators import history as H
from ledgersift.operators.layout import kept
from ledgersift.operators.sampling import balanced_sample
from ledgersift.plans.catalog import query
from ledgersift.plans.sql import with_tables
from ledgersift.session import work_path
from ledgersift.sources import views as V

#: Area under ROC that every trained model must reach on the test rows.
LEAST_AUC = 0.6


def _split(spark, sf_dir):
    return split(V.transactions(spark, sf_dir))


def _trained(spark, sf_dir, name, **options):
    """A fitted model and the test rows; the training rows are kept while fitting."""
    train, test = _split(spark, sf_dir)
    with kept(train):
        return R.train(train, name, **options), test


def _figures(table):
    """Test rows and positives of a metrics table, and whether its figures are good enough."""
    rows = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    positives = F.col("tp") + F.col("fn")
    return table.select(
        "model",
        rows.alias("test_rows"),
        positives.alias("positives"),
        (F.col("auc_roc") >= LEAST_AUC).alias("roc_reached"),
        (F.col("auc_pr") > positives / rows).alias("pr_above_base"),
    )


def _figures_sql(*names):
    """The same for models of these names."""
    values = ", ".join(f"('{n}')" for n in names)
    return with_tables(
        f"""SELECT model, count(*) FILTER (NOT {_TRAIN}) AS test_rows,
  count(*) FILTER (NOT {_TRAIN} AND isFraud = 1) AS positives, TRUE AS roc_reached, TRUE AS pr_above_base
FROM transactions, (VALUES {values}) AS _names(model) GROUP BY model""",
        "transactions",
    )


_TRAIN = f"substr(md5('42:' || tx_id), 1, 8) < '{int(0.8 * 2**32):08x}'"


def _train_query(name, key, **options):
    @query(key, _figures_sql(name))
    def run(spark, sf_dir):
        trained, test = _trained(spark, sf_dir, name, **options)
        return _figures(R.metrics_table(spark, [R.evaluate(trained, test)]))

    return run


train_rf = _train_query("random_forest", "train_rf")
train_gbt = _train_query("gbt", "train_gbt")
train_lr = _train_query("logistic_regression", "train_lr")
train_dt = _train_query("decision_tree", "train_dt")
train_boosted = _train_query("boosted", "train_boosted", with_type=True)
train_advanced = _train_query(
    "random_forest_advanced", "train_rf_advanced", wanted=ADVANCED_COLUMNS_10
)
train_gbt_advanced = _train_query("gbt_advanced", "train_gbt_advanced", wanted=ADVANCED_COLUMNS_10)


_RAW = {c: c for c in MODEL_COLUMNS_8} | {
    "amount_ratio": "CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0e0 END",
    "is_large_amount": "CASE WHEN amount > 100000 THEN 1e0 ELSE 0e0 END",
}
_SCALED = ", ".join(
    f"round(({c} - avg({c}) FILTER (split = 'train') OVER ()) "
    f"/ stddev_samp({c}) FILTER (split = 'train') OVER (), 5) AS scaled_{c}"
    for c in MODEL_COLUMNS_8
)


_SAMPLE = """_sample AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY isFraud
  ORDER BY md5('42:' || tx_id), tx_id) AS place FROM transactions)
WHERE place <= CASE WHEN isFraud = 1 THEN 5000 ELSE 50000 END)"""


@query(
    "train_boosted_weighted",
    with_tables(
        f""", {_SAMPLE} SELECT 'boosted_weighted' AS model, count(*) AS test_rows,
  count(*) FILTER (isFraud = 1) AS positives, TRUE AS roc_reached, TRUE AS pr_above_base
FROM _sample WHERE NOT {_TRAIN}""",
        "transactions",
    ),
)
def train_boosted_weighted(spark, sf_dir):
    """Boosting with weighted frauds and the encoded type, on the balanced sample.

    Sample and split go by the same hash, so of a large table the sample has no test rows. Its
    test rows are counted; the figures are measured on those of the whole table, which hold them.
    """
    tx = V.transactions(spark, sf_dir)
    sample = balanced_sample(tx, fraud_rows=5000, normal_rows=50000)
    with kept(*split(sample)) as (train, test):
        trained = R.train(train, "boosted_weighted", with_type=True)
        counts = test.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 1.0)).first()
    measured = _figures(R.metrics_table(spark, [R.evaluate(trained, split(tx)[1])]))
    return measured.withColumns({c: F.lit(n).cast("bigint") for c, n in zip(("test_rows", "positives"), counts)})


@query(
    "ml_prepare",
    with_tables(
        f"""SELECT tx_id, split, CAST(isFraud AS DOUBLE) AS label, {_SCALED}
FROM (SELECT tx_id, isFraud, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS split,
  {", ".join(f"{sql} AS {c}" for c, sql in _RAW.items())} FROM transactions)""",
        "transactions",
    ),
)
def ml_prepare(spark, sf_dir):
    """Features standardised by the training rows' mean and deviation."""
    train, test = _split(spark, sf_dir)
    fitted = Pipeline(stages=preparation(train.columns)).fit(train)
    parts = [
        fitted.transform(d).select(
            "tx_id", F.lit(n).alias("split"), "label", vector_to_array("features").alias("v")
        )
        for d, n in ((train, "train"), (test, "test"))
    ]
    scaled = [
        F.round(F.col("v")[i], 5).alias(f"scaled_{c}") for i, c in enumerate(MODEL_COLUMNS_8)
    ]
    return parts[0].unionByName(parts[1]).select("tx_id", "split", "label", *scaled)


@query(
    "rule_auc",
    with_tables(
        """SELECT round(sum(neg * (above + pos / 2e0)) / (sum(pos) * sum(neg)), 6) AS auc_roc
FROM (SELECT pos, neg, coalesce(sum(pos) OVER (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) AS above
  FROM (SELECT fraud_probability AS p, count(*) FILTER (isFraud = 1) AS pos,
    count(*) FILTER (isFraud = 0) AS neg FROM reduced GROUP BY 1))""",
        "reduced",
    ),
)
def rule_auc(spark, sf_dir):
    """Area under ROC of the history-adjusted rule score."""
    scored = labelled(H.score_with_history(V.transactions(spark, sf_dir)))
    area = R.auc(scored.withColumnRenamed("fraud_probability", "rawPrediction"))
    return spark.range(1).select(F.round(F.lit(area), 6).alias("auc_roc"))


@query(
    "auc",
    with_tables(
        f"""SELECT count(*) AS test_rows, TRUE AS roc_reached, TRUE AS pr_above_base FROM transactions
WHERE NOT {_TRAIN}""",
        "transactions",
    ),
)
def auc(spark, sf_dir):
    """Both areas of a regression: under ROC, and under precision-recall against the base rate."""
    trained, test = _trained(spark, sf_dir, "logistic_regression")
    scored = trained.model.transform(test)
    roc, pr = R.auc(scored), R.auc(scored, "areaUnderPR")
    return test.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.lit(roc >= LEAST_AUC).alias("roc_reached"),
        (F.lit(pr) > F.avg("label")).alias("pr_above_base"),
    )


@query(
    "train_model",
    with_tables(
        f"""SELECT 'decision_tree' AS model, count(*) AS training_rows,
  count(*) FILTER (isFraud = 1) AS positives, 10 AS depth_limit, TRUE AS within_limit
FROM transactions WHERE {_TRAIN}""",
        "transactions",
    ),
)
def train_model(spark, sf_dir):
    """Every trained model goes through one dispatcher; the fitted tree tells its depth."""
    train, _ = _split(spark, sf_dir)
    with kept(train):
        tree = R.train(train, "decision_tree").model.stages[-1]
        counts = train.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 1.0)).first()
    limit = tree.getMaxDepth()
    row = ("decision_tree", counts[0], counts[1], limit, 1 <= tree.depth <= limit)
    kind = "model string, training_rows bigint, positives bigint, depth_limit int, within_limit boolean"
    return spark.createDataFrame([row], kind)


@query("compare_models", _figures_sql(*R.COMPARED))
def compare_models(spark, sf_dir):
    with kept(*_split(spark, sf_dir)) as (train, test):
        return _figures(R.compare_models(train, test))


@query(
    "best_model",
    with_tables(
        f"""SELECT count(*) AS test_rows, count(*) FILTER (isFraud = 1) AS positives, 4 AS compared,
  TRUE AS has_largest_f1 FROM transactions WHERE NOT {_TRAIN}""",
        "transactions",
    ),
)
def best_model(spark, sf_dir):
    with kept(*_split(spark, sf_dir)) as (train, test):
        table = R.compare_models(train, test)
    best = R.best_model(table)
    largest, compared = table.agg(F.max("f1"), F.count(F.lit(1))).first()
    return best.select(
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("test_rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        F.lit(compared).cast("int").alias("compared"),
        (F.col("f1") == largest).alias("has_largest_f1"),
    )


_GRID = R.GRIDS["random_forest"]


@query(
    "tune_model",
    with_tables(
        f"""SELECT 'numTrees=' || t || ', maxDepth=' || d AS parameters,
  count(*) FILTER (NOT {_TRAIN}) AS test_rows, TRUE AS auc_reached, TRUE AS best_reached
FROM transactions, (SELECT unnest({list(_GRID["numTrees"])}) AS t), (SELECT unnest({list(_GRID["maxDepth"])}) AS d)
GROUP BY t, d""",
        "transactions",
    ),
)
def tune_model(spark, sf_dir):
    """The documented grid; the best point's model is evaluated on the test rows."""
    with kept(*_split(spark, sf_dir)) as (train, test):
        fitted, table = R.tune(train, "random_forest", folds=3, parallelism=6)
        chosen = R.metrics_table(spark, [R.evaluate(R.Trained("best", fitted.bestModel, 0.0), test)]).first()
    rows = chosen["tp"] + chosen["tn"] + chosen["fp"] + chosen["fn"]
    return table.select(
        "parameters",
        F.lit(rows).cast("bigint").alias("test_rows"),
        (F.col("auc_roc") >= LEAST_AUC).alias("auc_reached"),
        F.lit(chosen["auc_roc"] >= LEAST_AUC).alias("best_reached"),
    )


@query(
    "cross_validate",
    with_tables(
        f"""SELECT 'decision_tree' AS model, 5 AS folds, count(*) AS training_rows, TRUE AS auc_reached,
  TRUE AS steady FROM transactions WHERE {_TRAIN}""",
        "transactions",
    ),
)
def cross_validate(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    with kept(train):
        found = R.cross_validate(train, "decision_tree", folds=5)
        rows = train.count()
    return found.select(
        "model", "folds",
        F.lit(rows).cast("bigint").alias("training_rows"),
        (F.col("mean_auc") >= LEAST_AUC).alias("auc_reached"),
        (F.col("std_auc") < 0.1).alias("steady"),
    )


_ENSEMBLE = ("random_forest_advanced", "gbt_advanced", "boosted")


@query("train_ensemble", _figures_sql(*_ENSEMBLE, "isolation_forest"))
def train_ensemble(spark, sf_dir):
    """The advanced models, and the isolation forest: its two flags tell that about 1 % of the
    rows, and some, are anomalies."""
    with kept(*_split(spark, sf_dir)) as (train, test):
        table = _figures(R.compare_models(train, test, _ENSEMBLE, parallelism=len(_ENSEMBLE)))
        found, _ = I.find_anomalies(test.select("tx_id", "label", *I.FOREST_COLUMNS))
        share = F.count_if("is_anomaly") / F.count(F.lit(1))
        anomalies = found.agg(
            F.lit("isolation_forest").alias("model"),
            F.count(F.lit(1)).alias("test_rows"),
            F.count_if(F.col("label") == 1.0).alias("positives"),
            (F.abs(share - 0.01) <= 0.01).alias("roc_reached"),  # asked for 1 % anomalies
            F.count_if("is_anomaly").cast("boolean").alias("pr_above_base"),
        )
        row = anomalies.first()
    return table.unionByName(spark.createDataFrame([row], anomalies.schema))


@query(
    "predict",
    with_tables(
        f"SELECT tx_id, CAST(isFraud AS DOUBLE) AS label, TRUE AS is_class FROM transactions WHERE NOT {_TRAIN}",
        "transactions",
    ),
)
def predict(spark, sf_dir):
    trained, test = _trained(spark, sf_dir, "decision_tree")
    found = M.predict(trained.model, test)
    return found.select("tx_id", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"))


@query(
    "score_batch",
    with_tables(
        "SELECT tx_id, nameOrig AS transaction_id, TRUE AS is_probability, TRUE AS verdict_follows FROM dirty",
        "dirty",
    ),
)
def score_batch(spark, sf_dir):
    """Save, load and score all rows, incomplete ones included."""
    trained, _ = _trained(spark, sf_dir, "decision_tree")
    path = work_path(spark, "model")
    R.save_model(trained.model, path)
    scored = M.score_batch(R.load_model(path), V.dirty_transactions(spark, sf_dir))
    p = F.col("fraud_probability")
    return scored.select(
        "tx_id", "transaction_id", p.between(0.0, 1.0).alias("is_probability"),
        (F.col("is_fraud") == (p > 0.5)).alias("verdict_follows"),
    )


@query("benchmark_model", _figures_sql("decision_tree"))
def benchmark_model(spark, sf_dir):
    """Fit and prediction are timed; the times are positive, or the figures would be false."""
    with kept(*_split(spark, sf_dir)) as (train, test):
        table = R.benchmark_model(train, test, "decision_tree")
    timed = (F.col("training_seconds") > 0) & (F.col("seconds_per_prediction") > 0)
    return _figures(table.withColumn("auc_roc", F.when(timed, F.col("auc_roc")).otherwise(0.0)))


@query(
    "isolation_forest",
    with_tables("SELECT tx_id, TRUE AS is_score, TRUE AS share_as_asked FROM transactions", "transactions"),
)
def isolation_forest(spark, sf_dir):
    """Every transaction scored; the share of anomalies is within the quantile's error of 1 %."""
    columns = ("tx_id", *I.FOREST_COLUMNS)
    found, _ = I.find_anomalies(V.transactions(spark, sf_dir).select(*columns))
    share = found.agg(F.avg(F.col("is_anomaly").cast("int"))).first()[0] or 0.0
    return found.select(
        "tx_id", F.col("anomaly_score").between(0.0, 1.0).alias("is_score"),
        F.lit(abs(share - 0.01) <= 0.01).alias("share_as_asked"),
    )
