"""Files, feature tables, the batch load, streams and models end to end."""

import json

import pytest
from conftest import FIVE, rows_by
from pyspark.sql import functions as F

from ledgersift.ml import forest as I
from ledgersift.ml import score as M
from ledgersift.ml import train as R
from ledgersift.ml.prepare import split
from ledgersift.operators.layout import kept
from ledgersift.plans.etl import STAGES, EtlError, run_etl
from ledgersift.schema import CSV_SCHEMA
from ledgersift.sources import views as V
from ledgersift.sources.feature_tables import FeatureTables
from ledgersift.sources.files import MissingInputError, load_features, read_transactions_csv
from ledgersift.streaming import scoring as SS
from ledgersift.streaming import sinks as K
from ledgersift.streaming.sources import parse_messages, read_json_files


@pytest.fixture
def csv_path(tmp_path):
    lines = [",".join(CSV_SCHEMA.names)]
    lines += [",".join(str(v) for v in row[1:]) for row in FIVE[:3]]
    lines.append("not-a-step,CASH_IN,x,,,,,,,,")
    path = tmp_path / "tx.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_csv_drops_malformed(spark, csv_path):
    df = read_transactions_csv(spark, csv_path)
    assert sorted(r.amount for r in df.collect()) == [80.0, 2500.0, 320000.0]
    assert read_transactions_csv(spark, csv_path, schema=None).columns == CSV_SCHEMA.names
    with pytest.raises(MissingInputError):
        read_transactions_csv(spark, csv_path + ".absent")


def test_etl(spark, csv_path, tmp_path):
    out = str(tmp_path / "out")
    metrics = run_etl(spark, csv_path, out).first()
    assert (metrics.total_records, metrics.processed_records, metrics.error_records) == (4, 3, 1)
    assert metrics.fraud_records == 1
    assert list(metrics.stages) == list(STAGES) and metrics.success_rate_pct == 75.0
    written = spark.read.parquet(out)
    assert written.count() == 3 and "type_TRANSFER" in written.columns
    pruned = written.filter(F.col("type") == "TRANSFER")
    assert "PartitionFilters: [isnotnull(type" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises((EtlError, MissingInputError)):
        run_etl(spark, csv_path + ".absent", out)


def test_feature_tables(spark, five, tmp_path, csv_path):
    tables = FeatureTables(spark, str(tmp_path / "store"))
    assert tables.version("tx") == 0
    with pytest.raises(KeyError):
        tables.load("tx")
    assert tables.create(five, "tx") == 1
    assert tables.create(five.limit(2), "tx", partition_by=()) == 2
    assert tables.load("tx").count() == 2 and tables.load("tx", 1).count() == 5
    assert tables.metadata().count() == 2
    assert load_features(spark, str(tmp_path / "none"), csv_path).count() == 3
    assert load_features(spark, str(tmp_path / "store" / "tx" / "version=1"), csv_path).count() == 5


def write_messages(folder, rows, name):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def message(i, amount, minute=0):
    return {
        "step": 1, "type": "TRANSFER", "amount": amount, "nameOrig": f"C{i}",
        "oldbalanceOrg": 10.0, "newbalanceOrig": 0.0, "nameDest": "M1", "oldbalanceDest": 0.0,
        "newbalanceDest": amount, "isFraud": 0, "timestamp": f"2024-01-01T10:{minute:02d}:00Z",
    }


def test_stream_alerts_to_several_sinks(spark, tmp_path):
    source = tmp_path / "in"
    for f in range(3):
        write_messages(source, [message(10 * f + i, 60000.0 * i) for i in range(4)], f"{f}.json")
    stream = read_json_files(spark, str(source), files_per_trigger=1)
    sinks = [K.files_batch_sink(str(tmp_path / n)) for n in ("a", "b")]
    checkpoint = str(tmp_path / "cp")
    job = K.start_alerts(stream, sinks, checkpoint, once=True)
    job.await_all()
    assert not job.active
    for n in ("a", "b"):
        got = spark.read.json(str(tmp_path / n))
        assert got.count() == 6
        assert {r.fraud_probability for r in got.collect()} == {0.8}
    # Nothing new: a restart from the checkpoint adds nothing.
    K.start_alerts(stream, sinks, checkpoint, once=True).await_all()
    assert spark.read.json(str(tmp_path / "a")).count() == 6


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    rows = [message(i, 30000.0 * i) for i in range(6)]
    write_messages(source, rows, "x.json")
    stream = SS.score(SS.with_stream_features(read_json_files(spark, str(source))))
    got = K.run_to_table(spark, stream, "test-stream").drop("prediction_timestamp")
    batch = parse_messages(spark.read.text(str(source)))
    want = SS.score(SS.with_stream_features(batch)).drop("prediction_timestamp")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 6


def test_memory_sink_and_alert_messages(spark, tmp_path):
    source = tmp_path / "in"
    write_messages(source, [message(1, 200000.0)], "x.json")
    stream = SS.alerts(SS.score(read_json_files(spark, str(source))))
    query = K.to_memory(SS.alert_messages(stream), "alerts_in_memory")
    query.processAllAvailable()
    query.stop()
    value = json.loads(spark.table("alerts_in_memory").first().value)
    assert value["transaction_id"] == "C1" and value["prediction"] == 1.0
    assert set(value) == {
        "transaction_id", "amount", "type", "fraud_probability", "prediction",
        "prediction_timestamp",
    }


def test_minute_counts_wait_for_watermark(spark, tmp_path):
    source = tmp_path / "in"
    write_messages(source, [message(i, 1.0, minute=m) for i, m in enumerate((0, 0, 1, 30))], "x.json")
    counts = SS.minute_counts(read_json_files(spark, str(source)))
    got = K.run_to_table(spark, counts, "test-minutes")
    assert [r.volume for r in got.orderBy("minute").collect()] == [2, 1]


def test_stream_cache_keeps_newest(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "cache")
    for name, minute in (("a", 5), ("b", 9), ("c", 7)):
        write_messages(source, [message(1, minute * 1.0, minute)], f"{name}.json")
    stream = read_json_files(spark, str(source), files_per_trigger=1)
    job = K.feed_cache(
        stream, path, str(tmp_path / "cp"), time="timestamp", tie="step", once=True
    )
    job.await_all()
    row = K.read_cache(spark, path, tie="step").first()
    assert (row.cache_key, row.amount) == ("account:C1", 9.0)
    assert spark.read.parquet(path).count() == 3


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    with kept(*split(V.transactions(spark, sf_dir))) as (train, test):
        yield train, test


def test_model_learns_and_round_trips(spark, parts, tmp_path):
    train, test = parts
    trained = R.train(train, "random_forest", numTrees=20, maxDepth=6, with_type=True)
    row = R.metrics_table(spark, [R.evaluate(trained, test)]).first()
    assert row.auc_roc > 0.75
    assert row.tp + row.tn + row.fp + row.fn == test.count()
    path = str(tmp_path / "model")
    R.save_model(trained.model, path)
    loaded = R.load_model(path)
    raw = test.drop("label", "weight", "isFraud", "isFlaggedFraud")
    a = rows_by(M.score_batch(trained.model, raw))
    b = rows_by(M.score_batch(loaded, raw))
    assert {k: v.fraud_probability for k, v in a.items()} == {
        k: v.fraud_probability for k, v in b.items()
    }
    assert len({round(v.fraud_probability, 6) for v in a.values()}) > 5
    assert R.model_info(loaded)["stages"][-1] == "RandomForestClassificationModel"
    streamed = SS.score(raw, loaded).select("fraud_probability", "prediction").first()
    assert 0 <= streamed.fraud_probability <= 1


def test_training_choices(parts):
    train, test = parts
    with pytest.raises(ValueError):
        R.make_estimator("nothing")
    with pytest.raises(ValueError):
        R.tune(train, "logistic_regression")
    compared = R.compare_models(
        train, test, ("decision_tree", "nothing", "logistic_regression")
    )
    assert {r.model for r in compared.collect()} == {"decision_tree", "logistic_regression"}
    best = R.best_model(compared).first()
    assert best.f1 == max(r.f1 for r in compared.collect())
    assert "decision_tree" in R.report(compared)


def test_tuning_marks_the_best(parts):
    train, _ = parts
    fitted, table = R.tune(train, "random_forest", grid={"numTrees": (2,), "maxDepth": (1, 5)}, folds=2)
    rows = table.collect()
    assert len(rows) == 2
    assert [r.best for r in rows].count(True) >= 1
    assert max(rows, key=lambda r: r.auc_roc).best


def test_documented_settings_reach_the_models(parts):
    """The numbers of trees and rounds of the fitted models are the documented ones."""
    train, _ = parts
    forest = R.train(train, "random_forest").model.stages[-1]
    assert (forest.getNumTrees, forest.getMaxDepth()) == (100, 10)
    assert R.make_estimator("gbt").getMaxIter() == 100
    assert R.make_estimator("boosted").getMaxIter() == 200
    assert R.make_estimator("gbt_advanced").getMaxIter() == 200
    assert R.make_estimator("random_forest_advanced").getNumTrees() == 200


def test_weighted_boosting_raises_recall(parts):
    train, test = parts
    small = {"maxIter": 3, "maxDepth": 3}
    plain = R.evaluate(R.train(train, "boosted", **small), test)
    weighted = R.evaluate(R.train(train, "boosted_weighted", **small), test)
    recall = R.METRICS_SCHEMA.split(", ").index("recall double")
    assert weighted[recall] >= plain[recall]


def test_isolation_forest(spark):
    rows = [(i, float(i % 17), float(i % 13), 1.0, 2.0, 3.0) for i in range(2000)]
    rows += [(2000 + i, 5000.0 + i, 9000.0, 1.0, 2.0, 3.0) for i in range(10)]
    df = spark.createDataFrame(rows, "tx_id long, " + ", ".join(f"{c} double" for c in I.FOREST_COLUMNS))
    found, forest = I.find_anomalies(df, contamination=0.01, trees=40, sample_rows=128)
    assert len(forest.trees) == 40 and forest.sample_rows == pytest.approx(50.25)
    flagged = {r.tx_id for r in found.filter("is_anomaly").collect()}
    assert set(range(2000, 2010)) <= flagged and len(flagged) <= 25
    again, _ = I.find_anomalies(df.repartition(7), contamination=0.01, trees=40, sample_rows=128)
    assert {r.tx_id for r in again.filter("is_anomaly").collect()} == flagged
