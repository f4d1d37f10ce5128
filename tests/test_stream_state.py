"""The cache in the state store: newest entry, expiry on the stream, restart; and load and models in one session."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from ledgersift.ml import train as R
from ledgersift.ml.prepare import split
from ledgersift.plans.etl import run_etl
from ledgersift.schema import CSV_SCHEMA
from ledgersift.sources import views as V
from ledgersift.streaming.minutes import every_minute
from ledgersift.streaming.sinks import to_files
from ledgersift.streaming.state import newest_of_batches, read_cache_state, start_cache_state, state_store

KIND = "tx_id bigint, ts timestamp, type string, amount double, nameOrig string"


def feed(spark, folder, name, rows, out, checkpoint):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"tx_id": i, "ts": f"2024-01-01T{t}Z", "type": "DEBIT", "amount": float(i), "nameOrig": who}) for i, t, who in rows]
    (folder / name).write_text("\n".join(lines) + "\n")
    events = spark.readStream.schema(KIND).json(str(folder))
    start_cache_state(events, out, checkpoint, once=True).await_all()


def test_entries_expire_and_survive_a_restart(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source = tmp_path / "in"

    def live():
        return {r.cache_key: (r.tx_id, r.expires_at) for r in read_cache_state(spark, checkpoint).collect()}

    rows = [(1, "10:00:00", "A"), (2, "10:05:00", "A"), (3, "10:04:00", "A"), (4, "10:05:00", "B"), (5, "10:05:00", "B")]
    feed(spark, source, "a.json", rows, out, checkpoint)
    assert {k: v[0] for k, v in live().items()} == {"account:A": 2, "account:B": 5}  # newest; ties by id
    assert live()["account:A"][1] == datetime(2024, 1, 1, 10, 35)

    # restarted: an older row changes nothing, a newer one renews A; B runs out at 10:35
    feed(spark, source, "b.json", [(6, "10:02:00", "B"), (7, "10:30:00", "A"), (8, "10:50:00", "C")], out, checkpoint)
    assert {k: v[0] for k, v in live().items()} == {"account:A": 7, "account:C": 8}
    expired = [(r.entity, r.expired_at) for r in spark.read.parquet(out).collect()]
    assert expired == [("B", datetime(2024, 1, 1, 10, 35))]

    # an expired entity comes back
    feed(spark, source, "c.json", [(9, "10:51:00", "B")], out, checkpoint)
    assert {k: v[0] for k, v in live().items()} == {"account:A": 7, "account:B": 9, "account:C": 8}


def test_empty_minutes_come_out_once_and_in_turn(spark, tmp_path):
    """Gaps between messages, minutes after the last final one, a late message and restarts."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    source.mkdir()

    def after(name, *moments):
        (source / name).write_text("".join(json.dumps({"timestamp": f"2024-01-01T{m}Z"}) + "\n" for m in moments))
        stream = spark.readStream.schema("timestamp timestamp").json(str(source))
        with state_store(spark):
            to_files(every_minute(stream), out, checkpoint, once=True).awaitTermination()
        rows = spark.read.schema("minute timestamp, volume bigint").parquet(out).orderBy("minute").collect()
        assert [r.minute for r in rows] == [datetime(2024, 1, 1, 10, k) for k in range(len(rows))]
        return [r.volume for r in rows]

    assert after("a.json", "10:00:10", "10:00:59", "10:02:00") == []
    assert after("b.json", "10:30:00") == [2, 0, 1] + [0] * 17
    # 10:05 is final: its message is too late
    assert after("c.json", "10:33:30", "10:05:00", "10:32:00") == [2, 0, 1] + [0] * 20
    assert after("d.json", "10:50:00") == [2, 0, 1] + [0] * 27 + [1, 0, 1, 1] + [0] * 6


def test_models_train_after_an_observed_load(spark, sf_dir, tmp_path):
    tx = V.transactions(spark, sf_dir)
    source = str(tmp_path / "csv")
    tx.select(*[F.col(c) for c in CSV_SCHEMA.names]).write.option("header", True).csv(source)
    counts = run_etl(spark, source, str(tmp_path / "out")).first()
    assert counts.total_records == tx.count() == spark.read.parquet(str(tmp_path / "out")).count()
    train, test = split(tx)
    trained = R.train(train, "logistic_regression", maxIter=2)
    assert trained.model.stages[-1].summary.totalIterations >= 1
    assert trained.model.transform(test).where("prediction IN (0, 1)").count() == test.count()


def test_hot_entities_send_few_rows_to_the_state(spark):
    """Of each entity and Arrow batch the newest row goes on, ties by id; rows without a time stay."""
    rows = [(i, datetime(2024, 1, 1, 10, i * 7919 % 1000 // 20), "DEBIT", float(i), "AB"[i % 2]) for i in range(2000)]
    rows += [(2000, None, "DEBIT", 1.0, "A"), (2001, datetime(2024, 1, 1), "DEBIT", 1.0, None), (2002, datetime(2024, 1, 2), "DEBIT", 1.0, None)]
    events = spark.createDataFrame(rows, KIND).coalesce(1)
    found = newest_of_batches(events, "nameOrig", "ts", "tx_id").collect()
    newest = {who: max((r for r in rows if r[4] == who and r[1]), key=lambda r: (r[1], r[0]))[0] for who in ("A", "B", None)}
    assert sorted(r.tx_id for r in found) == sorted([*newest.values(), 2000])
    empty = newest_of_batches(events.where("false"), "nameOrig", "ts", "tx_id")
    assert empty.schema == events.schema and empty.count() == 0
