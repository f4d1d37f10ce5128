"""Streams run to completion over the given tables and read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgersift.ml import train as R
from ledgersift.ml.prepare import split
from ledgersift.plans.catalog import query
from ledgersift.plans.sql import with_tables
from ledgersift.schema import TX_SCHEMA
from ledgersift.session import work_path
from ledgersift.sources import views as V
from ledgersift.streaming.minutes import every_minute
from ledgersift.streaming.runlog import logged
from ledgersift.streaming.scoring import alerts, minute_counts, score, with_stream_features
from ledgersift.streaming.sinks import feed_cache, read_cache, run_to_keyed_table, run_to_table
from ledgersift.streaming.sources import parse_messages
from ledgersift.streaming.state import read_cache_state, start_cache_state, state_store


def _messages(spark, sf_dir):
    """Transactions as JSON messages on a stream, parsed again."""
    tx = V.transactions_from(
        V.table_stream(spark, sf_dir, "orders"), V.table(spark, sf_dir, "customer")
    )
    raw = tx.select(F.to_json(F.struct(*tx.columns)).alias("value"))
    return parse_messages(raw, TX_SCHEMA)


_FEATURES = """CASE WHEN oldbalanceOrg > 0 THEN amount / oldbalanceOrg ELSE 0e0 END AS amount_ratio,
  oldbalanceOrg - newbalanceOrig AS balance_outflow_orig,
  newbalanceDest - oldbalanceDest AS balance_change_dest,
  CASE WHEN amount > 100000 THEN 1 ELSE 0 END AS is_large_amount"""


@query("stream_preprocess", with_tables(f"SELECT tx_id, {_FEATURES} FROM transactions", "transactions"))
def stream_preprocess(spark, sf_dir):
    stream = with_stream_features(_messages(spark, sf_dir)).select(
        "tx_id", "amount_ratio", "balance_outflow_orig", "balance_change_dest", "is_large_amount"
    )
    return run_to_table(spark, stream, "stream-features")


_SCORES = """SELECT tx_id, type, amount, CASE WHEN amount > 100000 THEN 0.8e0
  WHEN amount > 50000 THEN 0.5e0 ELSE 0.1e0 END AS fraud_probability,
  CASE WHEN amount > 100000 THEN 1e0 ELSE 0e0 END AS prediction FROM transactions"""


@query("stream_score", with_tables(_SCORES, "transactions"))
def stream_score(spark, sf_dir):
    scored = score(with_stream_features(_messages(spark, sf_dir))).select(
        "tx_id", "type", "amount", "fraud_probability", "prediction"
    )
    return run_to_table(spark, scored, "stream-scores")


@query(
    "stream_score_model",
    with_tables(
        """SELECT tx_id, type, amount, TRUE AS is_probability, TRUE AS prediction_follows
FROM transactions""",
        "transactions",
    ),
)
def stream_score_model(spark, sf_dir):
    """A saved model, loaded again, scores the stream."""
    train, _ = split(V.transactions(spark, sf_dir))
    path = work_path(spark, "stream-model")
    R.save_model(R.train(train, "decision_tree").model, path)
    p = F.col("fraud_probability")
    scored = score(_messages(spark, sf_dir), R.load_model(path)).select(
        "tx_id", "type", "amount", p.between(0.0, 1.0).alias("is_probability"),
        ((F.col("prediction") == 1.0) == (p > 0.5)).alias("prediction_follows"),
    )
    return run_to_table(spark, scored, "stream-model-scores")


@query("stream_alerts", with_tables(f"{_SCORES} WHERE amount > 100000", "transactions"))
def stream_alerts(spark, sf_dir):
    found = alerts(score(with_stream_features(_messages(spark, sf_dir)))).select(
        "tx_id", "type", "amount", "fraud_probability", "prediction"
    )
    return run_to_table(spark, found, "stream-alerts")


@query(
    "stream_minute_volume",
    with_tables(
        """SELECT date_trunc('minute', ts) AS minute, count(*) AS volume FROM tx_events
GROUP BY 1""",
        "tx_events",
    ),
)
def stream_minute_volume(spark, sf_dir):
    """All minutes, those that late messages may still change included."""
    events = V.transaction_events_from(V.table_stream(spark, sf_dir, "events"))
    minutes = run_to_keyed_table(spark, minute_counts(events, "ts"), "minute", "stream-minutes")
    return minutes.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query(
    "stream_every_minute",
    with_tables(
        """, _ends AS (SELECT date_trunc('minute', min(ts)) AS first, date_trunc('minute', max(ts) - INTERVAL 10 MINUTE) AS last FROM tx_events),
_spine AS (SELECT unnest(generate_series(first, last - INTERVAL 1 MINUTE, INTERVAL 1 MINUTE)) AS minute FROM _ends),
_counted AS (SELECT date_trunc('minute', ts) AS minute, count(*) AS n FROM tx_events GROUP BY 1)
SELECT minute, coalesce(n, 0) AS volume FROM _spine LEFT JOIN _counted USING (minute)""",
        "tx_events",
    ),
)
def stream_every_minute(spark, sf_dir):
    """The minutes that are final, from the first event to the watermark, empty ones included."""
    events = V.transaction_events_from(V.table_stream(spark, sf_dir, "events"))
    with state_store(spark):
        minutes = run_to_table(spark, every_minute(events, "ts"), "every-minute")
    return minutes.withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query(
    "stream_cache",
    with_tables(
        "SELECT cache_key, tx_id, type, amount, cached_at, expires_at FROM account_cache",
        "account_cache",
    ),
)
def stream_cache(spark, sf_dir):
    events = V.transaction_events_from(V.table_stream(spark, sf_dir, "events"))
    path = work_path(spark, "cache")
    feed_cache(events, path, work_path(spark, "cache-checkpoint"), once=True).await_all()
    return read_cache(spark, path)


@query(
    "stream_cache_state",
    with_tables(
        """SELECT cache_key, tx_id, type, amount, cached_at, expires_at FROM account_cache
WHERE expires_at > (SELECT max(ts) FROM tx_events) - INTERVAL 10 MINUTE""",
        "account_cache", "tx_events",
    ),
)
def stream_cache_state(spark, sf_dir):
    """Entries alive once the watermark, ten minutes behind the newest event, has removed the others."""
    events = V.transaction_events_from(V.table_stream(spark, sf_dir, "events"))
    checkpoint = work_path(spark, "cache-state")
    start_cache_state(events, work_path(spark, "expired"), checkpoint, once=True).await_all()
    live = read_cache_state(spark, checkpoint)
    return live.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("cached_at", "expires_at")})


def _broken(batch, batch_id):
    raise OSError("the sink is gone")


@query(
    "stream_run_log",
    with_tables(
        """SELECT 'alerts' AS name, count(*) AS input_rows, TRUE AS finished, FALSE AS failed, FALSE AS names_the_sink
FROM transactions UNION ALL SELECT 'broken', 0, TRUE, TRUE, TRUE""",
        "transactions",
    ),
)
def stream_run_log(spark, sf_dir):
    """What the log says of a finite stream, and of one whose sink fails."""
    orders = V.table_stream(spark, sf_dir, "orders")
    with logged(spark) as log:
        for name, sink in (("alerts", lambda batch, batch_id: batch.write.format("noop").mode("append").save()), ("broken", _broken)):
            writer = orders.writeStream.foreachBatch(sink).queryName(name).trigger(availableNow=True)
            started = writer.option("checkpointLocation", work_path(spark, f"log-{name}")).start()
            try:
                started.awaitTermination()
            except StreamingQueryException:
                pass  # the log tells it
    return log.table(spark).select(
        "name", "input_rows", "finished", "failed", F.coalesce(F.col("error").contains("the sink is gone"), F.lit(False)).alias("names_the_sink")
    )
