"""A log of stream runs: rows, batches, duration and failure of every query, as a table."""

from __future__ import annotations

from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = (
    "run_id string, name string, batches bigint, input_rows bigint, batch_millis bigint, "
    "watermark string, finished boolean, failed boolean, error string"
)


class RunLog(StreamingQueryListener):
    """One short entry for each run, updated by its progress; it does not grow with the rows."""

    def __init__(self) -> None:
        super().__init__()
        self._runs: dict[str, dict] = {}
        self._lock = Lock()

    def _entry(self, run_id) -> dict:
        plain = {"name": None, "batches": 0, "input_rows": 0, "batch_millis": 0, "watermark": None,
                 "finished": False, "failed": False, "error": None}
        return self._runs.setdefault(str(run_id), plain)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._entry(event.runId)["name"] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            entry = self._entry(progress.runId)
            entry["batches"] += 1
            entry["input_rows"] += progress.numInputRows
            entry["batch_millis"] += progress.batchDuration
            entry["watermark"] = progress.eventTime.get("watermark", entry["watermark"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            entry = self._entry(event.runId)
            entry["finished"], entry["failed"] = True, event.exception is not None
            entry["error"] = event.exception

    def table(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = [(run_id, *entry.values()) for run_id, entry in self._runs.items()]
        return spark.createDataFrame(rows, SCHEMA)


@contextmanager
def logged(spark: SparkSession):
    """A ``RunLog`` of the streams started inside the block."""
    log = RunLog()
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        # events arrive on a bus of their own; let it deliver those of finished queries
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(log)
