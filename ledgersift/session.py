"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "ledgersift", **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_LOCAL_ROOTS: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there, one machine
    is the whole cluster.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="ledgersift-")
    return _LOCAL_ROOTS[context.applicationId]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never used twice."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
