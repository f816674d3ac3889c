"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "tidefare", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keyword settings use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`.

    Only a local-mode session may do without it; it then gets one temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tidefare-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
