"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on disk rather than on the heap: it has one row per key.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Checkpoints written between iterations are removed once their DataFrame is collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "tallyforge", master: str | None = None, **settings: str
) -> SparkSession:
    """Create (or get) a session; ``settings`` keys use ``__`` for dots, and win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    merged = {**DEFAULTS, **{k.replace("__", "."): v for k, v in settings.items()}}
    for key, value in merged.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
