"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks the join side to broadcast from run-time sizes, splits skewed
# join partitions and resizes write partitions; the plans in this package lean on it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Open a session with :data:`SETTINGS`; ``extra`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
