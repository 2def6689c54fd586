"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it sizes shuffle partitions from measured bytes,
# turns a shuffled join into a broadcast one only when the finished side is measured to be
# below the threshold, and splits a hot join partition over several tasks.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "shelfline", master: str | None = None, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; ``extra`` uses ``__`` for the dots of a setting name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {name.replace("__", "."): value for name, value in extra.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
