"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a default of the engine or a runtime re-planning switch. Partition counts are left
# to adaptive execution, so the same code runs on eight cores and on a cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "almanac", master: str | None = None, **extra: str) -> SparkSession:
    """Return a session with the settings above; ``extra`` uses ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
