"""Session settings the marts are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings: skewed join partitions are split by AQE even where that needs one more
# shuffle, timestamps carry no zone of their own, and small sides are chosen by measured size.
# Rows that lie together by one key of a join stay where they are, as they do for a group (``joins.found_for``).
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark

