"""Session settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Splits an oversized join partition (one hot client, transaction or session).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods above 8000 bytes; generated code that large would run
    # interpreted, so such a stage falls back to projections that Spark splits up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets the `rebalance` hint of the sinks cut a hot day into several files.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
