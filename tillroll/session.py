"""Session settings the reports rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan with real sizes, split skewed join partitions, merge small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A side is broadcast only while its estimate is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Scan tasks of one block; semi-join reduction for selective dimensions.
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Overflow and bad casts are errors, not NULL.
    "spark.sql.ansi.enabled": "true",
    # Do not record a Python call site for every column expression of these large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(app: str = "tillroll") -> "SparkSession.Builder":
    """A session builder with these settings.  The number of shuffle partitions is left to the
    cluster: about two to three per core at least, more where a shuffle exceeds the advisory size."""
    out = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out
