"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# No library expression depends on these: every function gives the same result in
# a session that someone else configured.  They only tune how the plans run.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites of single columns are not recorded; that slows large plans down.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app_name: str = "skillmill", master: str | None = None, **extra: str) -> SparkSession:
    """Session for jobs; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
