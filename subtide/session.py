"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Call-site capture for error messages costs a fifth of the time to build a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app_name: str = "subtide", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass your own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    settings = SETTINGS | {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
