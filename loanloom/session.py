"""Spark settings for our own runs (bench, tests, scripts).

No operator depends on these for its result: they only pick cheaper plans.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (loan_id, …) may reuse data already partitioned by loan_id.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Small test data still fans out to all cores after a shuffle.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(
    app: str,
    cores: str | int = "*",
    shuffle_partitions: int = 8,
    memory: str = "8g",
    **extra: str,
) -> SparkSession:
    """A single-machine session with the settings above."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
