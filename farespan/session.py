"""Spark settings the reports are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Run-time SQL settings.  Nothing here is needed for right results except the
# time zone; the rest is about how plans behave on large inputs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows dealt by passenger stay there for joins on passenger and segment or fee.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # What was shuffled for a staged frame is deleted as soon as the frame is written, not when the driver collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Larger defaults for a real cluster; a local run keeps Spark's own.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in {**RUNTIME_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "farespan", **conf: str) -> SparkSession:
    """A session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
