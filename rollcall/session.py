"""A session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "rollcall", master: str | None = None, shuffle_partitions: int | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """Adaptive execution, Arrow transfer and UTC; a cluster's own settings for the rest. checkpoint_dir must be shared by driver and executors."""
    builder = SparkSession.builder.appName(app)
    conf = {
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true", "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if checkpoint_dir:
        conf["spark.checkpoint.dir"] = checkpoint_dir
    for key, value in conf.items():
        builder = builder.config(key, value)
    return (builder.master(master) if master else builder).getOrCreate()
