"""Session settings used by the tests, the benchmark and the examples."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split hot key is worth the extra shuffle it can cost further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session that the cluster has made."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int | None = None, memory: str = "12g") -> SparkSession:
    """A session on this machine; a cluster job brings its own session instead."""
    partitions = partitions or (os.cpu_count() or 8 if cores == "*" else int(cores))
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lodestar")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.lodestar.spreadTexts", "true")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
