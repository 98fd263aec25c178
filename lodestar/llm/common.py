"""Small helpers shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestar.operators.scaling import checkpoint_folder


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def store(df: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back, so that later steps (and tasks that
    run again after an executor was lost) start from files."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/lodestar-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")
