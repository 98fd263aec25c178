"""Sinks and stored results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, **options: str) -> None:
    df.write.mode("overwrite").options(**options).csv(path, header=header, sep=sep)


def cached(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False
) -> DataFrame:
    """Read the stored table if there is one, else compute, store and read it."""
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    write_table(build(), path)
    return spark.read.parquet(path)
