"""Named queries over the given tables, each with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestar.sources.readers import read_table

# tables of long texts: a session on one machine may ask to spread the one row group of a small file (see session.py)
WIDE_TEXT = ("documents", "pages")
SPREAD = "spark.lodestar.spreadTexts"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        spread = name in WIDE_TEXT and self.spark.conf.get(SPREAD, "false") == "true"
        return read_table(self.spark, f"{self.folder}/{name}.parquet", spread=spread)


def query(name: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under a name, with its SQL where one exists."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
