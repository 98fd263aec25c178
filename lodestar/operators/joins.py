"""Joins and lookups.

A side is broadcast only where its row count is fixed by the job. Otherwise Spark decides: a side is
broadcast when its measured size is below the session's limit, and hot keys of the large side are
split by the adaptive skew join, because the other side holds one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_tables(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    return left.join(right, on if isinstance(on, str) else list(on), how)


def denormalise(
    mutation: DataFrame, local: DataFrame, parcelle: DataFrame, adresse: DataFrame, commune: DataFrame | None = None
) -> DataFrame:
    """Sales with premises, parcels, addresses and communes; every sale is kept."""
    out = (
        mutation.join(local, "idmutation", "left")
        .join(parcelle, ["idmutation", "iddispopar"], "left")
        .join(adresse, "iddispoloc", "left")
    )
    return out if commune is None else out.join(commune, "commune", "left")


def merge_predictions(df: DataFrame, per_tag: Mapping[str, DataFrame], key: str = "id") -> DataFrame:
    """One ``<tag>_pred`` column per frame ``(key, prediction)``, joined on the id."""
    out = df
    for tag, frame in per_tag.items():
        out = out.join(frame.select(F.col(key), F.col("prediction").alias(f"{tag}_pred")), key, "left")
    return out


def attach_counts(df: DataFrame, key: str, tests: Mapping[str, Column]) -> DataFrame:
    """Rows with one count per test over all rows of their key: one aggregate for all counts, one join."""
    counts = df.groupBy(key).agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return df.join(counts, key, "left")


def enrich(df: DataFrame, dim: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    return df.join(dim.select(on, *columns), on, "left")


def events_in_window(
    df: DataFrame, events: DataFrame, place: str, date: str, offsets: Sequence[int] = (0, 1, 2), name: str = "n_events"
) -> DataFrame:
    """Events at the same place 0, 1, 2 ... days earlier, summed per row; none is 0.

    ``events`` has the same place and date columns. Daily counts are shifted to the days on which they
    matter and added up, so one equality join is enough.
    """
    daily = events.groupBy(F.col(place).alias("_place"), F.to_date(date).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    shifted = daily.select("_place", "_n", F.col("_day"), F.explode(F.array(*[F.lit(o) for o in offsets])).alias("_o"))
    window = shifted.groupBy("_place", F.date_add("_day", F.col("_o")).alias("_on")).agg(F.sum("_n").alias(name))
    joined = df.join(window, (F.col(place) == F.col("_place")) & (F.to_date(date) == F.col("_on")), "left")
    return joined.select(*df.columns, F.coalesce(name, F.lit(0)).alias(name))


def align(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Outer alignment of two tables on a key; columns of a missing side are NULL."""
    return left.join(right, key, "full")


def add_aligned(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Sum of two series on their key; NULL where either side is missing."""
    both = align(left.select(key, F.col(value).alias("_l")), right.select(key, F.col(value).alias("_r")), key)
    return both.select(key, (F.col("_l") + F.col("_r")).alias(value))


def anti(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids, on, "left_anti")


def semi(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    return df.join(ids, on, "left_semi")
