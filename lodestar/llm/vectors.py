"""Shared handling of vector columns: validity, distinct vectors, Arrow to numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_valid(vector: Column) -> Column:
    """Not null, not empty, no null or non-finite component, not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def main_dimension(vectors: DataFrame, vector: str) -> int | None:
    """The most frequent length (the larger of equally frequent ones); null if there is no vector."""
    sizes = vectors.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max(F.struct("n", "d"))["d"].alias("d")).first()["d"]


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dim)
