"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected on a few random directions, several times, and each projection is shifted and
ordered along a Hilbert curve. Each curve is range-partitioned into cells of equal row counts (bounds from
mergeable quantile sketches); a query meets the rows of its own cell and of as many cells on each side as make up
``share`` of all cells. The candidates of all curves are merged and ranked by the exact inner product.

Inner products are turned into distances by one more coordinate, ``sqrt(M^2 - |x|^2)``, so that vectors of any
length can be ordered. Equal vectors are one entry with its ``k + 1`` smallest ids, so a vector that fills a
third of the table costs one row and ties go to the smaller ids exactly.

``cells`` is the number of ranges per curve: 16, more once a range would exceed ``cell_rows`` rows, and fewer where a range
would hold less than ``k + 1`` rows. The share of rows a query meets buys recall, so it stays the same however many
ranges there are: ``window`` cells on each side of 16, in proportion of more. The queries that meet a range are divided by a hash
into slices of about ``cell_rows``, each beside a copy of the range, so that a task holds two bounded parts. Vectors without
any cluster structure need a large share (the README has measured figures).

Defined results: vectors that are null, empty, zero, hold null or non-finite components, have another length
than most vectors, or have a null id take no part; a repeated row counts once; fewer than ``k`` candidates give
fewer rows; no valid query gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import store
from lodestar.llm.vectors import is_valid, main_dimension, matrix

CURVES = 9
DIMS = 4
BITS = 8
CELLS = 16
WINDOW = 1
CELL_ROWS = 16_384
_TIE_BITS = 30


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions of integer grid points (rows) along the Hilbert curve of their dimension.

    Works on whole columns: per bit plane, from the highest, coordinates are reflected or exchanged with the
    first one, then the Gray code is undone and the bits are interleaved.
    """
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    for plane in range(bits - 1, 0, -1):
        bit, low = np.int64(1) << plane, (np.int64(1) << plane) - 1
        for i, axis in enumerate(axes):
            is_set = (axis & bit) != 0
            swap = np.where(is_set, 0, (axes[0] ^ axis) & low)
            axes[0] = np.where(is_set, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axis ^ swap
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(axes[0])
    for plane in range(bits - 1, 0, -1):
        flip = np.where(axes[-1] & (np.int64(1) << plane), flip ^ ((np.int64(1) << plane) - 1), flip)
    index = np.zeros_like(axes[0])
    for plane in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ flip) >> plane) & 1)
    return index


class Curves:
    """Random projections and shifts of the curves; the same for the same seed."""

    def __init__(self, dim: int, largest: float, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        dims = min(dims, dim + 1)
        self.largest, self.bits = largest, bits
        self.directions = [np.linalg.qr(rng.normal(size=(dim + 1, dims)))[0] for _ in range(curves)]
        self.shifts = rng.uniform(0.0, 1.0, size=(curves, dims))
        # projections of vectors of length M have a spread of about M / sqrt(dim); outer points are clipped
        self.reach = 4.0 * largest / math.sqrt(dim + 1)

    def lifted(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        norms = np.sqrt((x * x).sum(axis=1))
        if as_query:
            return np.column_stack([x * (self.largest / norms)[:, None], np.zeros(len(x))])
        return np.column_stack([x, np.sqrt(np.maximum(self.largest**2 - norms**2, 0.0))])

    def keys(self, curve: int, lifted: np.ndarray) -> np.ndarray:
        place = (lifted @ self.directions[curve] / self.reach + 1.0) / 2.0
        top = (1 << self.bits) - 1
        grid = np.clip((np.clip(place, 0.0, 1.0) + self.shifts[curve]) / 2.0 * (top + 1), 0, top)
        return hilbert_index(grid.astype(np.int64), self.bits)


def _tie_break(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TIE_BITS)
    return (keys << _TIE_BITS) | mixed.astype(np.int64)


def window_of(cells: int, window: int = WINDOW, of: int = CELLS) -> int:
    """Cells on each side that a query meets: never a smaller share of all cells than ``window`` on each side of ``of``."""
    return window if cells <= of else math.ceil(((2 * window + 1) * cells / of - 1) / 2)


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``vector, ids``: the ``keep`` smallest ids per vector; Spark cuts to them before the shuffle."""
    first = Window.partitionBy("vector").orderBy("vec_id")
    return (
        rows.withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= keep)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("entry"), "ids", "vector")
    )


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    curves: int = CURVES,
    dims: int = DIMS,
    bits: int = BITS,
    cells: int = CELLS,
    window: int = WINDOW,
    cell_rows: int = CELL_ROWS,
    seed: int = 17,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vectors(vec_id, vector)`` that satisfy ``queries``."""
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    given = vectors.select("vec_id", "vector", F.coalesce(queries, F.lit(False)).alias("asks"))
    valid = given.where(F.col("vec_id").isNotNull() & is_valid(F.col("vector")))
    dim = main_dimension(valid, "vector")
    if dim is None:
        return spark.createDataFrame([], empty)
    valid = valid.where(F.size("vector") == dim).distinct()
    entries = store(distinct_vectors(valid.select("vec_id", "vector"), k + 1))
    asking = store(
        valid.where("asks").join(entries.select("entry", "vector"), "vector").select(F.col("vec_id").alias("query_id"), "entry")
    )
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = entries.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(square)).alias("m")).first()
    least = cells
    cells = max(1, min(max(cells, math.ceil(sizes["n"] / cell_rows)), sizes["n"] // (k + 1)))
    window = window_of(cells, window, least)
    plan = Curves(dim, sizes["m"], curves, dims, bits, seed)

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("entry").to_numpy()
            lifted = plan.lifted(matrix(batch.column("vector"), dim), as_query=False)
            keys = [_tie_break(plan.keys(c, lifted), ids) for c in range(curves)]
            yield pa.RecordBatch.from_pydict(
                {"curve": np.repeat(np.arange(curves, dtype=np.int32), len(ids)), "key": np.concatenate(keys)}
            )

    marks = [i / cells for i in range(1, cells)]
    bounds = np.full((curves, cells - 1), np.iinfo(np.int64).max)
    if marks:
        sketch = entries.select("entry", "vector").mapInArrow(key_rows, "curve int, key long")
        found = sketch.groupBy("curve").agg(F.percentile_approx("key", marks, max(10_000, 20 * cells)).alias("b"))
        for row in found.collect():  # curves x cells numbers
            bounds[row["curve"]] = row["b"]

    def near(c: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells that queries meet, and the queries' positions."""
        at = np.searchsorted(bounds[c], keys, side="left")
        # cells at the ends see as many cells as the others
        centre = np.clip(at, min(window, cells - 1), max(cells - 1 - window, 0))
        met = centre[:, None] + np.arange(-window, window + 1)[None, :]
        row, col = np.nonzero((met >= 0) & (met < cells))
        return met[row, col], row

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries per cell, one sum per task."""
        total = np.zeros((curves, cells), np.int64)
        for batch in batches:
            ids = batch.column("entry").to_numpy()
            lifted = plan.lifted(matrix(batch.column("vector"), dim), as_query=True)
            for c in range(curves):
                total[c] += np.bincount(near(c, _tie_break(plan.keys(c, lifted), ids))[0], minlength=cells)
        curve, cell = np.nonzero(total)
        yield pa.RecordBatch.from_pydict(
            {"curve": pa.array(curve, pa.int32()), "cell": pa.array(cell, pa.int32()), "n": pa.array(total[curve, cell])}
        )

    asked = store(entries.join(asking.select("entry").distinct(), "entry").select("entry", "vector"))
    slices = np.zeros((curves, cells), np.int64)  # none where nobody asks
    for row in asked.mapInArrow(load, "curve int, cell int, n long").groupBy("curve", "cell").agg(F.sum("n").alias("n")).collect():
        slices[row["curve"], row["cell"]] = math.ceil(row["n"] / cell_rows)

    def place(batches: Iterator[pa.RecordBatch], as_query: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("entry").to_numpy()
            lifted = plan.lifted(matrix(batch.column("vector"), dim), as_query)
            for c in range(curves):
                keys = _tie_break(plan.keys(c, lifted), ids)
                if as_query:
                    at, take = near(c, keys)
                    part = _tie_break(np.zeros_like(ids), ids)[take] % slices[c, at]
                else:
                    at = np.searchsorted(bounds[c], keys, side="left")
                    copies = slices[c, at]
                    take = np.repeat(np.arange(len(ids)), copies)
                    part = np.arange(len(take)) - np.repeat(np.cumsum(copies) - copies, copies)
                    at = at[take]
                yield pa.RecordBatch.from_pydict(
                    {
                        "curve": pa.array(np.full(len(at), c, np.int32)),
                        "cell": pa.array(at.astype(np.int32)),
                        "slice": pa.array(part.astype(np.int32)),
                        "asks": pa.array(np.full(len(at), as_query)),
                        "entry": pa.array(ids[take]),
                        "vector": batch.column("vector").take(pa.array(take)),
                    }
                )

    kind = entries.schema["vector"].dataType.simpleString()
    schema = f"curve int, cell int, slice int, asks boolean, entry long, vector {kind}"
    placed = (
        entries.select("entry", "vector")
        .mapInArrow(lambda b: place(b, False), schema)
        .unionByName(asked.mapInArrow(lambda b: place(b, True), schema))
    )

    def rank_cell(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("entry").to_numpy()
        x = matrix(table.column("vector"), dim)
        q, b, q_ids, b_ids = x[asks], x[~asks], ids[asks], ids[~asks]
        out_q, out_b, out_s = [], [], []
        most = min(k + 1, len(b))
        for start in range(0, len(q) if most else 0, 256):
            part = q[start : start + 256]
            scores = part @ b.T
            top = np.argpartition(-scores, most - 1, axis=1)[:, :most] if most < len(b) else np.tile(np.arange(len(b)), (len(part), 1))
            out_q.append(np.repeat(q_ids[start : start + 256], most))
            out_b.append(b_ids[top].ravel())
            # the products of one pair are always summed alike, in whichever cell they met
            out_s.append((part[:, None, :] * b[top]).sum(axis=2).ravel())
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return pa.table({"asked": cat(out_q, np.int64), "entry": cat(out_b, np.int64), "score": cat(out_s, np.float64)})

    met = placed.groupBy("curve", "cell", "slice").applyInArrow(rank_cell, "asked long, entry long, score double")
    merged = met.groupBy("asked", "entry").agg(F.max("score").alias("score"))
    best = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc("entry"))
    some = merged.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1).drop("at")
    by_id = Window.partitionBy("asked").orderBy(F.desc("score"), F.asc("vec_id"))
    spread = (
        some.join(entries.select("entry", "ids"), "entry")
        .select("asked", "score", F.explode("ids").alias("vec_id"))
        .withColumn("at", F.row_number().over(by_id))
        .where(F.col("at") <= k + 1)
    )
    own = Window.partitionBy("query_id").orderBy("at")
    return (
        asking.join(spread, F.col("asked") == asking["entry"])
        .where(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(own))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
