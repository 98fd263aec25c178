"""Linear models that tolerate outliers: consensus of random hypotheses (RANSAC) and Theil-Sen.

Both draw small random subsets of rows, the same for the same keys and seed, and fit each exactly. The subsets are a fixed number,
a parameter of the method, so they are solved in one place; whatever looks at all rows is one distributed pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import key_hash
from lodestar.operators.models import per_group_models
from lodestar.operators.scaling import exact_median, materialise

HYPOTHESES = 100
SUBSETS = 10_000


def _numbers(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str]) -> DataFrame:
    kept = df.na.drop(subset=[*features, label])
    x = F.array(F.lit(1.0), *[F.col(f).cast("double") for f in features])
    return materialise(kept.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], x.alias("x"), F.col(label).cast("double").alias("y")))


def _subsets(rows: DataFrame, n_keys: int, count: int, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``count`` subsets of ``size`` different rows each: the rows with the smallest hashes, dealt out in hash order.

    A table that is too small for that is in hand by then; it is shuffled and dealt again until there are enough."""
    keys = [f"_k{i}" for i in range(n_keys)]
    some = rows.select("x", "y", key_hash(keys, seed).alias("h")).orderBy("h", "x", "y").limit(count * size).collect()
    x, y = np.array([r["x"] for r in some]).reshape(len(some), -1), np.array([r["y"] for r in some])
    dealt = len(some) // size
    if not dealt:
        return np.zeros((0, size, size)), np.zeros((0, size))
    rng, orders = np.random.default_rng(seed), [np.arange(dealt * size)]
    while len(orders) * dealt < count:
        orders.append(rng.permutation(len(some))[: dealt * size])
    order = np.concatenate(orders)[: count * size].reshape(-1, size)
    return x[order], y[order]


def _fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of each subset that determines them."""
    scale = np.abs(x).max(axis=1, keepdims=True)
    whole = np.linalg.cond(x / np.where(scale == 0, 1, scale)) < 1e12
    if not whole.any():
        return np.zeros((0, x.shape[2]))
    return np.linalg.solve(x[whole], y[whole][:, :, None])[:, :, 0]


def ransac(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], hypotheses: int = HYPOTHESES,
    threshold: float | None = None, seed: int = 42,
) -> tuple[list[float], float, DataFrame]:
    """``(coefficients, threshold, inliers)``: least squares on the rows within ``threshold`` of the best hypothesis.

    The best has the most such rows, then the smallest sum of their residuals; all are judged in one pass. Without a threshold it is
    the median absolute deviation of the label. The inliers are the rows without a null among features and label, with
    ``residual``. A table with fewer rows than coefficients gives no coefficients and no inliers."""
    rows = _numbers(df, features, label, keys)
    p = len(features) + 1
    if threshold is None:
        middle = exact_median(rows, "y").first()["median"]
        spread = exact_median(rows.select(F.abs(F.col("y") - F.lit(middle)).alias("y")), "y").first()["median"]
        threshold = float(spread or 0.0)
    tried = _fits(*_subsets(rows, len(keys), hypotheses, p, seed))
    named = df.withColumn("residual", F.lit(None).cast("double"))
    if not len(tried):
        return [], threshold, named.limit(0)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, error = np.zeros(len(tried), np.int64), np.zeros(len(tried))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, p)
            y = batch.column("y").to_numpy()
            for start in range(0, len(y), 4096):
                part = slice(start, start + 4096)
                off = np.abs(y[part, None] - x[part] @ tried.T)
                inside = off <= threshold
                count += inside.sum(axis=0)
                error += np.where(inside, off, 0.0).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"h": pa.array(np.arange(len(tried)), pa.int32()), "n": count, "e": error})

    votes = rows.select("x", "y").mapInArrow(judge, "h int, n long, e double").groupBy("h").agg(F.sum("n").alias("n"), F.sum("e").alias("e"))
    best = votes.agg(F.max_by("h", F.struct("n", -F.round("e", 9), -F.col("h"))).alias("h")).first()["h"]

    def residual(beta: Sequence[float]):
        value = sum((F.lit(float(b)) * F.col(f).cast("double") for b, f in zip(beta[1:], features)), F.lit(float(beta[0])))
        return F.col(label).cast("double") - value

    inliers = df.na.drop(subset=[*features, label]).withColumn("residual", residual(tried[best])).where(F.abs("residual") <= threshold)
    fitted = per_group_models(inliers.withColumn("_all", F.lit(1)), "_all", features, label, ridge=0.0).first()
    beta = [float(b) for b in fitted["coefficients"]]
    return beta, threshold, inliers.withColumn("residual", residual(beta))


def spatial_median(points: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """The point with the smallest sum of distances; every coordinate is first put on its own scale."""
    centre = np.median(points, axis=0)
    scale = np.median(np.abs(points - centre), axis=0)
    scale[scale == 0] = 1.0
    x = (points - centre) / scale
    at = np.zeros(x.shape[1])
    for _ in range(10_000):
        far = np.sqrt(((x - at) ** 2).sum(axis=1))
        here = far < 1e-14
        weight = 1 / np.where(here, 1.0, far)
        weight[here] = 0.0
        total = weight.sum()
        if total == 0:
            break
        mean = (weight[:, None] * x).sum(axis=0) / total
        pull = float(np.sqrt((((x - at) * weight[:, None]).sum(axis=0) ** 2).sum()))
        if here.any() and pull <= here.sum():  # the point itself is the median
            break
        step = mean if not here.any() else at + (1 - here.sum() / pull) * (mean - at)
        moved = float(np.abs(step - at).max())
        at = step
        if moved <= tol:
            break
    return at * scale + centre


def theil_sen(
    df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], subsets: int = SUBSETS, seed: int = 42
) -> list[float]:
    """Coefficients (intercept first): the spatial median of the exact fits of ``subsets`` random subsets, each of as many rows as
    there are coefficients. Rows with a null take no part; a table with fewer rows gives no coefficients."""
    rows = _numbers(df, features, label, keys)
    fits = _fits(*_subsets(rows, len(keys), subsets, len(features) + 1, seed))
    return [float(v) for v in spatial_median(fits)] if len(fits) else []
