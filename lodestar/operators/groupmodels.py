"""Iterated fits of one model per group, all groups at once: logistic and Huber regression.

The state is one row per group with its coefficients. A round joins the rows of the groups that are not finished with their state
(salted, so a group with a third of all rows is spread over the cluster), adds up each row's weighted cross products and loss, and
solves one small system per group in Python. A group is finished when its step is within the tolerance; the loop
ends when all are. A step that does not lower a group's loss is halved, so every fit descends.

Rows with a null among key, features and label take no part. Each loss has a ridge term on the coefficients (not the intercept)
that keeps separable groups finite; a group whose system is singular gets the shortest solution.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.models import per_group_models
from lodestar.operators.scaling import Rounds, exact_median, hot_keys, materialise, salted_lookup

HALVINGS = 30
_MAD = 0.6744897501960817  # fixed value: the upper quartile of the standard normal distribution


def _design(features: Sequence[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(f).cast("double") for f in features]]


def _products(x: list[Column], weight: Column, work: Column) -> list[Column]:
    """Sums of ``weight * x x'`` (upper half) and ``x * work``."""
    p = len(x)
    square = F.array(*[F.sum(weight * x[i] * x[j]) for i in range(p) for j in range(i, p)])
    return [square.alias("_xx"), F.array(*[F.sum(x[i] * work) for i in range(p)]).alias("_xw")]


def _newton(rows: DataFrame, key: str, features: Sequence[str], start: DataFrame, terms, ridge: float, tol: float) -> DataFrame:
    """``key, n, coefficients, loss, rounds``; ``terms(eta)`` gives a row's loss, weight and derivative of the loss by ``-eta``."""
    p = len(features) + 1
    upper = np.triu_indices(p)
    penalty = np.r_[0.0, np.full(p - 1, ridge)]
    schema = "beta array<double>, held array<double>, best double, halved int, open boolean"

    @F.pandas_udf(schema)
    def advance(beta: pd.Series, held: pd.Series, best: pd.Series, halved: pd.Series, xx: pd.Series, xw: pd.Series, loss: pd.Series) -> pd.DataFrame:
        out = []
        for b, h, low, half, square, work, value in zip(beta, held, best, halved, xx, xw, loss):
            b, h = np.asarray(b, float), np.asarray(h, float)
            value = value + 0.5 * float((penalty * b * b).sum())
            if not np.isfinite(value) or value > low + 1e-12 * abs(low):  # worse than the last accepted point
                if half >= HALVINGS:
                    out.append((h, h, low, half, False))
                else:
                    out.append(((b + h) / 2, h, low, half + 1, True))
                continue
            m = np.zeros((p, p))
            m[upper] = square
            m = m + np.triu(m, 1).T + np.diag(penalty)
            step = np.linalg.lstsq(m, np.asarray(work, float) - penalty * b, rcond=None)[0]
            # near the end the loss changes by the square of the step; the last step is still taken
            small = float(np.abs(step).max()) <= tol * (1 + float(np.abs(b).max())) or low - value <= 1e-13 * (1 + abs(value))
            out.append((b + step, b, value, 0, not small))
        return pd.DataFrame(out, columns=["beta", "held", "best", "halved", "open"])

    x = _design(features)
    eta = sum((F.get("beta", F.lit(i)) * x[i] for i in range(1, p)), F.get("beta", F.lit(0)))
    loss, weight, work = terms(eta)
    rounds = Rounds(rows.sparkSession)
    state = rounds.store(
        start.select(
            key, *[c for c in start.columns if c not in (key, "beta")], "beta", F.col("beta").alias("held"),
            F.lit(float("inf")).alias("best"), F.lit(0).alias("halved"), F.lit(True).alias("open"), F.lit(0).alias("rounds"),
        )
    )
    fixed = [c for c in start.columns if c not in (key, "beta")]
    hot = hot_keys(rows, [key])
    while not state.where("open").isEmpty():
        asked = state.where("open").select(key, *fixed, "beta")
        sums = salted_lookup(rows, asked, [key], hot).groupBy(key).agg(*_products(x, weight, work), F.sum(loss).alias("_loss"))
        moved = state.join(sums, key, "left").select(
            key, *fixed, "beta", "held", "best", "halved", "open", "rounds",
            F.when(F.col("open"), advance("beta", "held", "best", "halved", "_xx", "_xw", "_loss")).alias("_s"),
        )
        pick = lambda c: F.when(F.col("open"), F.col(f"_s.{c}")).otherwise(F.col(c)).alias(c)
        state = rounds.store(
            moved.select(
                key, *fixed, pick("beta"), pick("held"), pick("best"), pick("halved"), pick("open"),
                (F.col("rounds") + F.col("open").cast("int")).alias("rounds"),
            )
        )
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    done = materialise(state)
    return done.join(counts, key).select(key, "n", F.col("beta").alias("coefficients"), F.col("best").alias("loss"), "rounds")


def _rows(df: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    kept = df.na.drop(subset=[key, *features, label])
    return materialise(kept.select(key, *features, F.col(label).cast("double").alias("_y")))


def logistic_per_group(
    df: DataFrame, key: str, features: Sequence[str], label: str, ridge: float = 1e-6, tol: float = 1e-9
) -> DataFrame:
    """Logistic regression of a 0/1 label per group: ``key, n, coefficients, loss, rounds`` (intercept first)."""
    rows = _rows(df, key, features, label)
    y = F.col("_y")

    def terms(eta: Column) -> tuple[Column, Column, Column]:
        chance = 1 / (1 + F.exp(-eta))
        loss = F.greatest(eta, F.lit(0.0)) + F.log1p(F.exp(-F.abs(eta))) - y * eta
        return loss, chance * (1 - chance), y - chance

    zeros = F.array_repeat(F.lit(0.0), len(features) + 1)
    start = rows.select(key).distinct().withColumn("beta", zeros)
    return _newton(rows, key, features, start, terms, ridge, tol)


def huber_per_group(
    df: DataFrame, key: str, features: Sequence[str], label: str, epsilon: float = 1.35, ridge: float = 0.0, tol: float = 1e-8
) -> DataFrame:
    """Huber regression per group: squares up to ``epsilon`` times the group's scale, absolute values beyond.

    The scale is the median absolute residual of the group's least squares fit over that of a normal distribution; the fit starts
    there. A group whose scale is 0 keeps its least squares fit."""
    rows = _rows(df, key, features, label)
    x = _design(features)
    first = materialise(per_group_models(rows, key, features, "_y", ridge=0.0).select(key, F.col("coefficients").alias("beta")))
    eta = sum((F.get("beta", F.lit(i)) * x[i] for i in range(1, len(x))), F.get("beta", F.lit(0)))
    residuals = salted_lookup(rows, first, [key]).select(key, F.abs(F.col("_y") - eta).alias("_r"))
    scale = exact_median(residuals, "_r", [key]).select(key, (F.col("median") / _MAD * epsilon).alias("_knee"))
    start = materialise(first.join(scale, key))
    y, knee = F.col("_y"), F.col("_knee")

    def terms(eta: Column) -> tuple[Column, Column, Column]:
        r = y - eta
        far = F.abs(r) > knee
        loss = F.when(far, knee * F.abs(r) - knee * knee / 2).otherwise(r * r / 2)
        # beyond the knee the loss has no curvature; a little keeps the system solvable
        return loss, F.when(far, 0.05 * knee / F.abs(r)).otherwise(1.0), F.when(far, knee * F.signum(r)).otherwise(r)

    fitted = _newton(rows, key, features, start.where("_knee > 0"), terms, ridge, tol)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    exact = start.where("_knee = 0").join(counts, key).select(
        key, "n", F.col("beta").alias("coefficients"), F.lit(0.0).alias("loss"), F.lit(0).alias("rounds")
    )
    return fitted.unionByName(exact)


def score_groups(df: DataFrame, models: DataFrame, key: str, features: Sequence[str], link: str = "linear") -> DataFrame:
    """The rows of modelled groups with ``prediction``: the linear value, or with ``logistic`` the chance of a 1."""
    x = _design(features)
    eta = sum((F.get("coefficients", F.lit(i)) * x[i] for i in range(1, len(x))), F.get("coefficients", F.lit(0)))
    placed = salted_lookup(df, models.select(key, "coefficients"), [key])
    value = 1 / (1 + F.exp(-eta)) if link == "logistic" else eta
    return placed.withColumn("prediction", value).select(*df.columns, "prediction")
