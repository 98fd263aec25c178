"""Boosted regression trees that grow leaf by leaf on quantile bins (squared loss).

Features are cut into at most ``bins`` bins at sketched quantiles once. A tree grows at the leaf whose best split lowers the loss
most. Its statistics are a histogram per feature (rows and residuals per bin): tasks add up the rows of the leaf in numpy and send
one small table each, whatever the number of rows. A pass reads the children of all leaves that may be cut next; of two
children only the smaller is read, and the histogram of the other is the parent's less it. The driver holds the histograms of the
open leaves and their children: leaves x features x bins numbers.

Rows with the same bins are never told apart, so they are one stored row from the start: their number and the sum of their
residuals, which are stored once per tree. Rows with a null label take no part; a null or not-a-number feature goes to the left of every
split. Of equal gains the smaller feature number, then the smaller bin wins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.scaling import Rounds, materialise


@dataclass
class Leaf:
    path: list[tuple[int, int, bool]]  # feature, last bin on the left, whether this is the left side
    rows: np.ndarray  # per feature and bin
    sums: np.ndarray
    value: float = 0.0
    sides: list[Leaf] | None = None  # left and right of its best cut, once they are known


@dataclass
class Split:
    feature: int
    edge: float
    left: Split | float
    right: Split | float


@dataclass
class Boosted:
    features: list[str]
    base: float
    trees: list[Split | float] = field(default_factory=list)

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        def value(node: Split | float) -> Column:
            if not isinstance(node, Split):
                return F.lit(float(node))
            x = F.col(self.features[node.feature]).cast("double")
            # null and not a number are not above the edge
            return F.when((x > node.edge) & ~F.isnan(x), value(node.right)).otherwise(value(node.left))

        return df.withColumn(name, sum((value(t) for t in self.trees), F.lit(float(self.base))))


def best_split(leaf: Leaf, least_rows: int, ridge: float) -> tuple[float, int, int] | None:
    """``(gain, feature, bin)`` of the best cut, which sends bins up to ``bin`` to the left; none if no cut gains."""
    n, s = leaf.rows.cumsum(axis=1)[:, :-1], leaf.sums.cumsum(axis=1)[:, :-1]
    total, whole = leaf.rows[0].sum(), leaf.sums[0].sum()
    score = lambda s, n: s * s / np.maximum(n + ridge, 1e-300)
    gain = score(s, n) + score(whole - s, total - n) - score(whole, total)
    gain[(n < least_rows) | (total - n < least_rows)] = -np.inf
    at = int(gain.argmax()) if gain.size else 0
    if not gain.size or not gain.flat[at] > 1e-9 * max(1.0, abs(score(whole, total))):
        return None
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def _within(path: list[tuple[int, int, bool]]) -> Column:
    tests = [F.col(f"b{f}") <= b if left else F.col(f"b{f}") > b for f, b, left in path]
    return sum((t.cast("int") for t in tests), F.lit(0)) == len(tests)


def _histograms(rows: DataFrame, paths: list[list], p: int, bins: int) -> list[Leaf]:
    """The leaves at the ends of disjoint paths, from one pass over ``rows(r, b0..)``, or ``rows(n, r, b0..)`` for n rows whose residuals
    add up to r."""
    shape = (len(paths), p, bins)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(shape, np.int64), np.zeros(shape)
        for batch in batches:
            r, w, leaf = batch.column("r").to_numpy(), batch.column("n").to_numpy(), batch.column("leaf").to_numpy().astype(np.int64)
            for f in range(p):
                cell = leaf * bins + batch.column(f"b{f}").to_numpy()
                # exact: sums of whole numbers below 2^53
                n[:, f] += np.bincount(cell, weights=w, minlength=len(paths) * bins).reshape(-1, bins).astype(np.int64)
                s[:, f] += np.bincount(cell, weights=r, minlength=len(paths) * bins).reshape(-1, bins)
        yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(n.size), pa.int32()), "n": n.ravel(), "s": s.ravel()})

    which = F.coalesce(*[F.when(_within(path), F.lit(i)) for i, path in enumerate(paths)])
    times = F.col("n") if "n" in rows.columns else F.lit(1).cast("long")
    own = rows.select("r", times.alias("n"), *[f"b{f}" for f in range(p)], which.alias("leaf")).where("leaf IS NOT NULL")
    sums = own.mapInArrow(add, "at int, n long, s double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    n, s = np.zeros(shape, np.int64), np.zeros(shape)
    for row in sums.collect():  # leaves x features x bins numbers
        n.flat[row["at"]], s.flat[row["at"]] = row["n"], row["s"]
    return [Leaf(path, n[i], s[i]) for i, path in enumerate(paths)]


def _divide(rows: DataFrame, parts: list[tuple[Leaf, int, int]], p: int, bins: int) -> None:
    """Both sides of leaves at their cuts: the smaller sides are read in one pass, the larger ones are what they lack."""
    few_left = [2 * leaf.rows[feature, : last + 1].sum() <= leaf.rows[feature].sum() for leaf, feature, last in parts]
    paths = [[*leaf.path, (feature, last, bool(few))] for (leaf, feature, last), few in zip(parts, few_left)]
    for (leaf, feature, last), few, small in zip(parts, few_left, _histograms(rows, paths, p, bins)):
        large = Leaf([*leaf.path, (feature, last, not few)], leaf.rows - small.rows, leaf.sums - small.sums)
        leaf.sides = [small, large] if few else [large, small]


def grow(rows: DataFrame, p: int, bins: int, leaves: int, least_rows: int, ridge: float) -> list[Leaf]:
    """The leaves of one tree on ``rows(r, b0..)``, with their mean residual as value.

    Any of the best cuts of the open leaves, as many as are left to make, may be among the next, so a pass reads the sides of all
    of them: a tree takes about as many passes as it is deep."""
    open_ = _histograms(rows, [[]], p, bins)
    while len(open_) < leaves:
        found = [(best_split(leaf, least_rows, ridge), i) for i, leaf in enumerate(open_)]
        able = sorted((-cut[0], i, cut[1], cut[2]) for cut, i in found if cut)
        if not able:
            break
        at = able[0][1]
        if open_[at].sides is None:
            next_ = able[: leaves - len(open_)]
            _divide(rows, [(open_[i], feature, last) for _, i, feature, last in next_ if open_[i].sides is None], p, bins)
        open_[at : at + 1] = open_[at].sides
    for leaf in open_:
        leaf.value = float(leaf.sums[0].sum() / max(leaf.rows[0].sum() + ridge, 1e-300))
    return open_


def _tree(leaves: list[Leaf], edges: list[np.ndarray], rate: float, depth: int = 0) -> Split | float:
    if len(leaves) == 1:
        return leaves[0].value * rate
    feature, last, _ = leaves[0].path[depth]
    sides = [[leaf for leaf in leaves if leaf.path[depth][2] == left] for left in (True, False)]
    return Split(feature, float(edges[feature][last]), *[_tree(side, edges, rate, depth + 1) for side in sides])


def fit_leafwise(
    df: DataFrame, features: Sequence[str], label: str, trees: int = 20, leaves: int = 15, bins: int = 64, rate: float = 0.1,
    least_rows: int = 20, ridge: float = 0.0,
) -> Boosted:
    """A model whose start is the mean label; each tree adds ``rate`` times the mean residual of a row's leaf. Without a
    ridge the predictions keep the mean of the label."""
    x = [F.col(f).cast("double") for f in features]
    known = df.where(F.col(label).isNotNull())
    p, marks = len(features), [i / bins for i in range(1, bins)]
    number = [F.when(~F.isnan(v), v) for v in x]
    first = known.agg(F.avg(F.col(label).cast("double")).alias("base"), *[F.percentile_approx(v, marks, 10_000).alias(f"q{i}") for i, v in enumerate(number)]).first()
    model = Boosted(list(features), first["base"] if first["base"] is not None else math.nan)
    if first["base"] is None:
        return model
    edges = [np.unique(np.array(first[f"q{i}"] or [], dtype=float)) for i in range(p)]

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {"r": batch.column("y").to_numpy() - model.base}
            for i, cuts in enumerate(edges):
                v = batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float)
                # the number of edges below the value; none for null and not a number
                columns[f"b{i}"] = np.where(np.isnan(v), 0, np.searchsorted(cuts, v)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(columns)

    plain = known.select(F.col(label).cast("double").alias("y"), *[v.alias(f"x{i}") for i, v in enumerate(x)])
    binned = plain.mapInArrow(bin_rows, "r double" + "".join(f", b{i} int" for i in range(p)))
    cells = binned.groupBy(*[f"b{i}" for i in range(p)]).agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("r"))
    rows, rounds = materialise(cells), Rounds(df.sparkSession)
    for _ in range(trees):
        grown = grow(rows, p, bins, leaves, least_rows, ridge)
        if len(grown) == 1:
            break
        model.trees.append(_tree(grown, edges, rate))
        step = F.coalesce(*[F.when(_within(leaf.path), F.lit(leaf.value * rate)) for leaf in grown])
        rows = rounds.store(rows.withColumn("r", F.col("r") - F.col("n") * step))
    return model
