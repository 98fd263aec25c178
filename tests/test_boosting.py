"""Leaf-wise boosting against a plain implementation on the same bins."""

import numpy as np
import pytest

from lodestar.operators import boosting as B


def table(seed, n=600):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1]
    y = np.where(x[:, 0] > 0.3, 5.0, -1.0) + 0.2 * x[:, 1] * (x[:, 2] > 0) + rng.normal(size=n) * 0.2
    return x, y


def plain(x, y, edges, trees, leaves, rate, least):
    """Every row by hand: the leaf with the best cut is divided until there are enough leaves."""
    pred = np.full(len(y), y.mean())
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    for _ in range(trees):
        r, open_ = y - pred, [np.arange(len(y))]
        while len(open_) < leaves:
            best = None
            for at, own in enumerate(open_):
                for f in range(x.shape[1]):
                    for b in range(len(edges[f])):
                        left, right = own[binned[own, f] <= b], own[binned[own, f] > b]
                        if min(len(left), len(right)) < least:
                            continue
                        gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[own].sum() ** 2 / len(own)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, at, left, right)
            if best is None:
                break
            open_[best[1] : best[1] + 1] = [best[2], best[3]]
        for own in open_:
            pred[own] += rate * r[own].mean()
    return pred


def test_predictions_equal_a_plain_implementation(spark):
    x, y = table(1)
    df = spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, a double, b double, c double, y double").repartition(5)
    model = B.fit_leafwise(df, ["a", "b", "c"], "y", trees=3, leaves=6, bins=16, rate=0.5, least_rows=10)
    edges = [np.unique(v) for v in [np.array(df.agg(B.F.percentile_approx(c, [i / 16 for i in range(1, 16)], 10_000)).first()[0]) for c in "abc"]]
    got = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
    want = plain(x, y, edges, 3, 6, 0.5, 10)
    assert [got[i] for i in range(len(y))] == pytest.approx(want.tolist())
    assert np.mean(list(got.values())) == pytest.approx(y.mean()) and ((want - y) ** 2).mean() < 0.2 * y.var()


def test_nulls_and_small_tables(spark):
    rows = [(1, None, 1.0), (2, float("nan"), 1.0), (3, 5.0, 9.0), (4, 6.0, 9.0), (5, 7.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, y double")
    model = B.fit_leafwise(df, ["a"], "y", trees=1, leaves=2, bins=4, rate=1.0, least_rows=1)
    # nothing is known below the smallest edge, so the two rows without a number stand on its left with the first
    got = {r["id"]: r["prediction"] for r in model.predict(df).collect()}
    assert got[1] == got[2] and got[4] == got[5] == 9.0
    constant = B.fit_leafwise(df.selectExpr("id", "a", "3.0 AS y"), ["a"], "y", least_rows=1)
    assert constant.trees == [] and constant.base == 3.0
    assert np.isnan(B.fit_leafwise(df.where("id > 9"), ["a"], "y").base)


def test_a_tree_takes_as_many_passes_as_it_is_deep(spark, monkeypatch):
    passes, read = [], B._histograms
    monkeypatch.setattr(B, "_histograms", lambda rows, paths, *a: passes.append(len(paths)) or read(rows, paths, *a))
    rows = spark.range(4096).selectExpr("cast(id as double) as r", "cast(id % 64 as int) as b0", "cast(id / 64 as int) as b1")
    grown = B.grow(rows, 2, 64, 16, 1, 0.0)
    assert len(grown) == 16 and len(passes) <= 1 + max(len(leaf.path) for leaf in grown) < 16


def test_rows_with_the_same_bins_are_stored_once(spark, monkeypatch):
    """Copies of the rows, in other places, change neither what is stored nor the model."""
    x, y = table(2, 300)
    x = np.round(x / [1, 10, 0.1])
    rows = [(*map(float, v), float(t)) for v, t in zip(x, y)]
    stored, store = [], B.materialise
    monkeypatch.setattr(B, "materialise", lambda df: stored.append(store(df)) or stored[-1])
    fit = lambda k: B.fit_leafwise(spark.createDataFrame(rows * k, "a double, b double, c double, y double").repartition(3), ["a", "b", "c"], "y", trees=3, leaves=5, bins=64, least_rows=4 * k)
    one, many = fit(1), fit(6)
    assert stored[0].count() == stored[1].count() <= len(np.unique(x, axis=0)) < len(rows)
    assert stored[1].agg(B.F.sum("n")).first()[0] == 6 * len(rows)
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    got = [[r["prediction"] for r in model.predict(df).collect()] for model in (one, many)]
    assert got[0] == pytest.approx(got[1]) and got[0] == pytest.approx(plain(x, y, [np.unique(x[:, f]) for f in range(3)], 3, 5, 0.1, 4).tolist())
