"""Per-group fits, robust fits and merge heights against plain implementations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import groupmodels as GM
from lodestar.operators import linkage as LK
from lodestar.operators import robust as RB


def groups(seed, logistic):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in (("hot", 900), ("b", 80), ("c", 40), ("tiny", 2)):
        x = rng.normal(size=(n, 2)) * [1, 5]
        eta = x @ rng.normal(size=2) + rng.normal()
        if logistic:
            y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(float)
        else:
            y = eta + rng.normal(size=n) * 0.3
            y[rng.random(n) < 0.15] += 50
        rows += [(g, float(a), float(b), float(v)) for (a, b), v in zip(x, y)]
    return rows + [(None, 1.0, 1.0, 1.0), ("b", None, 1.0, 1.0), ("b", 1.0, 1.0, None)]


SCHEMA = "g string, a double, b double, y double"


def of_group(rows, g):
    own = np.array([r[1:] for r in rows if r[0] == g and None not in r])
    return np.column_stack([np.ones(len(own)), own[:, :2]]), own[:, 2]


def test_logistic_fits_have_no_gradient(spark):
    rows = groups(1, True)
    models = {r["g"]: r for r in GM.logistic_per_group(spark.createDataFrame(rows, SCHEMA), "g", ["a", "b"], "y", ridge=1e-3).collect()}
    assert set(models) == {"hot", "b", "c", "tiny"}
    for g, r in models.items():
        x, y = of_group(rows, g)
        beta = np.array(r["coefficients"])
        slope = x.T @ (y - 1 / (1 + np.exp(-x @ beta))) - np.r_[0, 1e-3 * beta[1:]]
        assert r["n"] == len(y) and np.abs(slope).max() < 1e-6


def test_separable_groups_end(spark):
    rows = [("s", float(i), float(i > 4)) for i in range(10)] + [("one", float(i), 1.0) for i in range(5)]
    models = {r["g"]: r for r in GM.logistic_per_group(spark.createDataFrame(rows, "g string, a double, y double"), "g", ["a"], "y", ridge=1e-2).collect()}
    assert all(np.isfinite(r["coefficients"]).all() for r in models.values()) and models["s"]["coefficients"][1] > 0


def test_huber_fits_equal_reweighting(spark):
    rows = groups(2, False)
    models = {r["g"]: r for r in GM.huber_per_group(spark.createDataFrame(rows, SCHEMA), "g", ["a", "b"], "y").collect()}
    for g in ("hot", "b", "c"):
        x, y = of_group(rows, g)
        beta = np.linalg.lstsq(x, y, rcond=None)[0]
        knee = 1.35 * np.median(np.abs(y - x @ beta)) / GM._MAD
        for _ in range(3000):
            w = np.minimum(1, knee / np.maximum(np.abs(y - x @ beta), 1e-300))
            beta = np.linalg.solve(x.T @ (w[:, None] * x), x.T @ (w * y))
        assert np.allclose(models[g]["coefficients"], beta, atol=1e-5)
    assert len(models["tiny"]["coefficients"]) == 3


def test_scores_of_group_models(spark):
    models = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.0, 0.0])], "g string, coefficients array<double>")
    rows = spark.createDataFrame([(1, "a", 3.0), (2, "b", 5.0), (3, "z", 1.0)], "id long, g string, x double")
    assert {r["id"]: r["prediction"] for r in GM.score_groups(rows, models, "g", ["x"]).collect()} == {1: 7.0, 2: 0.0}
    assert {r["id"]: r["prediction"] for r in GM.score_groups(rows, models, "g", ["x"], "logistic").collect()}[2] == 0.5


def outliers(spark, n=600, share=0.3):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2))
    y = 4 + x @ [2.0, -3.0]
    bad = rng.random(n) < share
    y[bad] = rng.uniform(-100, 100, bad.sum())
    rows = [(i, float(a), float(b), float(v)) for i, ((a, b), v) in enumerate(zip(x, y))] + [(n, None, 1.0, 1.0), (n + 1, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "id long, a double, b double, y double"), bad


def test_ransac_finds_the_plane(spark):
    df, bad = outliers(spark)
    beta, threshold, inliers = RB.ransac(df, ["a", "b"], "y", ["id"], threshold=0.01)
    assert np.allclose(beta, [4, 2, -3], atol=1e-6) and threshold == 0.01
    got = {r["id"] for r in inliers.collect()}
    assert {i for i in range(600) if not bad[i]} <= got and len(got) <= (~bad).sum() + 3
    _, default, _ = RB.ransac(df, ["a", "b"], "y", ["id"])
    y = np.array([r["y"] for r in df.na.drop().collect()])
    assert default == pytest.approx(np.median(np.abs(y - np.median(y))))


def test_theil_sen_finds_the_plane(spark):
    df, _ = outliers(spark, share=0.15)  # 0.85 ^ 3 of the subsets are clean
    assert np.allclose(RB.theil_sen(df, ["a", "b"], "y", ["id"], subsets=1500), [4, 2, -3], atol=1e-6)


def test_spatial_median_has_no_better_neighbour():
    points = np.random.default_rng(6).normal(size=(101, 3)) ** 3
    at = RB.spatial_median(points)
    scale = np.median(np.abs(points - np.median(points, axis=0)), axis=0)
    cost = lambda p: np.sqrt((((points - p) / scale) ** 2).sum(axis=1)).sum()
    rng = np.random.default_rng(7)
    assert all(cost(at) <= cost(at + rng.normal(size=3) * 1e-3 * scale) + 1e-9 for _ in range(200))


def test_robust_fits_of_few_rows(spark):
    few = spark.createDataFrame([(1, 1.0, 2.0)], "id long, a double, y double")
    assert RB.theil_sen(few, ["a"], "y", ["id"]) == []
    beta, _, inliers = RB.ransac(few, ["a"], "y", ["id"])
    assert beta == [] and inliers.count() == 0
    same = spark.createDataFrame([(i, 1.0, float(i)) for i in range(9)], "id long, a double, y double")
    assert RB.theil_sen(same, ["a"], "y", ["id"]) == []


def plain_linkage(x, method):
    """Closest pair first; distances of clusters from their members."""
    members = {i: [i] for i in range(len(x))}
    square = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    out = []
    while len(members) > 1:
        best = None
        for a in members:
            for b in members:
                if a < b:
                    p, q = members[a], members[b]
                    if method == "ward":
                        gap = x[p].mean(axis=0) - x[q].mean(axis=0)
                        d = np.sqrt(2 * len(p) * len(q) / (len(p) + len(q)) * (gap @ gap))
                    else:
                        d = square[np.ix_(p, q)].mean()
                    if best is None or (round(d, 10), a, b) < best:
                        best = (round(d, 10), a, b)
        d, a, b = best
        members[a] += members.pop(b)
        out.append((a, b, d, len(members[a])))
    return out


@pytest.mark.parametrize("method", ["ward", "average_squared"])
def test_merges_equal_closest_pair_first(spark, method):
    x = np.random.default_rng(8).normal(size=(40, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, v array<double>")
    merges = LK.linkage(df, "id", "v", method)
    got = sorted((r["left"], r["right"], round(r["height"], 8), r["size"]) for r in merges.collect())
    assert got == sorted((a, b, round(d, 8), n) for a, b, d, n in plain_linkage(x, method))
    want = {i: i for i in range(40)}
    for a, b, _, _ in sorted(plain_linkage(x, method), key=lambda m: m[2])[:36]:
        want = {i: (a if c == b else c) for i, c in want.items()}
    label = {r["id"]: r["cluster"] for r in LK.cut(df.where("id < 99"), "id", merges, 4).collect()}
    assert label == want


def test_merges_of_copies_and_of_one_row(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(6)] + [(6, [2.0, 1.0])], "id long, v array<double>")
    merges = LK.linkage(df, "id", "v")
    assert merges.count() == 6 and merges.agg(F.sum("height")).first()[0] == pytest.approx(np.sqrt(2 * 6 / 7))
    assert LK.linkage(df.where("id = 1"), "id", "v").count() == 0


@pytest.mark.parametrize("method", ["ward", "average_squared"])
def test_rounds_over_blocks_equal_those_within_one(spark, method):
    """Distributed rounds down to a few clusters, and all rounds in one task, on copies, ties and far values."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.integers(0, 3, size=(40, 3)).astype(float), rng.normal(size=(30, 3)) * 1e-6 + 1e3, rng.normal(size=(10, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    few, one = (sorted(map(tuple, LK.linkage(df, "id", "v", method, size).collect())) for size in (6, 4096))
    assert few == one and len(one) == 79


def test_closest_keeps_every_pair_that_can_be_nearest():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(60, 8)) * 1e-7 + 50, np.ones((20, 8))])
    c = np.column_stack([rng.integers(1, 9, size=80), rng.random(80), x]).astype(float)
    for value in LK.LINKAGES.values():
        n, s = c[:, 0], c[:, 1]
        square = np.array([[LK._squares(a[None], b[None])[0] for b in x] for a in x])
        exact = value(n[:, None], s[:, None], n[None, :], s[None, :], square)
        near = LK.closest(c, c, value)
        kept = np.isfinite(near)
        assert (near[kept] == exact[kept]).all()
        assert (np.sort(near, axis=1)[:, :2] == np.sort(exact, axis=1)[:, :2]).all()


def test_linkage_ends_in_one_task(spark, monkeypatch):
    """2,000 clusters fit in one block, so no round is a Spark job of its own."""
    def no_round(*_, **__):
        raise AssertionError("a round over blocks for clusters that fit in one")

    monkeypatch.setattr(LK, "block_top_k", no_round)
    df = spark.range(300).select("id", F.array(F.rand(1), F.rand(2)).alias("v"))
    assert LK.linkage(df, "id", "v").count() == 299
