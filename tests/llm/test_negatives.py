"""Hard negatives against scoring every pair, and the intervals against the products that they must hold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import negatives

SCHEMA = "vec_id long, label int, vector array<double>, anchor_id long, scores array<long>, key long"


def frame(spark, rows):
    return spark.createDataFrame([(i, c, v, 1, [2], 3) for i, c, v in rows], SCHEMA)


def brute(rows, dim, positives=5, negatives_=3):
    own = {}
    for i, c, v in rows:
        if None in (i, c, v) or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if sum(x * x for x in whole) < 1 << 62:
            own[(i, c, tuple(whole))] = True
    own = list(own)
    x = np.array([o[2] for o in own], dtype=object).reshape(len(own), -1)
    out = set()
    for n, (anchor, label, _) in enumerate(own):
        if anchor % 5:
            continue
        scores = [int((x[n] * x[m]).sum()) for m in range(len(own))]
        ranked = sorted((-scores[m], own[m][0], own[m][1]) for m in range(len(own)))
        same = [(-s, i) for s, i, c in ranked if c == label and i != anchor][:positives]
        for score, i in same:
            fit = [(-s, j) for s, j, c in ranked if c != label and 50 * score <= -100 * s <= 95 * score][:negatives_]
            out |= {(anchor, i, r, j, score, s) for r, (s, j) in enumerate(fit, 1)}
    return out


def sample(seed, n=220, dim=70):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        spread = rng.choice([0.05, 0.5, 2.0])
        v = (centres[i % 6] + rng.normal(size=dim) * spread) * rng.choice([0.01, 0.1, 1, 40])
        rows.append((int(i), int(rng.integers(0, 3)), v.tolist()))
    rows += [(500 + i, rows[10][1], rows[10][2]) for i in range(40)]  # copies, also of an anchor
    rows += [(600 + i, (rows[10][1] + 1) % 3, rows[10][2]) for i in range(40)]
    rows += [rows[15], rows[15], (700, None, rows[1][2]), (705, 1, None), (None, 1, rows[1][2]), (710, 1, [None] * dim), (715, 1, [float("nan")] * dim)]
    rows += [(720, 1, [float("inf")] * dim), (725, 1, [0.0] * dim), (730, 1, []), (735, 1, [1.0, 2.0]), (740, 2, [1e300] * dim), (745, 9, rows[3][2])]
    return rows


def mined(spark, rows, **sizes):
    got = negatives.mine(frame(spark, rows), F.col("vec_id") % 5 == 0, **sizes)
    out = [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("sizes", [{}, {"anchor_block": 9, "row_block": 50, "anchor_codes": 1, "row_codes": 1}])
def test_rows_equal_scoring_every_pair(spark, sizes):
    rows = sample(1)
    want = brute(rows, 70)
    assert len(want) > 300 and mined(spark, rows, **sizes) == want


@pytest.mark.parametrize("dim,codes", [(1, 1), (3, 2), (64, 1), (64, 4), (130, 3)])
def test_intervals_hold_the_products(dim, codes):
    rng = np.random.default_rng(dim)
    a, r = (np.floor(rng.normal(size=(50, dim)) * rng.choice([0, 1, 1000, 1e8], size=(50, 1))).astype(np.int64) for _ in range(2))
    r[:10] = a[:10]
    coder, norms = negatives.Coder(dim), lambda x: negatives._lengths(x.astype(float))
    low, high = coder.intervals(coder.encode(a, codes + 1), coder.encode(r, codes), norms(a), norms(r))
    exact = (a.astype(object) @ r.astype(object).T).astype(float)
    assert (low <= exact).all() and (exact <= high).all()


def test_more_codes_leave_fewer_candidates():
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(400, 64)) * 256).astype(np.int64)
    coder, norms = negatives.Coder(64), negatives._lengths(x.astype(float))
    widths = []
    for codes in (1, 2, 4, 6):
        low, high = coder.intervals(coder.encode(x, codes), coder.encode(x, codes), norms, norms)
        widths.append((high - low).mean())
    assert widths == sorted(widths, reverse=True) and widths[-1] < 0.1 * widths[0]


def test_odd_tables(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(5, 1, None), (10, None, [1.0])]) == set()
    assert mined(spark, [(5, 1, [1.0, 2.0])]) == set()
    assert mined(spark, [(5, 1, [1.0]), (6, 1, [1.0]), (7, 2, [0.9]), (8, 2, [0.9]), (9, 2, [0.1])]) == {
        (5, 6, 1, 7, 65536, 58880), (5, 6, 2, 8, 65536, 58880)
    }
