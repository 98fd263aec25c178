"""Embedding near-duplicates and nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import ann, embeddup

SCHEMA = "vec_id long, vector array<float>, n_links long, component_id long, entry long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3, 4.0) for i, v in rows], SCHEMA)


def usable(v, dim):
    return v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def sample(seed, n=400, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, dim))
    rows = [(int(i), np.float32(centres[i % 25] + rng.normal(size=dim) * rng.choice([0.02, 0.2, 0.5])).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # a group of copies
    rows += [(2000, [2 * x for x in rows[3][1]]), (2001, [0.0] * dim), (2002, None), (2003, [None] * dim), (2004, [float("nan")] * dim)]
    rows += [(2005, [float("inf")] + [1.0] * (dim - 1)), (2006, []), (2007, [1.0, 2.0]), (2020, [None] * dim), rows[5]]
    return rows


def brute_groups(rows, threshold, dim):
    ids = sorted({i for i, v in rows if i is not None and usable(v, dim)})
    first = {i: v for i, v in rows if usable(v, dim)}
    x = np.array([first[i] for i in ids], float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(ids))
    while True:
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    return {i: (int(linked[n].sum()), ids[label[n]]) for n, i in enumerate(ids)}


@pytest.mark.parametrize("block_rows,sample_rows", [(4096, 1000), (40, 100)])
def test_groups_equal_brute_force(spark, block_rows, sample_rows):
    rows = sample(1)
    got = embeddup.near_duplicates(frame(spark, rows), 0.9, block_rows, sample_rows).collect()
    assert len(got) == len(rows)
    want = brute_groups(rows, 0.9, 12)
    for r in got:
        links, component = want.get(r["vec_id"], (0, r["vec_id"]))
        assert (r["n_links"], r["component_id"], r["kept"]) == (links, component, r["vec_id"] == component), r


def test_groups_of_odd_tables(spark):
    assert embeddup.near_duplicates(frame(spark, [])).count() == 0
    got = embeddup.near_duplicates(frame(spark, [(1, None), (None, [1.0]), (2, [0.0])])).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in got) == [("1", 0, True), ("2", 0, True), ("None", 0, True)]
    one = embeddup.near_duplicates(frame(spark, [(7, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in one) == [(3, 1, 3, True), (3, 1, 3, True), (7, 1, 3, False)]


def brute_nearest(rows, k, dim):
    data = sorted({(i, tuple(v)) for i, v in rows if i is not None and usable(v, dim)})
    ids, x = [i for i, _ in data], np.array([v for _, v in data], float)
    out = {}
    for n, i in enumerate(ids):
        if i % 20 == 0:
            score = (x * x[n]).sum(axis=1)
            order = sorted((m for m in range(len(ids)) if m != n), key=lambda m: (-score[m], ids[m]))[:k]
            out[i] = [(ids[m], score[m]) for m in order]
    return out


def test_neighbours_with_full_windows_are_exact(spark):
    rows = sample(2)
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20, curves=2, cells=4, window=4)
    want = brute_nearest(rows, 20, 12)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found.keys() == want.keys()
    for q in want:
        assert [i for i, _ in found[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_with_production_windows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=32) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(3000)]
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute_nearest(rows, 20, 32)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_recall_holds_with_many_cells(spark):
    assert [ann.window_of(c) for c in (4, 16)] == [1, 1] and all((2 * ann.window_of(c) + 1) / c >= 3 / 16 for c in range(16, 500))
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=32) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(3000)]
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, cell_rows=40).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute_nearest(rows, 20, 32)
    assert np.mean([len(got[q] & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_neighbours_of_odd_tables(spark):
    ask = F.col("vec_id") % 20 == 0
    assert ann.nearest(frame(spark, []), ask).count() == 0
    assert ann.nearest(frame(spark, [(20, None), (None, [1.0])]), ask).count() == 0
    few = ann.nearest(frame(spark, [(20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (2, [0.5, 0.0])]), ask, k=20).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in few) == [(20, 1, 1, 1.0), (20, 2, 2, 0.5)]


def test_hilbert_neighbours_on_the_curve_are_neighbours_in_space():
    grid = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    order = np.argsort(ann.hilbert_index(grid, 3))
    assert sorted(ann.hilbert_index(grid, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(grid[order], axis=0)).sum(axis=1) == 1).all()
