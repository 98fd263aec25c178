"""The distributed building blocks, with sizes forced down so that the large paths run."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import aggregates, scaling


@pytest.fixture
def skewed(spark):
    """10,000 rows of which a third share one key and one value."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1).cast("int")
    return spark.range(10000).select("id", key.alias("k"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 211).cast("double").alias("v"))


def test_row_numbers_are_dense_and_ordered(spark, skewed):
    out = scaling.with_row_number(skewed, ["v", "id"]).select("v", "id", "row_number").toPandas().sort_values("row_number")
    assert out["row_number"].tolist() == list(range(1, 10001))
    assert out[["v", "id"]].apply(tuple, axis=1).is_monotonic_increasing


def test_running_totals(spark, skewed):
    counts = skewed.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    out = scaling.running_totals(counts, ["v"], ["n"]).toPandas().sort_values("v")
    assert out["cum_n"].tolist() == out["n"].cumsum().tolist()


def test_percentiles_equal_numpy(spark, skewed):
    marks = [0.0, 0.1, 0.5, 0.77, 1.0]
    data = skewed.toPandas()
    whole = scaling.exact_percentiles(skewed, "v", marks).first()
    assert [whole[f"p{i}"] for i in range(5)] == pytest.approx(np.quantile(data["v"], marks).tolist())
    groups = {r["k"]: r for r in scaling.exact_percentiles(skewed, "v", marks, ["k"]).collect()}
    assert len(groups) == data["k"].nunique()
    for k in (0, 1, 50):
        expected = np.quantile(data.loc[data["k"] == k, "v"], marks)
        assert [groups[k][f"p{i}"] for i in range(5)] == pytest.approx(expected.tolist())


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v DOUBLE")
    assert scaling.exact_percentiles(empty, "v", [0.5]).collect()[0]["p0"] is None
    nulls = spark.createDataFrame([(None,), (3.0,)], "v DOUBLE")
    assert scaling.exact_median(nulls, "v").first()["median"] == 3.0


@pytest.mark.parametrize("rows,accuracy", [(10000, 10000), (10000, 100), (7, 10000)])
def test_column_percentiles_equal_numpy(spark, skewed, rows, accuracy):
    marks = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    wide = skewed.where(F.col("id") < rows).select(F.when(F.col("id") % 10 > 0, F.col("v")).alias("v"), "k", F.lit(None).cast("double").alias("nothing"), (F.col("id") / 7).alias("w"))
    data = wide.toPandas()
    got = {r["column"]: r for r in scaling.column_percentiles(wide, ["v", "k", "nothing", "w"], marks, accuracy).collect()}
    assert set(got) == {"v", "k", "w"}
    for c, r in got.items():
        values = data[c].dropna()
        assert r["n"] == len(values)
        assert [r[f"p{i}"] for i in range(len(marks))] == pytest.approx(np.quantile(values, marks).tolist())


def test_block_product_equals_dense_product(spark):
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 3, (17, 11)).astype(float), rng.integers(0, 3, (11, 13)).astype(float)
    cells = lambda m, r, c: spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], [r, c, "value"])
    left, right = cells(a, "row", "k"), cells(b, "k", "col")
    out = np.zeros((17, 13))
    for r in scaling.block_product(left, right, size=4).collect():
        out[r["row"], r["col"]] = r["value"]
    assert np.array_equal(out, a @ b)
    mask = spark.createDataFrame([(0, 0), (3, 5), (16, 12)], ["row", "col"])
    got = {(r["row"], r["col"]): r["value"] for r in scaling.block_product(left, right, mask, size=4).collect()}
    assert got == {k: (a @ b)[k] for k in ((0, 0), (3, 5), (16, 12)) if (a @ b)[k]}


def test_block_top_k_is_exact_with_ties(spark):
    rng = np.random.default_rng(1)
    points = np.round(rng.normal(size=(60, 3)), 1)
    points[20:40] = points[0]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id INT, vector ARRAY<DOUBLE>")
    distance = lambda x, y: -np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    out = scaling.block_top_k(df, df, distance, 5, size=16).collect()
    full = np.round(distance(points, points), 9)
    for i in range(60):
        want = sorted(range(60), key=lambda j: (-full[i, j], j))[:5]
        assert [r["base_id"] for r in sorted((r for r in out if r["query_id"] == i), key=lambda r: r["rank"])] == want


def test_block_top_k_sends_large_tables_to_few_blocks(spark, monkeypatch):
    """A block is compared panel by panel, ties across panels included, so a row is not sent once per panel."""
    rng = np.random.default_rng(3)
    points = np.round(rng.normal(size=(400, 2)), 1)
    points[100:300:9] = points[0]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id INT, vector ARRAY<DOUBLE>")
    distance = lambda x, y: -np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    copies, every = [], scaling._all_blocks
    monkeypatch.setattr(scaling, "_all_blocks", lambda blocks: copies.append(blocks) or every(blocks))
    found = {}
    for r in scaling.block_top_k(df, df, distance, 6, size=10).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["base_id"]
    full = np.round(distance(points, points), 9)
    for i in range(400):
        want = sorted(range(400), key=lambda j: (-full[i, j], j))[:6]
        assert [b for _, b in sorted(found[i].items())] == want
    assert copies and max(copies) <= 8


def test_salted_lookup_keeps_every_row(spark, skewed):
    lookup = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = scaling.salted_lookup(skewed, lookup, ["k"])
    assert joined.count() == 10000 and set(joined.columns) == {"id", "k", "v", "n"}


def test_salted_lookup_repeats_only_hot_keys(spark, skewed):
    lookup = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    want = sorted(tuple(r) for r in skewed.join(lookup, "k").collect())
    hot = scaling.hot_keys(skewed, ["k"], 500)
    assert {r["k"]: r["_salts"] for r in hot.collect()} == {r["k"]: -(-r["n"] // 500) for r in lookup.where("n > 500").collect()}
    assert 0 < hot.count() < lookup.count()
    assert sorted(tuple(r) for r in scaling.salted_lookup(skewed, lookup, ["k"], hot).collect()) == want
    # no key of these has more than HOT_ROWS rows: nothing is repeated
    plan = scaling.salted_lookup(skewed, lookup, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_long_posting_lists_are_split(spark):
    docs = spark.createDataFrame([(i, "all " + ("odd" if i % 2 else "even")) for i in range(10)], "id INT, text STRING")
    out = {(r["word"], r["part"]): r["docs"] for r in aggregates.inverted_index(docs, "id", "text", chunk=6).collect()}
    part = {i: int(hashlib.md5(f"{i}:42".encode()).hexdigest()[:8], 16) % 2 for i in range(10)}
    for word, ids in (("all", range(10)), ("odd", range(1, 10, 2)), ("even", range(0, 10, 2))):
        for p in (0, 1):
            assert out.get((word, p)) == (",".join(str(i) for i in ids if part[i] == p) or None)


def test_posting_lists_of_file_names(spark):
    docs = spark.createDataFrame([("b.txt", "x y x"), ("a.txt", "x"), ("a.txt", "y"), (None, "z")], "name STRING, text STRING")
    out = {r["word"]: r["docs"] for r in aggregates.inverted_index(docs, "name", "text").collect()}
    assert out == {"x": "a.txt,b.txt", "y": "a.txt,b.txt", "z": ""}


def test_top_k_limits_before_the_shuffle(spark, skewed):
    plan = scaling.top_k_per_key(skewed, ["k"], [F.asc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scratch_folder_follows_the_session(spark):
    folder = scaling.checkpoint_folder(spark)
    assert folder and scaling.checkpoint_folder(spark) == folder


def test_configure_applies_what_can_change(spark):
    from lodestar.session import configure

    assert configure(spark).conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


@pytest.mark.parametrize("chunk", [1024, 6])
def test_pairs_of_small_and_full_baskets(spark, chunk):
    full = {"hot": range(50), "small": range(4), None: range(3, 12), "one": [7]}
    rows = [(g, i) for g, items in full.items() for i in items] + [("hot", 5), ("hot", None)]
    got = [tuple(r) for r in aggregates.basket_pairs(spark.createDataFrame(rows, "g STRING, i INT"), "g", "i", chunk).collect()]
    want = [(g, a, b) for g, items in full.items() for a in items for b in items if a < b]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_block_product_adds_up_in_the_task(spark):
    """Over all inner keys at once: cells are not shuffled a second time, as they were once per block of inner keys."""
    rng = np.random.default_rng(5)
    a, b = (np.where(rng.random((n, 400)) < 0.03, rng.integers(1, 9, (n, 400)), 0).astype(float) for n in (12, 30))
    a[:, 7] = 1.0  # a key in every row
    a[3] = 2.0  # a row with every key
    frame = lambda m, r, c: spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m))], [r, c, "value"])
    left, right = scaling.materialise(frame(a, "row", "k")), scaling.materialise(frame(b.T, "k", "col"))
    once = scaling.block_product(left, right, size=64)
    assert "HashAggregate" not in once._jdf.queryExecution().executedPlan().toString()
    for out in (once, scaling.block_product(left, right, size=64, entries=90)):  # the second cuts the keys of the full row
        got = np.zeros((12, 30))
        for r in out.collect():
            assert r["value"] != 0 and got[r["row"], r["col"]] == 0
            got[r["row"], r["col"]] = r["value"]
        assert np.array_equal(got, a @ b.T)
    asked = [(int(i), int(j)) for i, j in zip(rng.integers(0, 12, 80), rng.integers(0, 30, 80))]
    mask = spark.createDataFrame(asked, ["row", "col"])
    got = {(r["row"], r["col"]): r["value"] for r in scaling.block_product(left, right, mask, entries=400).collect()}
    assert got == {k: (a @ b.T)[k] for k in asked if (a @ b.T)[k]}
