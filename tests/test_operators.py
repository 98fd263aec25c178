import itertools
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lodestar.functions.columns import hash_fraction
from lodestar.operators import aggregates as A
from lodestar.operators import graph as G
from lodestar.operators import joins as J
from lodestar.operators import metrics as M
from lodestar.operators import models as ML
from lodestar.operators import neighbours as N
from lodestar.operators import recommend as R
from lodestar.operators import reshape as V
from lodestar.operators import rows as W
from lodestar.operators import scaling
from lodestar.operators import timeseries as TS
from lodestar.operators.clustering import assemble
from lodestar.sources import readers, sinks


# --- sources ---------------------------------------------------------------------------------------


def test_cached_reads_stored_result(spark, tmp_path):
    path = str(tmp_path / "t")
    calls = []

    def build(n):
        calls.append(n)
        return spark.range(n)

    assert sinks.cached(spark, path, lambda: build(3)).count() == 3
    assert sinks.cached(spark, path, lambda: build(5)).count() == 3
    assert sinks.cached(spark, path, lambda: build(5), refresh=True).count() == 5
    assert calls == [3, 5]


def test_csv_conversion_strict_or_not(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,d\n1.5,03/02/2018\nNaN,04/02/2018\nbad,05/02/2018\n")
    loose = readers.read_csv_typed(spark, str(tmp_path / "x.csv"), {"a": "double"}, {"d": "dd/MM/yyyy"}, strict=False).collect()
    assert [r["a"] for r in loose] == [1.5, None, None] and str(loose[0]["d"]) == "2018-02-03"
    with pytest.raises(PySparkException):
        readers.read_csv_typed(spark, str(tmp_path / "x.csv"), {"a": "double"}).collect()


def test_edge_list_comments_and_direction(spark, tmp_path, rows):
    (tmp_path / "g.txt").write_text("# 3 edges\n1 2\n2 1\n2 3\n")
    path = str(tmp_path / "g.txt")
    assert rows(readers.read_edges(spark, path)) == [(1, 2), (2, 1), (2, 3)]
    assert rows(readers.read_edges(spark, path, directed=False)) == [(1, 2), (2, 3)]


def test_posts_with_and_without_tags(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("1\ttitle\t<p>\"q\"</p>\tcss,html\n2\tt\tb\n")
    out = readers.read_posts(spark, str(tmp_path / "p.tsv")).collect()
    assert [tuple(r) for r in out] == [("1", "title", '<p>"q"</p>', "css,html"), ("2", "t", "b", None)]


def test_labelled_folders(spark, tmp_path, rows):
    for label, text in (("pos", "good\nline"), ("neg", "bad")):
        (tmp_path / label).mkdir()
        (tmp_path / label / "a.txt").write_text(text)
    assert rows(readers.read_labelled_dirs(spark, str(tmp_path)).select("label", "text")) == [(0, "bad"), (1, "good\nline")]


def test_merge_nodes_keeps_old_values(spark, rows):
    old = spark.createDataFrame([("Ann", ["Client"], 1)], "name STRING, labels ARRAY<STRING>, age INT")
    new = spark.createDataFrame([("Ann", ["Officer"], None), ("Bob", ["Officer"], 2)], "name STRING, labels ARRAY<STRING>, age INT")
    assert rows(readers.merge_nodes(old, new, "name")) == [("Ann", ["Client", "Officer"], 1), ("Bob", ["Officer"], 2)]


def test_narrow_types_strict_limits(spark):
    df = spark.createDataFrame([(126, 127, 10**9, None), (-127, 0, 0, None)], "a BIGINT, b BIGINT, c BIGINT, d BIGINT")
    assert readers.narrowest_types(df) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint"}


# --- rows, joins, reshape --------------------------------------------------------------------------


def test_group_max_keeps_ties_and_skips_null(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", None)], "k STRING, v INT")
    assert rows(W.group_max_rows(df, "k", "v")) == [("a", 2), ("a", 2)]


def test_dedup_first_by_order(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k STRING, o INT, v STRING")
    assert rows(W.dedup_first(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 1, None)]


def test_split_per_user_cap(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(3) for i in range(4)], "user INT, item INT, rating DOUBLE")
    out = W.split_per_user(df, "user", ["user", "item"], 1, 2, max_test=3)
    assert out.where("part = 'test'").count() == 3 and out.count() == 12


@pytest.mark.parametrize("n,k", [(10, 3), (2, 5), (7, 7)])
def test_kfold_blocks_like_ntile(spark, n, k):
    out = W.kfold_blocks(spark.range(n), k, ["id"]).orderBy("id").toPandas()["fold"].tolist()
    want = list(itertools.chain.from_iterable([i + 1] * len(part) for i, part in enumerate(np.array_split(np.arange(n), k))))
    assert out == want


def test_splits_are_disjoint_and_complete(spark):
    parts = W.split_weights(spark.range(1000), ["id"], [0.1, 0.1])
    ids = [set(r[0] for r in p.collect()) for p in parts]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 1000 and 400 < len(ids[0]) < 600


def test_bootstrap_has_the_same_size(spark):
    out = W.bootstrap(spark.range(500), ["id"])
    assert out.count() == 500 and 250 < out.select("id").distinct().count() < 380


def test_pivot_unique_rejects_duplicates(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "i STRING, c STRING, v INT")
    with pytest.raises(PySparkException, match="duplicate entries"):
        V.pivot_unique(df, "i", "c", "v").collect()


def test_sex_age_columns(spark, rows):
    df = spark.createDataFrame([("AD", 1, 2, 3, 4)], "iso STRING, m04 INT, m1524 INT, f65 INT, mu INT")
    out = V.split_sex_age(V.melt(df, ["iso"])).select("sex", "age", "value")
    assert rows(out) == [("f", "65+", 3), ("m", "0-4", 1), ("m", "15-24", 2)]


def test_dummies_unseen_level(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c STRING")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "c STRING")
    out = V.dummies(test, V.dummy_levels(train, ["c"]))
    assert out.columns == ["c_a", "c_b"] and [tuple(r) for r in out.collect()] == [(0, 1), (0, 0), (0, 0)]


def test_events_in_window(spark):
    flights = spark.sql("SELECT 'LAX' AS place, DATE '2012-01-03' AS d UNION ALL SELECT 'JFK', DATE '2012-01-03'")
    events = spark.sql("SELECT 'LAX' AS place, explode(array(DATE '2012-01-01', DATE '2012-01-03', DATE '2012-01-03', DATE '2012-01-04', DATE '2011-12-31')) AS d")
    out = {r["place"]: r["n_events"] for r in J.events_in_window(flights, events, "place", "d").collect()}
    assert out == {"LAX": 3, "JFK": 0}


def test_resample_fills_gaps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 05:00' AS ts, 1.0D AS v UNION ALL SELECT TIMESTAMP_NTZ '2020-01-03 01:00', 3.0D")
    out = TS.resample(df, "ts", "day", {"mean": F.avg("v")}, fill_gaps=True).orderBy("period").collect()
    assert [r["mean"] for r in out] == [1.0, None, 3.0]
    assert TS.date_range(spark, "2020-01-01", 4, "3 hours").count() == 4


# --- aggregates and metrics ------------------------------------------------------------------------


def test_word_count_variants(spark, rows):
    df = spark.createDataFrame([("the cat, the  dog!",), ("",), (None,)], "t STRING")
    assert rows(A.word_count(df, "t")) == [("cat,", 1), ("dog!", 1), ("the", 2)]
    assert rows(A.word_count(df, "t", punct=False, min_len=3, top=1)) == [("the", 2)]
    assert ("", 2) in rows(A.word_count(df, "t", mode="space"))


def test_weighted_degree_limits(spark, rows):
    df = spark.createDataFrame([("a", "b", 0.6), ("a", "c", 0.6), ("b", "d", 0.4), ("d", "e", 0.59)], "src STRING, dst STRING, w DOUBLE")
    assert [(n, round(w, 9)) for n, w in rows(G_weight(df))] == [("a", 1.2)]


def G_weight(df):
    return A.weighted_degree(df)


def test_spearman_with_ties(spark):
    x, y = [1, 2, 2, 3, 3, 3], [5, 3, 3, 2, 1, 1]
    df = spark.createDataFrame(list(zip(x, y)), "x INT, y INT")
    rank = lambda v: np.array([np.mean([i + 1 for i, s in enumerate(sorted(v)) if s == e]) for e in v])
    want = np.corrcoef(rank(x), rank(y))[0, 1]
    got = {(r["a"], r["b"]): r["value"] for r in A.corr_matrix(df, ["x", "y"], "spearman").collect()}
    assert got["x", "y"] == pytest.approx(want) and got["x", "x"] == pytest.approx(1.0)


def test_mape_example(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "y DOUBLE, p DOUBLE")
    assert M.regression_errors(df, "y", "p").first()["mape"] == pytest.approx(32.738, abs=1e-3)


def test_multilabel_f1_empty_sets(spark):
    df = spark.createDataFrame([(["a", "b"], ["a"]), ([], []), (["a"], [])], "l ARRAY<STRING>, p ARRAY<STRING>")
    assert M.multilabel_f1(df, "l", "p").first()["f1"] == pytest.approx((2 / 3 + 0) / 2)


def test_auc_equals_pair_counting(spark):
    rng = random.Random(3)
    data = [(int(rng.random() < 0.4), round(rng.random(), 1)) for _ in range(200)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = M.area_under_curves(spark.createDataFrame(data, "y INT, s DOUBLE"), "y", "s").first()
    assert got["auc"] == pytest.approx(want)


def test_information_gain_perfect_split(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1), (4.0, 1)], "x DOUBLE, y INT")
    out = {r["threshold"]: r["gain"] for r in M.information_gain(df, "x", "y", [0, 1]).collect()}
    assert out[2.0] == pytest.approx(1.0) and 4.0 not in out


# --- graphs ----------------------------------------------------------------------------------------


def graph(spark, pairs):
    return spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "src BIGINT, dst BIGINT")


@pytest.fixture(scope="module")
def hub_graph():
    """A hub with a third of all edges, random edges, a long chain and a separate pair."""
    rng = random.Random(7)
    pairs = {(0, i) for i in range(1, 40)}
    pairs |= {tuple(sorted(rng.sample(range(1, 40), 2))) for _ in range(80)}
    pairs |= {(100 + i, 101 + i) for i in range(30)}
    return sorted(pairs | {(200, 201)})


def neighbours_of(pairs):
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return near


def test_components_of_chains_and_hubs(spark, hub_graph):
    out = {r["node"]: r["component"] for r in G.connected_components(graph(spark, hub_graph)).collect()}
    assert {out[i] for i in range(40)} == {0} and {out[100 + i] for i in range(31)} == {100} and out[201] == 200
    alone = G.connected_components(graph(spark, [(5, 6)]), spark.createDataFrame([(9,)], "node BIGINT")).collect()
    assert sorted(map(tuple, alone)) == [(5, 5), (6, 5), (9, 9)]


def test_triangles_and_loops(spark, hub_graph):
    near = neighbours_of(hub_graph)
    want = {v: sum(1 for a, b in itertools.combinations(near[v], 2) if b in near[a]) for v in near}
    both = hub_graph + [(b, a) for a, b in hub_graph] + [(3, 3)]
    out = {r["node"]: r["triangles"] for r in G.triangle_count(graph(spark, both)).collect()}
    assert out == want


def test_core_numbers(spark, hub_graph):
    near = {v: set(n) for v, n in neighbours_of(hub_graph).items()}
    want, k = {}, 0
    while near:
        v = min(near, key=lambda x: len(near[x]))
        k = max(k, len(near[v]))
        want[v] = k
        for u in near.pop(v):
            near[u].discard(v)
    out = {r["node"]: r["core"] for r in G.core_numbers(graph(spark, hub_graph)).collect()}
    assert out == want


def test_three_page_ranks(spark):
    pairs = [(1, 2), (2, 1), (1, 3), (4, 1)]
    first = {r["node"]: r["rank"] for r in G.pagerank_iter(graph(spark, pairs), 2).collect()}
    assert 4 not in first and set(first) == {1, 2, 3}
    tol = {r["node"]: r["rank"] for r in G.pagerank_tol(graph(spark, pairs), 1e-9).collect()}
    assert tol[4] == pytest.approx(0.15)
    markov = {r["node"]: r["rank"] for r in G.pagerank_markov(graph(spark, pairs), tol=1e-12).collect()}
    assert sum(markov.values()) == pytest.approx(1.0)
    index = {1: 0, 2: 1, 3: 2, 4: 3}
    p = np.zeros((4, 4))
    for a, b in pairs:
        p[index[b], index[a]] = 1 / sum(1 for x, _ in pairs if x == a)
    p[:, index[3]] = 0.25
    v = np.full(4, 0.25)
    for _ in range(300):
        v = 0.85 * p @ v + 0.15 / 4
    assert [markov[n] for n in index] == pytest.approx(v.tolist(), abs=1e-8)


def test_cycle_and_path_histograms(spark):
    graphs = G.cycle_path_graphs(spark, 3, 4)
    hist = {(r["graph"], r["d"]): r["n"] for r in G.sp_histogram(graphs).collect()}
    assert hist == {(6, 0): 3, (6, 1): 6, (7, 0): 3, (7, 1): 4, (7, 2): 2, (8, 0): 4, (8, 1): 8, (8, 2): 4, (9, 0): 4, (9, 1): 6, (9, 2): 4, (9, 3): 2}
    h = G.sp_histogram(graphs)
    kernel = {(r["row"], r["col"]): r["value"] for r in G.sp_kernel(h, h).collect()}
    assert kernel[6, 7] == 3 * 3 + 6 * 4 and kernel[6, 7] == kernel[7, 6]


def test_random_walks_follow_edges(spark, hub_graph):
    both = hub_graph + [(b, a) for a, b in hub_graph]
    walks = G.random_walks(graph(spark, both), 2, 8).collect()
    allowed = set(both)
    assert all((a, b) in allowed for w in walks for a, b in zip(w["nodes"], w["nodes"][1:]))
    assert all(len(w["nodes"]) == 8 for w in walks) and len(walks) == 2 * len(neighbours_of(hub_graph))
    again = G.random_walks(graph(spark, both), 2, 8).collect()
    assert sorted(map(str, walks)) == sorted(map(str, again))


def test_modularity_of_two_cliques(spark):
    pairs = list(itertools.combinations(range(4), 2)) + list(itertools.combinations(range(10, 14), 2)) + [(0, 10)]
    clusters = spark.createDataFrame([(i, int(i >= 10)) for i in [*range(4), *range(10, 14)]], "node BIGINT, cluster INT")
    m = 13
    want = 2 * (6 / m - (13 / (2 * m)) ** 2)
    assert G.modularity(graph(spark, pairs), clusters).first()[0] == pytest.approx(want)


# --- recommendation, neighbours, models ------------------------------------------------------------


def test_similarity_and_prediction(spark):
    x = np.array([[4, 5, 0, 2], [5, 3, 1, 0], [1, 2, 5, 0], [2, 0, 0, 4]], dtype=float)
    ratings = spark.createDataFrame([(int(u), int(i), float(x[u, i])) for u, i in zip(*np.nonzero(x))], "user INT, item INT, rating DOUBLE")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = unit @ unit.T
    np.fill_diagonal(s, 0)
    sims = R.user_similarity(ratings)
    got = {(r["a"], r["b"]): r["similarity"] for r in sims.collect()}
    assert got == {(a, b): pytest.approx(s[a, b]) for a in range(4) for b in range(4) if s[a, b] > 0}
    pairs = spark.createDataFrame([(0, 2), (3, 1), (0, 9), (9, 0)], "user INT, item INT")
    out = {(r["user"], r["item"]): r["prediction"] for r in R.predict_ratings(ratings, sims, pairs).collect()}
    raters = [1, 2]
    assert out[0, 2] == pytest.approx(sum(s[0, v] * x[v, 2] for v in raters) / sum(s[0, v] for v in raters))
    assert out[0, 9] == 2.5 and out[9, 0] == 2.5


def test_nearest_centroid_and_votes(spark):
    data = [(0, 0, [0.0, 0.0]), (1, 0, [0.0, 1.0]), (2, 1, [5.0, 5.0]), (3, 1, [5.0, 6.0])]
    df = spark.createDataFrame(data, "id INT, label INT, v ARRAY<DOUBLE>")
    out = {r["id"]: r["predicted"] for r in N.nearest_centroid(df, df, "label", "v", "id").collect()}
    assert out == {0: 0, 1: 0, 2: 1, 3: 1}
    votes = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b")], "id INT, y STRING")
    assert sorted(map(tuple, ML.majority_vote(votes, "id", "y").collect())) == [(1, "a"), (2, "b")]


@pytest.fixture(scope="module")
def line(spark):
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 - 0.5) * 2
    wild = F.when(F.col("id") % 10 == 0, 500.0).otherwise(0.0)
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), noise.alias("e"), wild.alias("w"), (F.col("id") % 3).alias("g"))
    return df.withColumn("y", 3 * F.col("x") + 7 + F.col("e") + F.col("w")).withColumn("clean", 3 * F.col("x") + 7 + F.col("e"))


def test_inliers_drop_the_wild_rows(spark, line):
    kept = ML.inliers_split(assemble(line, ["x"]), ML.linear("y"), "y", ["id"])
    assert kept.count() == 320 and kept.where("w > 0").count() < line.where("w > 0").count()


def plain_inliers(rows, keys, seed=42):
    """Rounds of least squares on numpy columns; ``rows`` are ``id, x, y, u0, u1, ...`` with the hash share of each round."""
    ids, x, y = (np.array([r[i] for r in rows], dtype=float) for i in range(3))
    known, have, goal, n = np.zeros(len(rows), bool), 0, int(len(rows) * 0.8), 0
    while have < goal:
        u = np.array([r[3 + n] for r in rows])
        train, asked = known | (u < 0.5), np.flatnonzero(~known & (u >= 0.5))
        slope, start = np.polyfit(x[train], y[train], 1)
        order = asked[np.lexsort((ids[asked], np.abs(slope * x + start - y)[asked]))]
        keep = min(len(asked) // 2, goal - have) or min(1, len(asked))
        known |= np.isin(ids, ids[order[:keep]])
        have, n = have + keep, n + 1
    return ids[known].tolist()


@pytest.mark.parametrize("copies", [1, 2])
def test_inliers_equal_a_plain_implementation(spark, line, copies):
    """Also where rows share a key: they come in together."""
    wide = line.select("id", "x", "y").unionByName(line.where("id % 50 = 0").selectExpr("id", "x", "y + 1 AS y").limit(8 * (copies - 1)))
    rows = wide.select("id", "x", "y", *[hash_fraction(["id"], 42 + n) for n in range(20)]).collect()
    kept = ML.inliers_split(assemble(wide, ["x"]), ML.linear("y"), "y", ["id"])
    assert sorted(r["id"] for r in kept.collect()) == sorted(plain_inliers(rows, ["id"]))


def test_a_round_of_inliers_does_not_shuffle_the_table(spark, line, monkeypatch):
    numbered = []
    number = scaling.with_row_number
    monkeypatch.setattr(scaling, "with_row_number", lambda df, *a: numbered.append(df.count()) or number(df, *a))
    big = spark.range(20_000).select("id", F.rand(3).alias("x")).withColumn("y", F.col("x") + F.rand(4))
    kept = ML.inliers_split(assemble(big, ["x"]), ML.linear("y"), "y", ["id"])
    assert kept.count() == 16_000 and numbered and max(numbered) < 200


def test_row_at_every_place(spark):
    values = [None, None, float("nan"), *[float(v % 7) for v in range(30)]]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, i long")
    order = [i for _, _, i in sorted((0 if v is None else 2 if v != v else 1, 0 if v is None or v != v else v, i) for i, v in enumerate(values))]
    assert [scaling.row_at(df, ["v", "i"], p).first()["i"] for p in (1, 2, 3, 17, 32, 33)] == [order[p - 1] for p in (1, 2, 3, 17, 32, 33)]


def test_a_code_that_no_row_has_is_not_predicted(spark):
    """Training rows without a code are a class of the indexer that has no text."""
    data = [(i, None if i % 3 else "ab"[i % 2], [float(i % 3 > 0), 1.0]) for i in range(60)]
    df = spark.createDataFrame(data, "id long, code string, v array<double>").withColumn("features", array_to_vector("v"))
    out = ML.fit_tag_code(df, df, "code", ML.logistic(multinomial=True, maxIter=10)).collect()
    assert len(out) == 60 and {r["predicted_code"] for r in out} <= {"a", "b"}


def test_errors_of_several_predictions(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (4.0, 2.0, 4.5)], "y double, a double, b double")
    out = M.errors_of_several(df, "y", ["a", "b"], ["n", "mae", "rmse"], [[F.lit(c).alias("kind")] for c in "ab"]).collect()
    want = {c: M.regression_errors(df, "y", c).first() for c in "ab"}
    assert {r["kind"]: (r["n"], r["mae"], r["rmse"]) for r in out} == {c: (w["n"], w["mae"], w["rmse"]) for c, w in want.items()}


def test_group_models_equal_regression_aggregates(spark, line):
    models = {r["g"]: r["coefficients"] for r in ML.per_group_models(line, "g", ["x"], "clean").collect()}
    for r in ML.per_group_lines(line, "g", "x", "clean").collect():
        assert models[r["g"]] == pytest.approx([r["intercept"], r["slope"]], rel=1e-6)


def test_models_beat_the_mean(spark, line):
    rows = assemble(line, ["x"])
    scored = ML.cross_val_predict(rows, ML.linear("clean"), ["id"], 3)
    assert scored.count() == 400
    error = M.regression_errors(scored, "clean", "prediction").first()["mae"]
    assert error < 1.0


def test_shuffled_column_keeps_its_values(spark, line):
    out = ML.shuffle_column(line.select("id", "x", "g"), "x", ["id"], 5).toPandas()
    before = line.select("id", "x").toPandas()
    assert sorted(out["x"]) == sorted(before["x"]) and out.set_index("id")["x"].to_dict() != before.set_index("id")["x"].to_dict()


# --- plans -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "name",
    ["a02_word_count", "a12_group_agg", "j03_denormalise", "j05_attach_counts", "j08_events_in_window", "w01_group_max_rows", "p08_recode", "t03_clean_text", "t18_graph_of_words", "ts07_house_sales"],
)
def test_plans_stay_in_the_jvm_without_products(spark, name):
    import __spark_entry__ as entry

    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_loops_run_to_their_end(spark):
    path = spark.range(60).select(F.lit("g").alias("graph"), F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    hist = {r["d"]: r["n"] for r in G.sp_histogram(path.where("src < 25")).collect()}
    assert hist == {0: 26, **{d: 2 * (26 - d) for d in range(1, 26)}}
    assert {r["core"] for r in G.core_numbers(path).collect()} == {1}
    assert {r["component"] for r in G.connected_components(path).collect()} == {0}


def test_constant_columns_and_single_classes(spark):
    same = spark.range(5).select(F.lit(2.0).alias("v"), F.lit(1).alias("y"), F.col("id").cast("double").alias("s"))
    assert [tuple(r) for r in A.histogram(same, "v", 4).collect()] == [(0, 5)]
    assert A.histogram(same.limit(0), "v", 4).count() == 0
    one = M.area_under_curves(same, "y", "s").first()
    assert one["auc"] is None and one["pr_auc"] == 1.0
    ratings = spark.createDataFrame([(1, 1, 0.0), (2, 1, 3.0), (3, 1, 4.0)], "user INT, item INT, rating DOUBLE")
    assert {(r["a"], r["b"]) for r in R.user_similarity(ratings).collect()} == {(2, 3), (3, 2)}


def test_shuffle_column_follows_the_hash_and_stores_nothing(spark, monkeypatch):
    import hashlib

    stored, write = [], scaling.materialise
    monkeypatch.setattr(scaling, "materialise", lambda df: stored.append(1) or write(df))
    rows = spark.createDataFrame([(i, i * 10, "a") for i in range(300)] + [(None, -1, "b")], "id long, x long, g string")
    got = {(r["id"], r["g"]): r["x"] for r in ML.shuffle_column(rows, "x", ["id"], 5).collect()}

    def order(seed):
        ids = [None, *range(300)]
        return sorted(ids, key=lambda i: int(hashlib.md5((f"{seed}" if i is None else f"{i}:{seed}").encode()).hexdigest()[:8], 16))

    value = lambda i: -1 if i is None else i * 10
    assert got == {(i, "b" if i is None else "a"): value(j) for i, j in zip(order(5), order(5 + 7919))}
    assert not stored


def test_core_numbers_reads_neighbours_as_bounded_lists(spark, hub_graph, monkeypatch):
    def cores():
        return {r["node"]: r["core"] for r in G.core_numbers(graph(spark, hub_graph)).collect()}

    want, kept, write = cores(), [], G.materialise
    monkeypatch.setattr(G, "materialise", lambda df: kept.append(write(df)) or kept[-1])
    monkeypatch.setattr(G, "hot_keys", lambda rows, on: scaling.hot_keys(rows, on, 8), raising=False)
    assert cores() == want
    lists = [f for f in kept if "srcs" in f.columns]
    sizes = [r["n"] for f in lists for r in f.select(F.size("srcs").alias("n")).collect()]
    assert sizes and 1 < max(sizes) < max(r["n"] for r in lists[0].groupBy("dst").agg(F.sum(F.size("srcs")).alias("n")).collect())
    assert sum(sizes) > len(sizes)


def test_permutation_importance_scores_every_column_in_every_repeat(spark):
    rows = spark.createDataFrame([(i, float(i), float(i % 7), 1.0) for i in range(200)], "id long, x double, y double, same double")
    seen = []

    def score(df):
        seen.append([tuple(r) for r in df.orderBy("id").collect()])
        return df.select(F.avg(F.abs(F.col("x") - F.col("id")) + F.abs(F.col("y") - F.col("id") % 7)).alias("e")).first()["e"]

    out = {r["feature"]: r for r in ML.permutation_importance(rows, score, ["x", "y", "same"], ["id"], repeats=4).collect()}
    assert len(seen) == 1 + 3 * 4 and len({tuple(s) for s in seen}) == 1 + 2 * 4
    for i, shuffled in enumerate(seen[1:]):  # one column of a repeat is permuted, the others are as they were
        for c, (before, after) in enumerate(zip(zip(*seen[0]), zip(*shuffled))):
            assert sorted(before) == sorted(after) and (before == after) == (c != 1 + i % 3 or c == 3)
    assert out["x"]["importance"] > out["y"]["importance"] > 0 and out["x"]["deviation"] > 0
    assert out["same"]["importance"] == 0 == out["same"]["deviation"]


def test_permutation_importance_of_lines_repeats_its_shuffles(spark):
    import __spark_entry__ as entry

    found = entry.queries()["ml19_permutation_importance"](spark, "/root/testdata/sf0.001").collect()
    assert all(r["deviation"] > 0 for r in found)
