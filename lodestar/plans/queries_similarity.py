"""Recommendation, neighbours and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import clustering as K
from lodestar.operators import linkage as LK
from lodestar.operators import metrics as M
from lodestar.operators import neighbours as N
from lodestar.operators import recommend as R
from lodestar.operators.rows import split_per_user
from lodestar.operators.scaling import materialise
from lodestar.plans.graphs import RATINGS_SQL, ratings
from lodestar.plans.queries_text import POS_SQL, plain_tokens
from lodestar.plans.registry import query

_SIMS_SQL = (
    f"r AS MATERIALIZED ({RATINGS_SQL}), u AS MATERIALIZED (SELECT \"user\", item, rating / sqrt(sum(rating * rating) OVER (PARTITION BY \"user\")) AS v FROM {{source}}), "
    "s AS MATERIALIZED (SELECT x.\"user\" AS a, y.\"user\" AS b, sum(x.v * y.v) AS similarity FROM u x JOIN u y USING (item) WHERE x.\"user\" <> y.\"user\" GROUP BY ALL)"
)


@query("r01_user_similarity", f"WITH {_SIMS_SQL.format(source='r')} SELECT a, b, round(similarity, 7) AS similarity FROM s")
def _(t):
    return R.user_similarity(ratings(t)).withColumn("similarity", F.round("similarity", 7))


@query("r01_similar_users", f"WITH {_SIMS_SQL.format(source='r')} SELECT a, b, round(similarity, 7) AS similarity FROM s WHERE similarity >= 0.12")
def _(t):
    return R.similar_users(ratings(t), 0.12).withColumn("similarity", F.round("similarity", 7))


@query(
    "r01_most_similar_users",
    f"WITH {_SIMS_SQL.format(source='r')} SELECT a, b, round(similarity, 9) AS similarity, CAST(row_number() OVER (PARTITION BY a ORDER BY round(similarity, 9) DESC, b) AS INT) AS rank FROM s WHERE similarity >= 0.15 QUALIFY rank <= 3",
)
def _(t):
    return R.most_similar_users(ratings(t), 3, 0.15)


def _split(t):
    parts = materialise(split_per_user(ratings(t), "user", ["item"]))
    return parts.where("part = 'base'").drop("part"), parts.where("part = 'test'").drop("part")


_SPLIT_SQL = (
    "p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY \"user\" ORDER BY item) AS rn FROM r), base AS MATERIALIZED (SELECT * FROM p WHERE rn > 10), test AS (SELECT * FROM p WHERE rn <= 10)"
)
_PREDICT_SQL = (
    f"WITH {_SIMS_SQL.format(source='base').replace('u AS MATERIALIZED', _SPLIT_SQL + ', u AS MATERIALIZED', 1)}, "
    "g AS (SELECT test.\"user\" AS \"user\", test.item AS item, sum(similarity * base.rating) AS top, sum(similarity) AS bottom FROM test JOIN base USING (item) JOIN s ON a = test.\"user\" AND b = base.\"user\" GROUP BY ALL), "
    "o AS (SELECT \"user\", item, test.rating AS rating, coalesce(top / nullif(bottom, 0), 2.5) AS prediction FROM test LEFT JOIN g USING (\"user\", item)) "
)


@query("r02_predict_ratings", _PREDICT_SQL + "SELECT \"user\", item, round(prediction, 6) AS prediction FROM o")
def _(t):
    base, test = _split(t)
    return R.predict_asked(base, test).withColumn("prediction", F.round("prediction", 6))


@query("r03_factorise")
def _(t):
    base, test = _split(t)
    cast = lambda df: df.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"), F.col("rating").cast("float").alias("rating"))
    model = R.factorise(cast(base), 3, 5)
    return M.regression_errors(R.predict_factors(model, cast(test)), "rating", "prediction").select("n", "mae", "rmse")


@query(
    "r04_rating_rmse",
    _PREDICT_SQL + "SELECT count(*) AS n, round(sqrt(avg((rating - prediction) ** 2)), 6) AS rmse, round(avg(abs(rating - prediction)), 6) AS mae FROM o",
)
def _(t):
    base, test = _split(t)
    scored = R.predict_asked(base, test).join(test, ["user", "item"])
    return M.regression_errors(scored, "rating", "prediction").select("n", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"))


@query("k01_kmeans")
def _(t):
    rows = K.as_vector(t.embeddings, "embedding")
    return K.kmeans(rows, "features", 10).transform(rows).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("k01_kmeans_centres")
def _(t):
    model = K.kmeans(K.as_vector(t.embeddings, "embedding"), "features", 10)
    return K.kmeans_centres(model, t.spark).select("cluster", F.size("centre").alias("dims"))


@query("k02_kmeans_sweep")
def _(t):
    return K.kmeans_sweep(K.as_vector(t.embeddings, "embedding"), "features", [2, 4, 8, 16])


@query(
    "k02_cluster_profile",
    "SELECT label AS cluster, count(*) AS size, round(avg(embedding[1]::DOUBLE), 7) AS mean_x, round(avg(embedding[2]::DOUBLE), 7) AS mean_y FROM embeddings GROUP BY label",
)
def _(t):
    rows = t.embeddings.select(F.col("label").alias("cluster"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    out = K.cluster_profile(rows, "cluster", ["x", "y"])
    return out.withColumns({c: F.round(c, 7) for c in ("mean_x", "mean_y")})


@query("k03_bisecting_clusters")
def _(t):
    rows = K.as_vector(t.embeddings, "embedding")
    return K.bisecting_clusters(rows, "features", 5).transform(rows).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k03_ward_heights",
    "WITH e AS (SELECT vec_id, i, embedding[i]::DOUBLE AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i)), v AS (SELECT i, sum(x * x) - sum(x) * sum(x) / count(*) AS ss FROM e GROUP BY i) "
    "SELECT (SELECT count(*) - 1 FROM embeddings) AS merges, (SELECT count(*) FROM embeddings) AS largest, round(sum(ss), 6) AS scatter FROM v",
)
def _(t):
    # half the sum of the squared heights of Ward's merges is the scatter of all rows
    merges = LK.linkage(t.embeddings, "vec_id", "embedding")
    return merges.agg(F.count(F.lit(1)).alias("merges"), F.max("size").alias("largest"), F.round(F.sum(F.col("height") * F.col("height")) / 2, 6).alias("scatter"))


@query("k03_ward_clusters")
def _(t):
    rows = t.embeddings
    return LK.cut(rows, "vec_id", LK.linkage(rows, "vec_id", "embedding"), 5)


_GEO = "SELECT vec_id AS id, embedding[1]::DOUBLE AS lat, embedding[2]::DOUBLE AS lon, embedding[3]::DOUBLE AS f1, embedding[4]::DOUBLE AS f2, embedding[5]::DOUBLE AS f3, label::DOUBLE AS price FROM embeddings"
_PAIRS_SQL = (
    f"WITH v AS ({_GEO}), p AS (SELECT a.id AS q, b.id AS b, b.price, (a.f1 * b.f1 + a.f2 * b.f2 + a.f3 * b.f3) / (sqrt(a.f1 ** 2 + a.f2 ** 2 + a.f3 ** 2) * sqrt(b.f1 ** 2 + b.f2 ** 2 + b.f3 ** 2)) AS c, "
    "sqrt((a.lat - b.lat) ** 2 + (a.lon - b.lon) ** 2) AS d FROM v a CROSS JOIN v b)"
)


def _geo(t):
    e = lambda i: F.col("embedding")[i].cast("double")
    return t.embeddings.select(
        F.col("vec_id").alias("id"), e(0).alias("lat"), e(1).alias("lon"), e(2).alias("f1"), e(3).alias("f2"), e(4).alias("f3"), F.col("label").cast("double").alias("price")
    )


@query(
    "k04_geo_knn",
    f"{_PAIRS_SQL}, r AS (SELECT q, price, row_number() OVER (PARTITION BY q ORDER BY round(0.5 * c - 0.5 * d, 9) DESC, b) AS rn FROM p) SELECT q AS id, median(price) AS prediction FROM r WHERE rn <= 20 GROUP BY q",
)
def _(t):
    rows = _geo(t)
    return N.geo_knn(rows, rows, "id", ["lat", "lon"], ["f1", "f2", "f3"], "price", 0.5, 20)


@query(
    "k05_geo_neighbours",
    f"{_PAIRS_SQL}, g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(d, 9), b) AS rn FROM p) WHERE rn <= 30), r AS (SELECT q, b, round(c, 9) AS score, row_number() OVER (PARTITION BY q ORDER BY round(c, 9) DESC, b) AS rank FROM g) "
    "SELECT q AS query_id, b AS base_id, score, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5",
)
def _(t):
    rows = _geo(t)
    return N.geo_neighbours(rows, rows, "id", ["lat", "lon"], ["f1", "f2", "f3"], 30, 5)


def _centroid_sql(agg: str) -> str:
    return (
        f"WITH c AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i)), m AS (SELECT label, i, {agg}(x) AS x FROM c GROUP BY ALL), "
        "d AS (SELECT c.vec_id, m.label, round(sqrt(sum((c.x - m.x) ** 2)), 9) AS d FROM c JOIN m USING (i) GROUP BY ALL) SELECT vec_id AS id, label AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS rn FROM d) WHERE rn = 1"
    )


@query("k06_nearest_centroid", _centroid_sql("avg"))
def _(t):
    return N.nearest_centroid(t.embeddings, t.embeddings, "label", "embedding", "vec_id")


@query("k06_nearest_centroid_median", _centroid_sql("median"))
def _(t):
    return N.nearest_centroid(t.embeddings, t.embeddings, "label", "embedding", "vec_id", "median")


_KNN_SQL = (
    "WITH c AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings), r AS (SELECT a.vec_id AS q, b.label AS y, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_distance(a.e, b.e), 9), b.vec_id) AS rn FROM c a CROSS JOIN c b) "
)


@query("k07_knn_regression", _KNN_SQL + "SELECT q AS id, round(avg(y), 9) AS prediction FROM r WHERE rn <= 7 GROUP BY q")
def _(t):
    rows = t.embeddings
    return N.knn(rows, rows, "vec_id", "embedding", "label", 7).withColumn("prediction", F.round("prediction", 9))


@query(
    "k07_knn_classification",
    _KNN_SQL + "SELECT q AS id, y AS prediction FROM (SELECT q, y, row_number() OVER (PARTITION BY q ORDER BY count(*) DESC, y) AS place FROM r WHERE rn <= 7 GROUP BY q, y) WHERE place = 1",
)
def _(t):
    rows = t.embeddings
    return N.knn(rows, rows, "vec_id", "embedding", "label", 7, classify=True)


_PCA = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("ml01_pca")
def _(t):
    axes, rows = K.pca(t.lineitem, _PCA, 2, "l_orderkey")
    return axes.select("axis", F.round("share", 6).alias("share"), F.round("eigenvalue", 6).alias("eigenvalue"))


@query("ml01_axis_correlations")
def _(t):
    _, rows = K.pca(t.lineitem, _PCA, 2, "l_orderkey")
    return K.axis_correlations(rows, _PCA, 2).select("variable", "axis", F.round(F.abs("value"), 6).alias("value"), F.round("cos2", 6).alias("cos2"))


_TWO = ["l_quantity", "l_extendedprice"]


@query(
    "ml01_pca_two",
    "WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem) SELECT 1 AS axis, round((1 + r) / 2, 6) AS share, round(1 + r, 6) AS eigenvalue FROM r UNION ALL SELECT 2, round((1 - r) / 2, 6), round(1 - r, 6) FROM r",
)
def _(t):
    axes, _ = K.pca(t.lineitem, _TWO, 2, "l_orderkey")
    return axes.select("axis", F.round("share", 6).alias("share"), F.round("eigenvalue", 6).alias("eigenvalue"))


@query(
    "ml01_axis_correlations_two",
    "WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem) SELECT variable, 'axis1' AS axis, round((1 + r) / 2, 6) AS cos2 FROM r, (SELECT unnest(['l_quantity', 'l_extendedprice']) AS variable) UNION ALL SELECT variable, 'axis2', round((1 - r) / 2, 6) FROM r, "
    "(SELECT unnest(['l_quantity', 'l_extendedprice']) AS variable)",
)
def _(t):
    _, rows = K.pca(t.lineitem, _TWO, 2, "l_orderkey")
    return K.axis_correlations(rows, _TWO, 2).select("variable", "axis", F.round("cos2", 6).alias("cos2"))


@query("ml02_lsa")
def _(t):
    from lodestar.operators.textmining import tfidf_hashed

    features, _ = tfidf_hashed(t.documents, t.documents.limit(0), "text")
    _, rows = K.lsa(features, "doc_id", "features", 5)
    return rows.select(F.col("id").alias("doc_id"), *[F.round(F.get("axes", F.lit(i)), 5).alias(f"axis{i + 1}") for i in range(5)])


def _leading_axis_sql(rounds: int) -> str:
    """Power iteration; the second singular value of these weights is below two thirds of the first."""
    steps = ["v0 AS (SELECT DISTINCT word, 1.0::DOUBLE AS v FROM w)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"y{i} AS MATERIALIZED (SELECT doc, sum(tfidf * v) AS y FROM w JOIN v{i - 1} USING (word) GROUP BY doc), z{i} AS MATERIALIZED (SELECT word, sum(tfidf * y) AS z FROM w JOIN y{i} USING (doc) GROUP BY word), "
            f"v{i} AS MATERIALIZED (SELECT word, z / (SELECT sqrt(sum(z * z)) FROM z{i}) AS v FROM z{i})"
        )
    return ", ".join(steps)


@query(
    "ml02_lsa_leading",
    f"WITH p AS ({POS_SQL}), c AS (SELECT doc, word, count(*) AS n, max(size) AS size FROM p GROUP BY ALL), d AS (SELECT word, count(*) AS df FROM c GROUP BY word), "
    f"w AS MATERIALIZED (SELECT doc, word, n / size * (ln((SELECT count(*) FROM documents) / df) + 1) AS tfidf FROM c JOIN d USING (word)), {_leading_axis_sql(32)}, "
    "a AS MATERIALIZED (SELECT doc, sum(tfidf * v) AS x FROM w JOIN v32 USING (word) GROUP BY doc) SELECT doc AS doc_id, round(x, 5) AS axis1, round((SELECT sqrt(sum(x * x)) FROM a), 5) AS singular FROM a",
)
def _(t):
    from lodestar.operators.textmining import tfidf

    weights = tfidf(plain_tokens(t), "doc_id", "tokens").withColumnRenamed("tfidf", "weight")
    singular, rows = K.lsa_weights(weights, 1, tol=1e-13)
    first = singular.first()
    return rows.select(
        F.col("id").alias("doc_id"), F.round(F.get("axes", F.lit(0)), 5).alias("axis1"), F.round(F.lit(first["singular"] if first else None).cast("double"), 5).alias("singular")
    )


def _scaled(t, kind):
    out = K.scale_expressions(t.lineitem, ["l_quantity", "l_extendedprice"], kind)
    return out.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.round("l_quantity_s", 6).alias("q"), F.round("l_extendedprice_s", 6).alias("p")
    )


def _scale_sql(centre: str, width: str) -> str:
    q, p = ([f.format(c) for f in (centre, width)] for c in ("l_quantity", "l_extendedprice"))
    return (
        "SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - qc) / qw, 6) AS q, round((l_extendedprice - pc) / pw, 6) AS p FROM lineitem, "
        f"(SELECT {q[0]} AS qc, {q[1]} AS qw, {p[0]} AS pc, {p[1]} AS pw FROM lineitem)"
    )


@query("ml25_scale_standard", _scale_sql("avg({0})", "stddev_pop({0})"))
def _(t):
    return _scaled(t, "standard")


@query("ml25_scale_robust", _scale_sql("median({0})", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"))
def _(t):
    return _scaled(t, "robust")


@query("ml25_scale_minmax", _scale_sql("min({0})", "max({0}) - min({0})"))
def _(t):
    return _scaled(t, "minmax")


@query(
    "ml25_scale_unit",
    "SELECT l_orderkey, l_partkey, l_linenumber, round(l_quantity / sqrt(l_quantity ** 2 + l_extendedprice ** 2), 6) AS q, round(l_extendedprice / sqrt(l_quantity ** 2 + l_extendedprice ** 2), 6) AS p FROM lineitem",
)
def _(t):
    return _scaled(t, "unit")


