"""Train, tune and score queries. Fits are checked by rows and by tests; plain aggregates have SQL."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lodestar.functions.text import decode_tags
from lodestar.operators import boosting as BO
from lodestar.operators import groupmodels as GM
from lodestar.operators import metrics as M
from lodestar.operators import models as ML
from lodestar.operators import robust as RB
from lodestar.operators.clustering import as_vector, assemble
from lodestar.operators.rows import split_weights
from lodestar.operators.scaling import materialise, union_all
from lodestar.operators.textmining import tfidf_hashed
from lodestar.plans.queries_rows import fraction_sql
from lodestar.plans.registry import query

_NUM = ["l_quantity", "l_discount", "l_tax"]
_KEYS = ["row_id"]


def _lines(t):
    """Order lines with a row key, the price as label and assembled numbers."""
    rows = t.lineitem.select(
        F.xxhash64(*t.lineitem.columns).alias("row_id"), F.col("l_extendedprice").alias("label"), *_NUM, "l_returnflag", "l_linestatus"
    )
    return assemble(rows, _NUM)


def _parts(df, keys, weights=(0.8, 0.2)):
    stored = materialise(df)
    return split_weights(stored, keys, list(weights))


def _posts(t, num_features=256):
    """Labelled documents as TF-IDF vectors with quality and toxic flags and their code."""
    rows = t.documents.join(t.labels, "doc_id").select(
        "doc_id", "text", "quality", "toxic", F.concat(F.col("quality").cast("string"), F.col("toxic").cast("string")).alias("code")
    )
    train, test = split_weights(rows, ["doc_id"], [0.8, 0.2])
    fitted = tfidf_hashed(train, test, "text", num_features)
    return [materialise(part.drop("text")) for part in fitted]


def _vectors(t):
    """Embeddings with the class label, scaled to [0, 1]."""
    rows = as_vector(t.embeddings, "embedding", "raw").select("vec_id", F.col("label").cast("double").alias("label"), "raw")
    scaled = MinMaxScaler(inputCol="raw", outputCol="features").fit(rows).transform(rows)
    return _parts(scaled.drop("raw"), ["vec_id"])


def _accuracy(scored, label="label", predicted="prediction"):
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"))


def _errors(scored):
    return M.regression_errors(scored, "label", "prediction").select("n", "mae", "rmse", "mape")


_ORDERS_SQL = (
    "SELECT o_orderkey AS id, o_orderstatus AS status, qty, price FROM orders JOIN (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS qty, sum(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey) USING (o_orderkey)"
)


def _orders(t):
    """Orders with their total quantity as feature and the price of their lines as label."""
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("label"))
    rows = t.orders.select("o_orderkey", "o_orderstatus").join(sums, "o_orderkey")
    return assemble(rows.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "qty", "label"), ["qty"])


def _split_sql(seed: int = 42, share: float = 0.8) -> str:
    return f"o AS MATERIALIZED ({_ORDERS_SQL}), tr AS (SELECT * FROM o WHERE {fraction_sql('id', seed)} < {share}), te AS (SELECT * FROM o WHERE {fraction_sql('id', seed)} >= {share})"


@query("ml03_logistic_per_label")
def _(t):
    train, test = _posts(t)
    out = ML.fit_per_label(train, test, ["quality", "toxic"], lambda tag: ML.logistic(tag, maxIter=10, regParam=0.01))
    return out.select("doc_id", "quality_pred", "toxic_pred")


@query("ml04_tag_code")
def _(t):
    train, test = _posts(t)
    out = ML.fit_tag_code(train, test, "code", ML.logistic(multinomial=True, maxIter=10, regParam=0.01))
    return out.select("doc_id", "predicted_code", F.array_join(decode_tags("predicted_code", ["quality", "toxic"]), ",").alias("tags"))


@query("ml05_one_vs_rest")
def _(t):
    train, test = _vectors(t)
    return _accuracy(ML.one_vs_rest().fit(train).transform(test))


_NB_SQL = (
    f"WITH c AS (SELECT vec_id, label, i, embedding[i]::DOUBLE AS raw FROM embeddings, (SELECT unnest(range(1, 65)) AS i)), b AS (SELECT i, min(raw) AS lo, max(raw) AS hi FROM c GROUP BY i), x AS MATERIALIZED (SELECT vec_id, label, i, (raw - lo) / (hi - lo) AS x, {fraction_sql('vec_id')} < 0.8 AS tr FROM c JOIN b USING (i)), "
    "n AS (SELECT label, count(DISTINCT vec_id) AS n FROM x WHERE tr GROUP BY label), k AS (SELECT count(*) AS k, sum(n) AS total FROM n), s AS (SELECT label, i, sum(x) AS s FROM x WHERE tr GROUP BY ALL), f AS (SELECT label, i, ln((s + 1) / (sum(s) OVER (PARTITION BY label) + 64)) AS theta FROM s), "
    "g AS (SELECT x.vec_id, f.label, round(max(ln((n.n + 1) / (total + k))) + sum(x * theta), 9) AS score FROM x JOIN f USING (i) JOIN n ON n.label = f.label, k WHERE NOT tr GROUP BY ALL) SELECT vec_id, CAST(arg_max(label, score) AS DOUBLE) AS prediction FROM g GROUP BY vec_id"
)


@query("ml06_naive_bayes", _NB_SQL)
def _(t):
    train, test = _vectors(t)
    return ML.naive_bayes().fit(train).transform(test).select("vec_id", "prediction")


_GAUSS_SQL = (
    _NB_SQL[: _NB_SQL.index("n AS (")]
    + "n AS (SELECT label, count(DISTINCT vec_id) AS n FROM x WHERE tr GROUP BY label), e AS (SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(x) AS v FROM x WHERE tr GROUP BY i)), "
    "f AS (SELECT label, i, avg(x) AS m, var_pop(x) + max(e) AS v FROM x, e WHERE tr GROUP BY ALL), "
    "g AS (SELECT x.vec_id, x.label, f.label AS guess, max(ln(n.n)) + sum(-0.5 * ln(v) - (x - m) ** 2 / (2 * v)) AS score FROM x JOIN f USING (i) JOIN n ON n.label = f.label WHERE NOT tr GROUP BY ALL), "
    "h AS (SELECT vec_id, label, arg_max(guess, score) AS guess FROM g GROUP BY ALL) SELECT count(*) AS n, avg(CASE WHEN guess = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM h"
)


@query("ml06_gaussian_bayes", _GAUSS_SQL)
def _(t):
    train, test = _vectors(t)
    return _accuracy(ML.naive_bayes(kind="gaussian").fit(train).transform(test))


@query("ml07_tree_classifiers")
def _(t):
    train, test = _vectors(t)
    out = None
    for kind in ("tree", "forest", "bagging"):
        params = {"maxDepth": 5} if kind == "tree" else {"maxDepth": 5, "numTrees": 5}
        part = _accuracy(ML.trees(kind, "classify", **params).fit(train).transform(test)).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("ml07_boosted_classifier")
def _(t):
    two_classes = F.when(F.col("label") >= 5, 1.0).otherwise(0.0)
    train, test = (part.withColumn("label", two_classes) for part in _vectors(t))
    model = ML.trees("boosted", "classify", maxDepth=5, maxIter=10).fit(train)
    return _accuracy(model.transform(test)).withColumn("kind", F.lit("boosted"))


@query("ml07_tree_regressors")
def _(t):
    train, test = _parts(_lines(t), _KEYS)
    out = None
    for kind in ("tree", "forest"):
        params = {"maxDepth": 4} if kind == "tree" else {"maxDepth": 4, "numTrees": 5}
        part = _errors(ML.trees(kind, "regress", **params).fit(train).transform(test)).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("ml08_boosted_regressor")
def _(t):
    train, test = _parts(_lines(t), _KEYS)
    return _errors(ML.trees("boosted", "regress", maxDepth=3, maxIter=4).fit(train).transform(test))


@query("ml08_leafwise_mean", "SELECT count(*) AS n, round(avg(l_extendedprice), 4) AS mean, true AS better FROM lineitem")
def _(t):
    # without a ridge a squared loss keeps the mean, and every tree lowers the error
    rows = t.lineitem.select(*_NUM, "l_linenumber", "l_extendedprice")
    model = BO.fit_leafwise(rows, [*_NUM, "l_linenumber"], "l_extendedprice", trees=5, leaves=15, rate=0.3)
    off = F.avg(F.pow(F.col("prediction") - F.col("l_extendedprice"), 2))
    return model.predict(rows).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 4).alias("mean"), (off < F.var_pop("l_extendedprice")).alias("better")
    )


@query("ml09_perceptron")
def _(t):
    train, test = _vectors(t)
    return _accuracy(ML.perceptron([64, 16, 10], maxIter=20).fit(train).transform(test))


@query("ml10_linear_family")
def _(t):
    stored = materialise(_lines(t).select(*_KEYS, "label", "features"))
    train, test = split_weights(stored, _KEYS, [0.8, 0.2])
    kinds = [("plain", 0.0), ("ridge", 0.1), ("lasso", 0.1), ("lasso", 10.0)]
    # one pass scores the rows with every model
    scored = test
    for i, (kind, alpha) in enumerate(kinds):
        scored = ML.linear(kind=kind, alpha=alpha).fit(train).setPredictionCol(f"p{i}").transform(scored)
    named = ["n", "mae", "rmse", "mape"]
    return M.errors_of_several(scored, "label", [f"p{i}" for i in range(len(kinds))], named, [(F.lit(k).alias("kind"), F.lit(a).alias("alpha")) for k, a in kinds])


@query(
    "ml10_linear_one_feature",
    f"WITH {_split_sql()}, m AS (SELECT regr_slope(price, qty) AS a, regr_intercept(price, qty) AS b FROM tr) SELECT count(*) AS n, round(avg(abs(a * qty + b - price)), 2) AS mae, round(sqrt(avg((a * qty + b - price) ** 2)), 2) AS rmse FROM te, m",
)
def _(t):
    train, test = _parts(_orders(t), ["id"])
    out = _errors(ML.linear().fit(train).transform(test))
    return out.select("n", F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"))


@query("ml11_huber")
def _(t):
    train, test = _parts(_lines(t), _KEYS)
    return _errors(ML.linear(kind="huber", maxIter=20).fit(train).transform(test))


_PLANTED = "CASE WHEN l_linenumber = 1 THEN l_extendedprice ELSE 10 + 3 * l_quantity - 200 * l_discount END"


def _planted(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", F.expr(_PLANTED).alias("y"))


def _coefficients(t, beta, *more):
    row = t.spark.range(1).select(*[F.lit(round(b, 6) + 0.0).alias(f"b{i}") for i, b in enumerate(beta)], *more)
    return row


@query(
    "ml11_ransac",
    f"SELECT 10.0::DOUBLE AS b0, 3.0::DOUBLE AS b1, -200.0::DOUBLE AS b2, count(*) AS inliers FROM lineitem WHERE abs({_PLANTED} - (10 + 3 * l_quantity - 200 * l_discount)) <= 1e-6",
)
def _(t):
    beta, _, inliers = RB.ransac(_planted(t), ["l_quantity", "l_discount"], "y", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], threshold=1e-6)
    return _coefficients(t, beta, F.lit(inliers.count()).cast("long").alias("inliers"))


@query("ml11_theil_sen", "SELECT 10.0::DOUBLE AS b0, 3.0::DOUBLE AS b1 FROM (SELECT count(*) AS n FROM lineitem) WHERE n > 1")
def _(t):
    line = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.when(F.col("l_linenumber") == 1, F.col("l_extendedprice")).otherwise(10 + 3 * F.col("l_quantity")).alias("y"),
    )
    return _coefficients(t, RB.theil_sen(line, ["l_quantity"], "y", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], subsets=2_000))


@query("ml12_inliers_split")
def _(t):
    kept = ML.inliers_split(_lines(t).dropDuplicates(_KEYS), ML.linear(), "label", _KEYS)
    return kept.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("mean"))


@query("ml13_discriminants")
def _(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", *_NUM, "l_extendedprice")
    columns = [*_NUM, "l_extendedprice"]
    out = None
    for kind, shared in (("linear", True), ("quadratic", False)):
        scored = ML.discriminant(rows, rows, "l_returnflag", columns, shared)
        part = _accuracy(scored, "l_returnflag", "predicted").withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "ml13_discriminant_one_feature",
    f"WITH o AS ({_ORDERS_SQL}), c AS (SELECT status, count(*) / (SELECT count(*) FROM o) AS p, avg(qty) AS m, var_pop(qty) AS v FROM o GROUP BY status), w AS (SELECT sum(p * v) AS v FROM c), "
    "s AS (SELECT id, c.status, ln(p) - 0.5 * ln(c.v) - 0.5 * (qty - m) ** 2 / c.v AS q, ln(p) - 0.5 * ln(w.v) - 0.5 * (qty - m) ** 2 / w.v AS l FROM o, c, w) SELECT id, arg_max(status, q) AS quadratic, arg_max(status, l) AS linear FROM s GROUP BY id",
)
def _(t):
    rows = _orders(t).select("id", "status", "qty")
    linear = ML.discriminant(rows, rows, "status", ["qty"], True, ridge=0.0).withColumnRenamed("predicted", "linear")
    both = ML.discriminant(rows, linear, "status", ["qty"], False, ridge=0.0)
    return both.select("id", F.col("predicted").alias("quadratic"), "linear")


@query("ml14_linear_svm")
def _(t):
    train, test = _posts(t)
    model = ML.linear_svm("quality", maxIter=10, regParam=0.1).fit(train)
    return _accuracy(model.transform(test), "quality")


@query("ml15_poly2")
def _(t):
    rows = ML.poly2().transform(_lines(t))
    train, test = _parts(rows, _KEYS)
    return _errors(ML.linear(features="poly").fit(train).transform(test))


@query(
    "ml15_assemble_poly2",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity AS p1, round(l_quantity * l_quantity, 4) AS p2, round(l_discount, 4) AS p3, round(l_quantity * l_discount, 4) AS p4, round(l_discount * l_discount, 4) AS p5 FROM lineitem",
)
def _(t):
    rows = ML.poly2().transform(assemble(t.lineitem, ["l_quantity", "l_discount"])).withColumn("v", vector_to_array("poly"))
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", *[F.round(F.col("v")[i], 4).alias(f"p{i + 1}") for i in range(5)])


_MIXED_SQL = (
    f"WITH o AS MATERIALIZED (SELECT o_orderkey AS id, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, o_orderpriority AS kind FROM orders), tr AS (SELECT * FROM o WHERE {fraction_sql('id')} < 0.8), te AS (SELECT * FROM o WHERE {fraction_sql('id')} >= 0.8), "
    "m AS (SELECT avg(price) AS m FROM tr), s AS (SELECT stddev_samp(coalesce(price, m)) AS s FROM tr, m), k AS (SELECT kind, stddev_samp(f) AS s FROM (SELECT k.kind, CAST(tr.kind = k.kind AS INT) AS f FROM tr, (SELECT DISTINCT kind FROM tr) k) GROUP BY kind) "
    "SELECT id, round(coalesce(price, m) / s.s, 6) AS price, round(1 / k.s, 6) AS kind FROM te, m, s JOIN k ON te.kind = k.kind"
)


@query(
    "ml16_mixed_features",
    _MIXED_SQL.replace("FROM te, m, s JOIN k ON te.kind = k.kind", "FROM te JOIN k ON te.kind = k.kind CROSS JOIN m CROSS JOIN s"),
)
def _(t):
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"), F.col("o_orderpriority").alias("kind")
    )
    train, test = split_weights(rows, ["id"], [0.8, 0.2])
    out = ML.mixed_pipeline(["price"], ["kind"]).fit(train).transform(test).withColumn("v", vector_to_array("features"))
    hot = F.array_max(F.slice("v", 2, 100))
    return out.select("id", F.round(F.col("v")[0], 6).alias("price"), F.round(hot, 6).alias("kind"))


@query("ml16_mixed_preprocessing")
def _(t):
    rows = t.lineitem.select(
        F.xxhash64(*t.lineitem.columns).alias("row_id"), F.col("l_extendedprice").alias("label"), "l_returnflag", "l_linestatus",
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("l_tax"), "l_quantity",
    )
    train, test = _parts(rows, _KEYS)
    model = ML.mixed_pipeline(["l_quantity", "l_tax"], ["l_returnflag", "l_linestatus"]).fit(train)
    fitted = ML.linear().fit(model.transform(train))
    return _errors(fitted.transform(model.transform(test)))


@query("ml17_grid_search")
def _(t):
    estimator = ML.trees("tree", "regress")
    maps = ML.grid(estimator, {"maxDepth": [2, 4], "minInstancesPerNode": [5, 50]})
    _, table = ML.grid_search(_lines(t), estimator, maps, RegressionEvaluator(metricName="mae"), _KEYS, folds=2)
    return table


@query("ml17_f1_search")
def _(t):
    estimator = ML.trees("tree", "classify")
    maps = ML.grid(estimator, {"maxDepth": [3, 5]})
    rows = union_all(_vectors(t))
    _, table = ML.grid_search(rows, estimator, maps, MulticlassClassificationEvaluator(metricName="f1"), ["vec_id"], folds=5, seed=7)
    return table


@query("ml17_auc_search")
def _(t):
    two_classes = F.when(F.col("label") >= 5, 1.0).otherwise(0.0)
    rows = union_all(_vectors(t)).withColumn("label", two_classes)
    estimator = ML.logistic(maxIter=20)
    maps = ML.grid(estimator, {"regParam": [0.001, 0.01, 0.1, 1.0]})
    _, table = ML.grid_search(rows, estimator, maps, BinaryClassificationEvaluator(metricName="areaUnderROC"), ["vec_id"], folds=5)
    return table.withColumns({c: F.round(c, 6) for c in ("score", "score_std")})


@query("ml17_random_search")
def _(t):
    estimator = ML.linear(kind="ridge")
    maps = ML.random_grid(estimator, {"regParam": [0.0, 0.1, 1.0, 10.0], "elasticNetParam": [0.0, 0.5, 1.0]}, 3)
    _, table = ML.grid_search(_lines(t), estimator, maps, M.MapeEvaluator(), _KEYS, folds=2)
    return table


def _folds_sql(folds: int) -> str:
    return (
        f"o AS MATERIALIZED (SELECT *, CAST(floor({fraction_sql('id')} * {folds}) AS INT) AS fold FROM ({_ORDERS_SQL})), m AS (SELECT f.fold, regr_slope(price, qty) AS a, regr_intercept(price, qty) AS b FROM o JOIN (SELECT DISTINCT fold FROM o) f ON o.fold <> f.fold GROUP BY f.fold), "
        "p AS (SELECT id, fold, price, a * qty + b AS prediction FROM o JOIN m USING (fold)), e AS (SELECT fold, count(*) AS n, avg(abs(prediction - price)) AS mae FROM p GROUP BY fold) "
    )


@query(
    "ml17_cross_val_scores",
    f"WITH {_folds_sql(3)} SELECT round(min(mae), 2) AS min, round(avg(mae), 2) AS mean, round(max(mae), 2) AS max, round(stddev_pop(mae), 2) AS std FROM e",
)
def _(t):
    out = ML.cross_val_scores(_orders(t), ML.linear(), "label", ["id"], folds=3)
    return out.select(*[F.round(c, 2).alias(c) for c in out.columns])


@query(
    "ml18_learning_curve",
    f"WITH o AS MATERIALIZED (SELECT *, {fraction_sql('id')} < 0.2 AS te, {fraction_sql('id', 43)} AS u FROM ({_ORDERS_SQL})), f AS (SELECT unnest([0.1, 0.5, 1.0])::DOUBLE AS fraction), m AS (SELECT fraction, count(*) AS n, regr_slope(price, qty) AS a, regr_intercept(price, qty) AS b "
    "FROM o, f WHERE NOT te AND u < fraction GROUP BY fraction) SELECT fraction, n AS n_train, round(avg(CASE WHEN NOT te AND u < fraction THEN abs(a * qty + b - price) END), 2) AS train, round(avg(CASE WHEN te THEN abs(a * qty + b - price) END), 2) AS test FROM m, o GROUP BY fraction, n",
)
def _(t):
    out = ML.learning_curve(_orders(t), ML.linear(), "label", ["id"], [0.1, 0.5, 1.0])
    return out.withColumns({c: F.round(c, 2) for c in ("train", "test")})


@query("ml18_validation_curve")
def _(t):
    return ML.validation_curve(_lines(t), ML.trees("tree", "regress"), "maxDepth", [1, 3, 5], "label", _KEYS)


@query("ml19_permutation_importance")
def _(t):
    rows = _lines(t).select("row_id", "label", *_NUM)  # stored by the operator
    model = ML.linear().fit(assemble(rows, _NUM))

    def score(df):
        return M.regression_errors(model.transform(assemble(df, _NUM)), "label", "prediction").first()["mae"]

    return ML.permutation_importance(rows, score, _NUM, _KEYS, repeats=10)


@query("ml19_tree_importance")
def _(t):
    model = ML.trees("forest", "regress", numTrees=5, maxDepth=4).fit(_lines(t))
    return ML.tree_importance(model, _NUM, t.spark)


@query(
    "ml19_merge_importances",
    "WITH a AS (SELECT p_brand AS feature, avg(p_size)::DOUBLE AS importance FROM part GROUP BY p_brand), b AS (SELECT p_brand AS feature, avg(p_retailprice) / 100 AS importance FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_brand) "
    "SELECT feature, round((coalesce(a.importance, 0) + coalesce(b.importance, 0)) / 2, 7) AS importance FROM a FULL JOIN b USING (feature)",
)
def _(t):
    a = t.part.groupBy(F.col("p_brand").alias("feature")).agg(F.avg("p_size").alias("importance"))
    b = t.part.where("p_brand <> 'Brand#1'").groupBy(F.col("p_brand").alias("feature")).agg((F.avg("p_retailprice") / 100).alias("importance"))
    return ML.merge_importances(a, b).withColumn("importance", F.round("importance", 7))


@query("ml20_cross_val_predict", f"WITH {_folds_sql(3)} SELECT id, fold, round(prediction, 3) AS prediction FROM p")
def _(t):
    out = ML.cross_val_predict(_orders(t), ML.linear(), ["id"], folds=3)
    return out.select("id", "fold", F.round("prediction", 3).alias("prediction"))


@query(
    "ml21_per_group_lines",
    "SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY l_suppkey",
)
def _(t):
    out = ML.per_group_lines(t.lineitem, "l_suppkey", "l_quantity", "l_extendedprice")
    return out.select("l_suppkey", "n", F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    "ml21_per_group_models",
    "SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(avg(abs(l_extendedprice - p)), 2) AS mae FROM (SELECT *, regr_slope(l_extendedprice, l_quantity) OVER w * l_quantity + regr_intercept(l_extendedprice, l_quantity) OVER w AS p "
    "FROM lineitem WINDOW w AS (PARTITION BY l_returnflag)) GROUP BY l_returnflag",
)
def _(t):
    models = ML.per_group_models(t.lineitem, "l_returnflag", ["l_quantity"], "l_extendedprice", ridge=0.0)
    scored = ML.apply_group_models(t.lineitem, models, "l_returnflag", ["l_quantity"])
    errors = M.regression_errors(scored, "l_extendedprice", "prediction", ["l_returnflag"])
    slopes = models.select("l_returnflag", F.round(F.col("coefficients")[1], 3).alias("slope"))
    return errors.join(slopes, "l_returnflag").select("l_returnflag", "n", "slope", F.round("mae", 2).alias("mae"))


@query("ml22_score_unlabelled")
def _(t):
    labelled = t.documents.join(t.labels, "doc_id")
    features, unseen = tfidf_hashed(labelled, t.documents.join(t.labels, "doc_id", "left_anti"), "text", 256)
    model = ML.logistic("quality", maxIter=5, regParam=0.01).fit(features)
    return ML.score_unlabelled(model, unseen, "doc_id", F.when(F.col("prediction") == 1, F.array(F.lit("quality"))).otherwise(F.array().cast("array<string>")))


@query(
    "ml23_log_target",
    f"WITH {_split_sql()}, m AS (SELECT regr_slope(ln(1 + price), qty) AS a, regr_intercept(ln(1 + price), qty) AS b FROM tr) SELECT count(*) AS n, round(avg(abs(exp(a * qty + b) - 1 - price)), 2) AS mae FROM te, m",
)
def _(t):
    train, test = _parts(_orders(t), ["id"])
    return _errors(ML.log_target(ML.linear(), "label")(train)(test)).select("n", F.round("mae", 2).alias("mae"))


@query(
    "ml24_select_k_best",
    "WITH o AS (SELECT sum(l_extendedprice) AS y, sum(l_quantity) AS qty, count(*)::DOUBLE AS lines, avg(l_discount) AS discount, avg(l_tax) AS tax FROM lineitem GROUP BY l_orderkey), c AS (SELECT unnest([0, 1, 2, 3]) AS feature, unnest([abs(corr(y, qty)), abs(corr(y, lines)), abs(corr(y, discount)), "
    "abs(corr(y, tax))]) AS r FROM o) SELECT feature FROM c ORDER BY r DESC LIMIT 2",
)
def _(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("label"), F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).cast("double").alias("lines"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax")
    )
    model = ML.select_k_best(2, "label").fit(assemble(rows, ["qty", "lines", "discount", "tax"]))
    return t.spark.createDataFrame([(int(i),) for i in model.selectedFeatures], "feature INT")


@query("ml24_feature_union")
def _(t):
    rows = ML.poly2(out="wide").transform(_lines(t))
    train, test = _parts(rows, _KEYS)
    union = ML.feature_union(2, 3, "label", "wide").fit(train)
    return _errors(ML.linear(features="union").fit(union.transform(train)).transform(union.transform(test)))


@query(
    "ml26_majority_vote",
    "WITH p AS (SELECT l_orderkey AS id, l_returnflag AS y FROM lineitem), v AS (SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, y) AS rn FROM p GROUP BY id, y) SELECT id, y AS predicted FROM v WHERE rn = 1",
)
def _(t):
    return ML.majority_vote(t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("y")), "id", "y")




@query(
    "ml21_logistic_per_group",
    "WITH c AS (SELECT o_orderpriority, o_totalprice > 150000 AS big, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS p, count(*) AS n FROM orders GROUP BY ALL), l AS (SELECT *, ln(p / (1 - p)) AS logit FROM c) "
    "SELECT a.o_orderpriority AS o_orderpriority, a.n + b.n AS n, round(a.logit, 6) AS intercept, round(b.logit - a.logit, 6) AS slope FROM l a JOIN l b ON a.o_orderpriority = b.o_orderpriority AND NOT a.big AND b.big",
)
def _(t):
    rows = t.orders.select(
        "o_orderpriority", (F.col("o_totalprice") > 150000).cast("double").alias("big"), (F.col("o_orderstatus") == "F").cast("double").alias("done")
    )
    out = GM.logistic_per_group(rows, "o_orderpriority", ["big"], "done", ridge=0.0)
    return out.select("o_orderpriority", "n", *[F.round(F.get("coefficients", F.lit(i)), 6).alias(c) for i, c in enumerate(("intercept", "slope"))])


@query("ml21_huber_per_group")
def _(t):
    rows = t.lineitem.select("l_returnflag", "l_quantity", "l_discount", "l_extendedprice")
    out = GM.huber_per_group(rows, "l_returnflag", ["l_quantity", "l_discount"], "l_extendedprice")
    return out.select("l_returnflag", "n", F.transform("coefficients", lambda b: F.round(b, 3)).alias("coefficients"))
