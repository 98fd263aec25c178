"""Train, tune and score on Spark ML; everything fitted is fitted on the training rows only."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (
    PCA,
    Imputer,
    IndexToString,
    OneHotEncoder,
    PolynomialExpansion,
    StandardScaler,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
    Word2Vec,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.columns import hash_fraction, key_hash
from lodestar.operators.metrics import regression_errors
from lodestar.operators.rows import fold_column
from lodestar.operators.scaling import Rounds, materialise, piece_offsets, row_at, salted_lookup, union_all, with_row_number

MAX_CLASSES = 1000

# --- estimators ----------------------------------------------------------------------------------


def logistic(label: str = "label", features: str = "features", multinomial: bool = False, **params) -> Estimator:
    family = "multinomial" if multinomial else "auto"
    return LogisticRegression(labelCol=label, featuresCol=features, family=family, **params)


def one_vs_rest(label: str = "label", features: str = "features", parallelism: int = 2) -> Estimator:
    return OneVsRest(classifier=LogisticRegression(), labelCol=label, featuresCol=features, parallelism=parallelism)


def naive_bayes(label: str = "label", features: str = "features", kind: str = "multinomial") -> Estimator:
    return NaiveBayes(labelCol=label, featuresCol=features, modelType=kind)


def trees(kind: str, task: str, label: str = "label", features: str = "features", seed: int = 42, **params) -> Estimator:
    """``forest``, ``boosted``, ``tree`` or ``bagging`` (a forest that may split on all features)."""
    if kind == "bagging":
        params.setdefault("featureSubsetStrategy", "all")
    makers = {
        ("forest", "classify"): RandomForestClassifier, ("forest", "regress"): RandomForestRegressor,
        ("bagging", "classify"): RandomForestClassifier, ("bagging", "regress"): RandomForestRegressor,
        ("boosted", "classify"): GBTClassifier, ("boosted", "regress"): GBTRegressor,
        ("tree", "classify"): DecisionTreeClassifier, ("tree", "regress"): DecisionTreeRegressor,
    }
    return makers[kind, task](labelCol=label, featuresCol=features, seed=seed, **params)


def perceptron(layers: Sequence[int], label: str = "label", features: str = "features", seed: int = 42, **params) -> Estimator:
    """The last layer must be at least the number of classes."""
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, layers=list(layers), seed=seed, **params)


def linear(label: str = "label", features: str = "features", kind: str = "plain", alpha: float = 0.0, **params) -> Estimator:
    """``plain``, ``ridge``, ``lasso`` or ``huber`` linear regression."""
    if kind == "huber":
        return LinearRegression(labelCol=label, featuresCol=features, loss="huber", regParam=alpha, **params)
    mix = {"plain": 0.0, "ridge": 0.0, "lasso": 1.0}[kind]
    reg = 0.0 if kind == "plain" else alpha
    return LinearRegression(labelCol=label, featuresCol=features, regParam=reg, elasticNetParam=mix, **params)


def linear_svm(label: str = "label", features: str = "features", **params) -> Estimator:
    return LinearSVC(labelCol=label, featuresCol=features, **params)


# --- features --------------------------------------------------------------------------------------


def mixed_pipeline(numeric: Sequence[str], categorical: Sequence[str], out: str = "features", scale: bool = True) -> Pipeline:
    """Impute and scale numbers, index and one-hot text, assemble; unseen categories get their own index."""
    imputed = [f"{c}_imp" for c in numeric]
    stages = []
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=imputed, strategy="mean"))
    if categorical:
        indexed, hot = [f"{c}_idx" for c in categorical], [f"{c}_hot" for c in categorical]
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
    else:
        hot = []
    stages.append(VectorAssembler(inputCols=[*imputed, *hot], outputCol="_raw" if scale else out))
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol=out, withMean=False))
    return Pipeline(stages=stages)


def poly2(features: str = "features", out: str = "poly") -> PolynomialExpansion:
    return PolynomialExpansion(degree=2, inputCol=features, outputCol=out)


def select_k_best(k: int, label: str, features: str = "features", out: str = "best", classify: bool = False) -> Estimator:
    selector = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=out, selectionMode="numTopFeatures")
    selector.setFeatureType("continuous").setLabelType("categorical" if classify else "continuous")
    return selector.setSelectionThreshold(k)


def feature_union(k_pca: int, k_best: int, label: str, features: str = "features", out: str = "union") -> Pipeline:
    """PCA axes beside the k best single features."""
    return Pipeline(
        stages=[
            PCA(k=k_pca, inputCol=features, outputCol="_pca"),
            select_k_best(k_best, label, features, "_best"),
            VectorAssembler(inputCols=["_pca", "_best"], outputCol=out),
        ]
    )


def embed(sentences: DataFrame, column: str, size: int = 32, window: int = 5, min_count: int = 5, seed: int = 42) -> DataFrame:
    """Skip-gram vectors of the tokens (words, or nodes of random walks): ``word, vector``."""
    return Word2Vec(
        vectorSize=size, windowSize=window, minCount=min_count, seed=seed, inputCol=column, outputCol="_v"
    ).fit(sentences).getVectors()


# --- scoring ---------------------------------------------------------------------------------------


def fit_per_label(train: DataFrame, test: DataFrame, tags: Sequence[str], make: Callable[[str], Estimator]) -> DataFrame:
    """One binary model per tag; predictions are added as ``<tag>_pred`` columns by chained transforms."""
    train = materialise(train)
    out = test
    for tag in tags:
        model = make(tag).fit(train)
        scored = model.transform(out)
        out = scored.withColumn(f"{tag}_pred", F.col("prediction").cast("int")).drop(
            "prediction", "rawPrediction", "probability"
        )
    return out


def fit_tag_code(train: DataFrame, test: DataFrame, code: str, estimator: Estimator) -> DataFrame:
    """Multi-class model on tag codes: the code is indexed, predicted and turned back to text.

    The indexer keeps one more class, for rows without a code, and that class has no text. Where the model prefers it, the
    predicted code is the likeliest of the others."""
    indexer = StringIndexer(inputCol=code, outputCol="label", handleInvalid="keep").fit(train)
    scored = estimator.fit(indexer.transform(train)).transform(test)
    if not indexer.labels:
        return scored.withColumn("predicted_code", F.lit(None).cast("string"))
    if "rawPrediction" in scored.columns:
        known = F.slice(vector_to_array("rawPrediction"), 1, len(indexer.labels))
        likeliest = (F.array_position(known, F.array_max(known)) - 1).cast("double")
        scored = scored.withColumn("prediction", F.when(F.col("prediction") < len(indexer.labels), F.col("prediction")).otherwise(likeliest))
    back = IndexToString(inputCol="prediction", outputCol="predicted_code", labels=indexer.labels)
    return back.transform(scored)


def score_unlabelled(model, df: DataFrame, id_col: str, predicted) -> DataFrame:
    """``id, predicted`` of an unlabelled table."""
    return model.transform(df).select(id_col, predicted.alias("predicted"))


def log_target(estimator: Estimator, label: str):
    """Fit on log1p of the label; the returned function fits and gives predictions on the plain scale."""

    def fit(train: DataFrame) -> Callable[[DataFrame], DataFrame]:
        name = estimator.getLabelCol()
        model = estimator.fit(train.withColumn(name, F.log1p(label)))
        return lambda df: model.transform(df).withColumn("prediction", F.expm1("prediction"))

    return fit


def majority_vote(preds: DataFrame, id_col: str, predicted: str) -> DataFrame:
    """Most frequent class per id over long predictions, smallest class on ties."""
    votes = preds.groupBy(id_col, predicted).agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(id_col).agg(F.min_by(predicted, F.struct(-F.col("n"), F.col(predicted))).alias("predicted"))


# --- tuning ----------------------------------------------------------------------------------------


def grid(estimator: Estimator, options: Mapping[str, Sequence]) -> list:
    builder = ParamGridBuilder()
    for name, values in options.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()


def random_grid(estimator: Estimator, options: Mapping[str, Sequence], n: int, seed: int = 42) -> list:
    """n different combinations drawn from the full grid."""
    names = list(options)
    combos = list(itertools.product(*[options[name] for name in names]))
    drawn = random.Random(seed).sample(combos, min(n, len(combos)))
    return [{estimator.getParam(k): v for k, v in zip(names, combo)} for combo in drawn]


def grid_search(
    df: DataFrame, estimator: Estimator, maps: list, evaluator: Evaluator, keys: Sequence[str], folds: int = 3,
    parallelism: int = 4, seed: int = 42,
):
    """Cross-validated search with folds from a key hash: (best model, table of parameters and scores)."""
    stored = materialise(df.withColumn("_fold", fold_column(keys, folds, seed)))
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, parallelism=parallelism,
        foldCol="_fold",
    ).fit(stored)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda item: item[0].name)), float(avg), float(std))
        for m, avg, std in zip(maps, cv.avgMetrics, cv.stdMetrics)
    ]
    return cv.bestModel, df.sparkSession.createDataFrame(rows, "params STRING, score DOUBLE, score_std DOUBLE")


def cross_val_predict(df: DataFrame, estimator: Estimator, keys: Sequence[str], folds: int = 3, seed: int = 42) -> DataFrame:
    """Out-of-fold prediction of every row."""
    stored = materialise(df.withColumn("_fold", fold_column(keys, folds, seed)))
    parts = []
    for i in range(folds):
        model = estimator.fit(stored.where(F.col("_fold") != i))
        parts.append(model.transform(stored.where(F.col("_fold") == i)))
    return union_all(parts).withColumnRenamed("_fold", "fold")


def cross_val_scores(
    df: DataFrame, estimator: Estimator, label: str, keys: Sequence[str], folds: int = 5, metric: str = "mae", seed: int = 42
) -> DataFrame:
    """Minimum, mean, maximum and deviation of the fold scores."""
    scored = cross_val_predict(df, estimator, keys, folds, seed)
    per = regression_errors(scored, label, "prediction", ["fold"])
    return per.agg(
        F.min(metric).alias("min"), F.avg(metric).alias("mean"), F.max(metric).alias("max"), F.stddev_pop(metric).alias("std")
    )


def learning_curve(
    df: DataFrame, estimator: Estimator, label: str, keys: Sequence[str], fractions: Sequence[float], metric: str = "mae",
    test_share: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Train and test score by share of the training rows; larger shares contain the smaller ones."""
    stored = materialise(
        df.withColumn("_test", hash_fraction(keys, seed) < test_share).withColumn("_u", hash_fraction(keys, seed + 1))
    )
    train, test = stored.where(~F.col("_test")), stored.where("_test")
    rows = []
    for fraction in fractions:
        part = train.where(F.col("_u") < fraction)
        model = estimator.fit(part)
        seen = regression_errors(model.transform(part), label, "prediction").first()
        unseen = regression_errors(model.transform(test), label, "prediction").first()
        rows.append((float(fraction), int(seen["n"]), float(seen[metric]), float(unseen[metric])))
    return df.sparkSession.createDataFrame(rows, "fraction DOUBLE, n_train BIGINT, train DOUBLE, test DOUBLE")


def validation_curve(
    df: DataFrame, estimator: Estimator, param: str, values: Sequence, label: str, keys: Sequence[str], metric: str = "mae",
    test_share: float = 0.2, seed: int = 42,
) -> DataFrame:
    """Train and test score by value of one parameter."""
    stored = materialise(df.withColumn("_test", hash_fraction(keys, seed) < test_share))
    train, test = stored.where(~F.col("_test")), stored.where("_test")
    rows = []
    for value in values:
        model = estimator.copy({estimator.getParam(param): value}).fit(train)
        scores = [regression_errors(model.transform(part), label, "prediction").first()[metric] for part in (train, test)]
        rows.append((str(value), float(scores[0]), float(scores[1])))
    return df.sparkSession.createDataFrame(rows, "value STRING, train DOUBLE, test DOUBLE")


_HASH_PIECE_BITS = 20  # of 32: 4,096 pieces

# --- importance ------------------------------------------------------------------------------------


def _hash_order(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """Rows with ``_n``, 1..n in the order of a hash of their key. The hash is even, so equal pieces of its range are ranges of the
    order: rows are counted per piece and meet once by piece, without a sample of the table or a stored copy."""
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn("_range", F.shiftright("_h", _HASH_PIECE_BITS).cast("int"))
    before = piece_offsets(hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("n")), ["n"])
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_h", *keys))
    placed = hashed.withColumn("_n", place).join(F.broadcast(before), "_range")
    return placed.withColumn("_n", F.col("_n") + F.col("_before_n")).drop("_h", "_range", "_before_n")


def _beside_others(numbered: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int) -> DataFrame:
    """The rows of ``_hash_order`` with ``_other``, the ``columns`` of the row at the same place of another hash order."""
    values = _hash_order(numbered.select(*dict.fromkeys([*keys, *columns])), keys, seed)
    return numbered.join(values.select("_n", F.struct(*columns).alias("_other")), "_n").drop("_n")


def _swapped(beside: DataFrame, column: str) -> DataFrame:
    return beside.withColumn(column, F.col("_other").getField(column)).drop("_other")


def shuffle_column(df: DataFrame, column: str, keys: Sequence[str], seed: int) -> DataFrame:
    """The rows with one column permuted: rows and values are numbered in two hash orders and joined."""
    return _swapped(_beside_others(_hash_order(df, keys, seed), [column], keys, seed + 7919), column)


def permutation_importance(
    df: DataFrame, score: Callable[[DataFrame], float], columns: Sequence[str], keys: Sequence[str], repeats: int = 3, seed: int = 42
) -> DataFrame:
    """Mean and deviation of the score lost when a column is shuffled (larger loss, more important).

    The rows are numbered once. A repeat deals every row the columns of another one; each column is then swapped alone, so a
    repeat joins the table once, however many columns it has."""
    columns = list(columns)
    stored, rounds = materialise(df), Rounds(df.sparkSession)
    base = score(stored)
    numbered = materialise(_hash_order(stored, keys, seed))
    drops = {column: [] for column in columns}
    for r in range(repeats):
        beside = rounds.store(_beside_others(numbered, columns, keys, seed + 7919 + r))
        for column in columns:
            drops[column].append(score(_swapped(beside, column)) - base)
    rows = [(column, float(np.mean(lost)), float(np.std(lost))) for column, lost in drops.items()]
    return df.sparkSession.createDataFrame(rows, "feature STRING, importance DOUBLE, deviation DOUBLE")


def tree_importance(model, columns: Sequence[str], spark) -> DataFrame:
    rows = [(c, float(model.featureImportances[i])) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE")


def merge_importances(a: DataFrame, b: DataFrame) -> DataFrame:
    """Average of two importance tables, largest first; a feature missing on one side counts 0 there."""
    both = a.select("feature", F.col("importance").alias("ia")).join(
        b.select("feature", F.col("importance").alias("ib")), "feature", "full"
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return both.select("feature", ((zero("ia") + zero("ib")) / 2).alias("importance")).orderBy(
        F.desc("importance"), F.asc("feature")
    )


# --- special models --------------------------------------------------------------------------------


def inliers_split(
    df: DataFrame, estimator: Estimator, label: str, keys: Sequence[str], exclude: float = 0.2, rate: float = 0.5,
    seed: int = 42,
) -> DataFrame:
    """Rows that models fitted on earlier inliers predict well, until ``1 - exclude`` of all rows are in.

    Each round fits on the inliers plus a random half of the others and keeps the best ``rate`` of the other half. A row
    carries whether it is in; the last of the best rows is found by its rank, so a round neither joins nor sorts the table.
    Rows that share a key come in together; rows with a null key never come in.
    """
    rounds = Rounds(df.sparkSession)
    named = sum((F.col(k).isNotNull().cast("int") for k in keys), F.lit(0)) == len(keys)
    state = rounds.store(df.withColumn("_in", F.lit(False)))
    goal = int(state.count() * (1 - exclude))
    shared = materialise(state.where(named).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys))
    some_shared = not shared.isEmpty()
    have = 0
    for round_no in itertools.count():
        if have >= goal:
            break
        share = hash_fraction(keys, seed + round_no)
        asked = F.coalesce(~F.col("_in") & (share >= 0.5), F.lit(False))
        model = estimator.fit(state.where(F.col("_in") | (share < 0.5)).select(*df.columns))
        error = F.abs(F.col("prediction") - F.col(label)).alias("_e")
        errors = materialise(model.transform(state.where(asked).select(*df.columns)).select(error, *keys))
        n = errors.count()
        keep = min(int(n * rate), goal - have)
        if n and keep == 0:
            keep = 1
        if not keep:
            continue
        place = F.struct("_e", *keys)
        last = materialise(row_at(errors, ["_e", *keys], keep).select(place.alias("_last")))
        scored = model.transform(state).select(*df.columns, "_in", (asked & named).alias("_asked"), error)
        # structs compare as rows are sorted: field by field, nulls first
        chosen = scored.crossJoin(F.broadcast(last)).withColumn("_in", F.col("_in") | (F.col("_asked") & (place <= F.col("_last"))))
        chosen = chosen.select(*df.columns, "_in")
        if some_shared:
            best = errors.crossJoin(F.broadcast(last)).where(place <= F.col("_last")).select(*keys).distinct()
            twins = best.join(shared, list(keys), "left_semi").withColumn("_twin", F.lit(True))
            chosen = chosen.join(twins, list(keys), "left").select(*df.columns, (F.col("_in") | F.coalesce("_twin", F.lit(False))).alias("_in"))
        state = rounds.store(chosen)
        have += keep
    return state.where("_in").select(*df.columns)


def _moments(features: Sequence[str], label: str) -> list:
    names = ["_one", *features]
    value = {"_one": F.lit(1.0), **{f: F.col(f).cast("double") for f in features}}
    xx = [F.sum(value[a] * value[b]) for i, a in enumerate(names) for b in names[i:]]
    xy = [F.sum(value[a] * F.col(label)) for a in names]
    return [F.array(*xx).alias("_xx"), F.array(*xy).alias("_xy"), F.count(F.lit(1)).alias("n")]


def per_group_models(df: DataFrame, key: str, features: Sequence[str], label: str, ridge: float = 1e-9) -> DataFrame:
    """Least-squares model per group: ``key, n, coefficients`` (intercept first).

    A group is reduced to its cross products by a partial aggregate, so a group with a third of all
    rows is still one short row; only that row is solved in Python.
    """
    p = len(features) + 1
    upper = np.triu_indices(p)

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(xx, xy):
            m = np.zeros((p, p))
            m[upper] = a
            m = m + np.triu(m, 1).T
            m[np.diag_indices(p)] *= 1 + ridge
            out.append(np.linalg.lstsq(m, np.asarray(b, dtype=float), rcond=None)[0])
        return pd.Series(out)

    sums = df.na.drop(subset=[label, *features]).groupBy(key).agg(*_moments(features, label))
    return sums.select(key, "n", solve("_xx", "_xy").alias("coefficients"))


def apply_group_models(df: DataFrame, models: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    terms = [F.col("coefficients")[0], *[F.col("coefficients")[i + 1] * F.col(f) for i, f in enumerate(features)]]
    placed = salted_lookup(df, models.select(key, "coefficients"), [key])
    return placed.withColumn("prediction", sum(terms[1:], terms[0])).drop("coefficients")


def per_group_lines(df: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Slope and intercept of y on x per group, as plain aggregates."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def discriminant(
    train: DataFrame, test: DataFrame, label: str, features: Sequence[str], shared_cov: bool = True, ridge: float = 1e-9
) -> DataFrame:
    """Linear (shared covariance) or quadratic discriminant; adds ``predicted`` to the test rows.

    Class means and cross products come from one aggregate; one p x p matrix per class is inverted on
    the driver, and rows are scored by an expression.
    """
    p = len(features)
    value = [F.col(f).cast("double") for f in features]
    sums = (
        train.groupBy(label)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.avg(v) for v in value]).alias("mean"),
            F.array(*[F.covar_pop(value[i], value[j]) for i in range(p) for j in range(i, p)]).alias("cov"),
        )
        .limit(MAX_CLASSES + 1)
        .collect()
    )
    if len(sums) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    total = sum(r["n"] for r in sums)
    upper = np.triu_indices(p)
    means, covs, priors = {}, {}, {}
    for r in sums:
        m = np.zeros((p, p))
        m[upper] = r["cov"]
        covs[r[label]] = m + np.triu(m, 1).T
        means[r[label]] = np.array(r["mean"])
        priors[r[label]] = r["n"] / total
    if shared_cov:
        pooled = sum(priors[c] * covs[c] for c in covs)
        covs = dict.fromkeys(covs, pooled)
    scores = []
    for c in sorted(covs):
        cov = covs[c] + ridge * np.trace(covs[c]) / p * np.eye(p)
        inverse = np.linalg.inv(cov)
        d = [value[i] - float(means[c][i]) for i in range(p)]
        distance = sum((d[i] * d[j] * float(inverse[i, j]) for i in range(p) for j in range(p)), F.lit(0.0))
        constant = float(np.log(priors[c]) - 0.5 * np.linalg.slogdet(cov)[1])
        scores.append(F.struct((F.lit(constant) - 0.5 * distance).alias("s"), F.lit(c).alias("c")))
    return test.withColumn("predicted", F.array_max(F.array(*scores)).getField("c"))
