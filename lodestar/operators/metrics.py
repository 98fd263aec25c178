"""Scores of predictions, computed as plain queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.scaling import materialise, running_totals


def error_aggregates(y: str, yhat: str) -> list[Column]:
    """MAE, MAPE in %, MSE, their sample deviations, RMSE, root of the deviation of squares, RMSLE."""
    t, p = F.col(y).cast("double"), F.col(yhat).cast("double")
    absolute, squared = F.abs(p - t), F.pow(p - t, 2)
    share = 100 * F.abs((p - t) / F.nullif(t, F.lit(0.0)))
    return [
        F.count(F.lit(1)).alias("n"),
        F.avg(absolute).alias("mae"),
        F.stddev_samp(absolute).alias("mae_std"),
        F.avg(share).alias("mape"),
        F.stddev_samp(share).alias("mape_std"),
        F.avg(squared).alias("mse"),
        F.stddev_samp(squared).alias("mse_std"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        F.sqrt(F.stddev_samp(squared)).alias("rmse_std"),
        F.sqrt(F.avg(F.pow(F.log1p(p) - F.log1p(t), 2))).alias("rmsle"),
    ]


def errors_of_several(df: DataFrame, y: str, predicted: Sequence[str], measures: Sequence[str], names: Sequence[Sequence[Column]]) -> DataFrame:
    """``measures`` of several predictions of the same rows, one row per prediction beside its ``names``, from one pass."""
    once = df.agg(*[F.struct(*[a for a in error_aggregates(y, p)]).alias(f"_e{i}") for i, p in enumerate(predicted)])
    rows = F.explode(F.array(*[F.struct(*own, *[F.col(f"_e{i}.{m}").alias(m) for m in measures]) for i, own in enumerate(names)]))
    return once.select(rows.alias("_r")).select("_r.*")


def regression_errors(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*error_aggregates(y, yhat)) if by else df.agg(*error_aggregates(y, yhat))


def errors_by_band(df: DataFrame, y: str, yhat: str, low: float, high: float) -> DataFrame:
    """Metrics of rows with a small (<= low), middle or large (> high) absolute error."""
    size = F.abs(F.col(yhat) - F.col(y))
    band = F.when(size <= low, "small").when(size > high, "large").otherwise("middle")
    return regression_errors(df.withColumn("band", band), y, yhat, ["band"])


def multilabel_f1(df: DataFrame, labels: str, predicted: str) -> DataFrame:
    """Mean over rows of 2|P and L| / (|P| + |L|); rows with two empty sets are left out."""
    hits = F.size(F.array_intersect(predicted, labels))
    total = F.size(predicted) + F.size(labels)
    return df.agg(F.avg(2 * hits / F.nullif(total, F.lit(0))).alias("f1"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Count and share within the true class of every (label, prediction) pair."""
    cells = df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = cells.groupBy("label").agg(F.sum("n").alias("_total"))
    return cells.join(totals, "label").select("label", "predicted", "n", (F.col("n") / F.col("_total")).alias("share"))


def classification_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, and the accuracy over all rows."""
    cells = materialise(
        df.groupBy(F.col(label).alias("l"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    )
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("l").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")),
            )
        ).alias("s"),
        F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
    )
    per_class = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"), F.sum("s.called").alias("called"), (F.sum("hit") / 2).alias("hits")
    )
    overall = cells.agg(F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).first()[0]
    precision = F.col("hits") / F.nullif(F.col("called"), F.lit(0))
    recall = F.col("hits") / F.nullif(F.col("support"), F.lit(0))
    return per_class.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        (2 * F.col("hits") / (F.col("called") + F.col("support"))).alias("f1"),
        "support", F.lit(overall).cast("double").alias("accuracy"),
    )


def score_totals(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives with a score at least as high, one row per distinct score."""
    groups = df.groupBy((-F.col(score)).alias("_down")).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")
    )
    return running_totals(groups, ["_down"], ["pos", "neg"]).withColumn("score", -F.col("_down")).drop("_down")


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """False and true positive rate at every score threshold."""
    steps = score_totals(df, label, score)
    total = steps.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return steps.select(
        "score",
        (F.col("cum_neg") / F.nullif(F.lit(total["n"]), F.lit(0))).alias("fpr"),
        (F.col("cum_pos") / F.nullif(F.lit(total["p"]), F.lit(0))).alias("tpr"),
    )


def area_under_curves(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve (trapezoids, ties included) and under precision-recall.

    The curve before each step is the running total minus the step itself, so no lag is needed.
    """
    s = score_totals(df, label, score)
    total = s.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    pos, neg = F.lit(total["p"]).cast("double"), F.lit(total["n"]).cast("double")
    before = F.col("cum_pos") - F.col("pos")
    seen_before = before + F.col("cum_neg") - F.col("neg")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    precision_before = F.when(seen_before > 0, before / seen_before).otherwise(precision)
    return s.agg(
        (F.sum(F.col("neg") * (F.col("cum_pos") + before) / 2.0) / F.nullif(pos * neg, F.lit(0.0))).alias("auc"),
        (F.sum(F.col("pos") * (precision + precision_before) / 2.0) / F.nullif(pos, F.lit(0.0))).alias("pr_auc"),
    )


def class_entropy(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Entropy in bits of the class shares."""
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    # H = log2 N - (1/N) sum n log2 n needs one aggregate over the counts
    return counts.groupBy(*by).agg(
        F.sum("n").alias("n"),
        (F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2(F.col("n"))) / F.sum("n")).alias("entropy"),
    )


def class_probabilities(df: DataFrame, label: str) -> DataFrame:
    counts = materialise(df.groupBy(label).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.withColumn("probability", F.col("n") / F.lit(total))


def information_gain(df: DataFrame, feature: str, label: str, classes: Sequence) -> DataFrame:
    """Gain of the split ``feature <= threshold`` for every distinct feature value at once."""
    rows = df.where(F.col(feature).isNotNull())
    steps = rows.groupBy(F.col(feature).alias("threshold")).agg(
        *[F.count_if(F.col(label) == c).alias(f"c{i}") for i, c in enumerate(classes)]
    )
    names = [f"c{i}" for i in range(len(classes))]
    run = running_totals(steps, ["threshold"], names)
    totals = steps.agg(*[F.sum(n).alias(n) for n in names]).first()

    def entropy(parts: list[Column]) -> Column:
        size = sum(parts[1:], parts[0])
        terms = [F.when(p > 0, -(p / size) * F.log2(p / size)).otherwise(F.lit(0.0)) for p in parts]
        return sum(terms[1:], terms[0])

    left = [F.col(f"cum_{n}").cast("double") for n in names]
    right = [F.lit(float(totals[n] or 0)) - F.col(f"cum_{n}") for n in names]
    whole = [F.lit(float(totals[n] or 0)) for n in names]
    n_left, n_right, n_all = sum(left[1:], left[0]), sum(right[1:], right[0]), sum(whole[1:], whole[0])
    gain = entropy(whole) - n_left / n_all * entropy(left) - n_right / n_all * F.when(
        n_right > 0, entropy(right)
    ).otherwise(0.0)
    return run.where(n_right > 0).select("threshold", gain.alias("gain"))


class MapeEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Mean absolute percentage error for cross-validation; smaller is better."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        return regression_errors(dataset, self.getLabelCol(), self.getPredictionCol()).first()["mape"]

    def isLargerBetter(self) -> bool:
        return False
