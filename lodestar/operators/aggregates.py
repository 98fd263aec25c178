"""Aggregations: word counts, summaries, distributions, correlations."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from itertools import combinations_with_replacement
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import column_kinds, key_hash
from lodestar.functions.text import ngrams, strip_punct, tokenize, unnest
from lodestar.operators.scaling import (
    column_percentiles,
    exact_percentiles,
    materialise,
    running_totals,
    salted_lookup,
    with_row_number,
)


def line_count(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("lines"))


def words(df: DataFrame, column: str, mode: str = "words", punct: bool = True) -> DataFrame:
    """One row per token; ``punct=False`` strips punctuation first."""
    text = F.col(column) if punct else strip_punct(column)
    return unnest(df, tokenize(text, mode), "word")


def word_count(
    df: DataFrame,
    column: str,
    mode: str = "words",
    punct: bool = True,
    min_len: int = 0,
    top: int | None = None,
) -> DataFrame:
    """Word counts; the count is partial before the shuffle, so frequent words travel once per task."""
    tokens = words(df, column, mode, punct)
    if min_len:
        tokens = tokens.where(F.length("word") >= min_len)
    counts = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(top) if top else counts


def word_count_initials(
    df: DataFrame, column: str, stop: Sequence[str], initials: Sequence[str] = ("a", "b", "c", "d")
) -> DataFrame:
    tokens = words(df, column, punct=False).where(F.substring("word", 1, 1).isin(list(initials)))
    return tokens.where(~F.col("word").isin(list(stop))).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def bigram_count(
    df: DataFrame, column: str, stop: Sequence[str], initials: Sequence[str] = ("a", "b", "c", "d")
) -> DataFrame:
    """Pairs of neighbours on one line whose first word has a wanted initial and is no stop word."""
    lines = unnest(df, F.split(F.col(column), "\n"), "line")
    pairs = unnest(lines, ngrams(tokenize(strip_punct("line")), 2), "bigram")
    first = F.substring_index("bigram", " ", 1)
    kept = pairs.where(F.substring(first, 1, 1).isin(list(initials)) & ~first.isin(list(stop)))
    return kept.groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


def mean_word_length(df: DataFrame, column: str) -> DataFrame:
    """Mean length of the words that start with an upper-case letter A-Z, per letter."""
    tokens = words(df, column).withColumn("letter", F.substring("word", 1, 1))
    return (
        tokens.where(F.col("letter").rlike("^[A-Z]$"))
        .groupBy("letter")
        .agg(F.avg(F.length("word")).alias("mean_length"))
    )


def max_by_key(df: DataFrame, key: str | Column, value: str, name: str = "max_value") -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(name))


def link_count(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("links"))


def weighted_degree(edges: DataFrame, min_w: float = 0.6, min_sum: float = 1.0) -> DataFrame:
    """Sum of the weights >= ``min_w`` at both ends of an edge, for nodes whose sum exceeds ``min_sum``."""
    ends = edges.where(F.col("w") >= min_w).select(F.explode(F.array("src", "dst")).alias("node"), "w")
    return ends.groupBy("node").agg(F.sum("w").alias("weight")).where(F.col("weight") > min_sum)


def inverted_index(docs: DataFrame, doc: str, column: str, sep: str = ",", chunk: int = 10000) -> DataFrame:
    """Word to sorted distinct documents, whose ids are of any type (numbers, file names): ``word, part, docs``.

    ``part`` is a share of the documents by a hash of the id, of about ``chunk`` documents, so a word found everywhere is as
    many rows of bounded size as there are parts, at every table size.
    """
    parts = max(1, math.ceil(docs.select(doc).distinct().count() / chunk))
    part = F.pmod(key_hash([doc]), F.lit(parts)).cast("int").alias("part")
    postings = unnest(docs, F.array_distinct(tokenize(column)), "word", [F.col(doc).alias("doc"), part])
    return postings.groupBy("word", "part").agg(
        F.array_join(F.transform(F.array_sort(F.collect_set("doc")), lambda d: d.cast("string")), sep).alias("docs")
    )


def basket_pairs(items: DataFrame, basket: str, item: str, chunk: int = 1024) -> DataFrame:
    """Unordered pairs of different items of a basket, ``basket, a, b`` with ``a < b``, ready for ``pair_count``.

    A basket is cut by a hash of the item into chunks of about ``chunk`` items. A small one is one sorted array whose pairs come
    out of it item by item; of larger ones each two chunks meet in a row of their own, so no basket, however full, is one
    array or one task. The output of a basket grows with the square of its size, as its pairs do.
    """
    rows = items.where(F.col(item).isNotNull()).select(basket, F.col(item).alias("_item")).distinct()
    sizes = rows.groupBy(basket).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > chunk).select(F.col(basket).alias("_large"), F.ceil(F.col("_n") / chunk).alias("_parts"))
    # few baskets are large; the others keep their rows where they are
    placed = rows.join(large, F.col(basket).eqNullSafe(F.col("_large")), "left").drop("_large")
    own = F.coalesce(F.pmod(F.xxhash64("_item"), F.col("_parts")), F.lit(0)).alias("_own")
    chunks = placed.select(basket, "_item", F.coalesce("_parts", F.lit(1)).alias("_parts"), own)
    arrays = chunks.groupBy(basket, "_parts", "_own").agg(F.sort_array(F.collect_list("_item")).alias("_items"))
    first = arrays.select(basket, "_items", F.posexplode("_items").alias("_at", "a"))
    within = first.select(basket, "a", F.explode(F.slice("_items", F.col("_at") + 2, F.size("_items"))).alias("b"))
    cut = arrays.where("_parts > 1")
    left = cut.where(F.col("_own") < F.col("_parts") - 1).select(
        basket, F.explode(F.sequence(F.col("_own") + 1, F.col("_parts") - 1)).alias("_other"), F.col("_items").alias("_first")
    )
    right = cut.select(F.col(basket).alias("_basket"), F.col("_own").alias("_other2"), F.col("_items").alias("_second"))
    met = left.join(right, F.col(basket).eqNullSafe(F.col("_basket")) & (F.col("_other") == F.col("_other2")))
    crossed = met.select(basket, F.explode("_first").alias("x"), "_second").select(basket, "x", F.explode("_second").alias("y"))
    between = crossed.select(basket, F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return within.unionByName(between)


def pair_count(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of unordered pairs, given one row per pair."""
    return pairs.groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def group_agg(df: DataFrame, keys: Sequence[str], value: str, drop_null_keys: bool = True) -> DataFrame:
    """sum, mean, max, min, non-null count and size per group; rows with a NULL key are left out."""
    rows = df.na.drop(subset=list(keys)) if drop_null_keys else df
    return rows.groupBy(*keys).agg(
        F.sum(value).alias("sum"),
        F.avg(value).alias("mean"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
        F.count(value).alias("count"),
        F.count(F.lit(1)).alias("size"),
    )


def group_by_expr(df: DataFrame, expr: Column, value: str, name: str = "key") -> DataFrame:
    return df.groupBy(expr.alias(name)).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("size"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column))


def count_by(df: DataFrame, column: str, group: str | None = None) -> DataFrame:
    return df.groupBy(*[c for c in (column, group) if c]).agg(F.count(F.lit(1)).alias("n"))


def long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value`` rows of the numeric columns."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )


def column_aggregates(df: DataFrame, columns: Sequence[str], functions: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per column with the given aggregates, all from one row of sums over the table."""
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in functions.items()])
    cells = [F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in functions]) for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population variance and deviation, min, max, sum and exact median, one row per column."""
    moments = column_aggregates(
        df,
        columns,
        {"mean": F.avg, "variance": F.var_pop, "std": F.stddev_pop, "min": F.min, "max": F.max, "sum": F.sum},
    )
    middle = column_percentiles(df, columns, [0.5]).select("column", F.col("p0").alias("median"))
    return moments.join(middle, "column")


def column_product(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.product(column).alias("product"))


def describe_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, nulls, mean, std, min, quartiles, max and distinct rows of every numeric column."""
    columns = list(columns or column_kinds(df)[0])
    moments = column_aggregates(
        df,
        columns,
        {"count": F.count, "nulls": lambda c: F.count_if(c.isNull()), "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max},
    )
    quarters = column_percentiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("p0").alias("q1"), F.col("p1").alias("median"), F.col("p2").alias("q3")
    )
    return moments.join(quarters, "column", "left")


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def histogram(
    df: DataFrame, column: str, bins: int, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Counts in ``bins`` equal bins of [lo, hi]; values outside are cut; the last bin is closed."""
    if lo is None or hi is None:
        bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
        lo, hi = (bounds["lo"] if lo is None else lo), (bounds["hi"] if hi is None else hi)
    kept = df.where(F.col(column).between(lo, hi))
    if lo is None or hi is None or hi <= lo:  # nothing, or one value: a single bin
        return kept.groupBy(F.lit(0).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    last = F.least(F.floor((F.col(column) - lo) / F.lit((hi - lo) / bins)), F.lit(bins - 1))
    return kept.groupBy(last.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def threshold_report(df: DataFrame, column: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows below and at or above each threshold, and the removed share of the kept rows in %."""
    counts = df.agg(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.count_if(F.col(column) < t).alias("kept"),
                F.count_if(F.col(column) >= t).alias("removed"),
            ).alias(f"t{i}")
            for i, t in enumerate(thresholds)
        ]
    )
    rows = counts.select(F.explode(F.array(*[f"t{i}" for i in range(len(thresholds))])).alias("r")).select("r.*")
    return rows.withColumn("removed_pct", F.col("removed") / F.nullif(F.col("kept"), F.lit(0)) * 100)


def box_statistics(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    out = exact_percentiles(df, column, [0.0, 0.25, 0.5, 0.75, 1.0], by)
    names = ("min", "q1", "median", "q3", "max")
    return out.withColumnsRenamed({f"p{i}": n for i, n in enumerate(names)})


def bbox(df: DataFrame, lon: str, lat: str) -> DataFrame:
    return df.agg(
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"), F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat")
    )


def argmax_rows(df: DataFrame, column: str, key: str) -> DataFrame:
    """All rows that share the key of the row with the highest value (smallest key on ties)."""
    best = df.groupBy(key).agg(F.max(column).alias("_top")).orderBy(F.desc("_top"), F.asc(key)).limit(1).select(key)
    return df.join(best, key, "left_semi")


def corr_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """``a, b, value`` for every pair a <= b: ``pearson``, ``covariance`` or ``spearman``."""
    pairs = list(combinations_with_replacement(columns, 2))
    if method == "spearman":
        ranks = average_ranks(df, columns)
        middle = F.lit((df.select(*columns).na.drop().count() + 1) / 2)
        rank = {c: F.col(f"rank_{c}") - middle for c in columns}

        def measure(a: str, b: str) -> Column:
            spread = F.sum(F.col("n") * F.pow(rank[a], 2)) * F.sum(F.col("n") * F.pow(rank[b], 2))
            return F.sum(F.col("n") * rank[a] * rank[b]) / F.sqrt(spread)

        source = ranks
    else:
        function = {"pearson": F.corr, "covariance": F.covar_samp}[method]

        def measure(a: str, b: str) -> Column:
            return function(F.col(a).cast("double"), F.col(b).cast("double"))

        source = df
    row = source.agg(*[measure(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("value"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations of the columns with their row count ``n`` and average ranks ``rank_<column>``.

    Equal combinations are one row from the start; the ranks of a column come from running counts of
    its distinct values.
    """
    combos = materialise(df.select(*columns).na.drop().groupBy(*columns).agg(F.count(F.lit(1)).alias("n")))
    out = combos
    for name in columns:
        counts = combos.groupBy(F.col(name).alias("_v")).agg(F.sum("n").alias("_n"))
        ranks = running_totals(counts, ["_v"], ["_n"]).select(
            "_v", (F.col("cum__n") - (F.col("_n") - 1) / 2).alias(f"rank_{name}")
        )
        out = out.join(ranks, F.col(name) == F.col("_v")).drop("_v")
    return out


def distance_concentration(vectors: DataFrame, column: str, dims: Sequence[int]) -> DataFrame:
    """Smallest and largest norm over the first d coordinates, their ratio and the scaled norms."""
    norms = vectors.select(
        F.explode(F.array(*[F.lit(d) for d in dims])).alias("d"), F.col(column).cast("array<double>").alias("v")
    ).select(
        "d", F.sqrt(F.aggregate(F.slice("v", 1, F.col("d")), F.lit(0.0), lambda acc, x: acc + x * x)).alias("norm")
    )
    return norms.groupBy("d").agg(F.min("norm").alias("min_norm"), F.max("norm").alias("max_norm")).select(
        "d", "min_norm", "max_norm",
        (F.col("min_norm") / F.col("max_norm")).alias("ratio"),
        (F.col("min_norm") / F.sqrt("d")).alias("min_scaled"),
        (F.col("max_norm") / F.sqrt("d")).alias("max_scaled"),
    )


def normal_fit(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mu"), F.stddev_pop(column).alias("sigma"))


def qq_points(df: DataFrame, column: str, n: int) -> DataFrame:
    """Sample quantiles at the n points (i - 0.5) / n beside the normal quantiles."""
    marks = [(i + 0.5) / n for i in range(n)]
    sample = exact_percentiles(df, column, marks)
    points = [
        F.struct(
            F.lit(p).alias("p"), F.lit(NormalDist().inv_cdf(p)).alias("normal"), F.col(f"p{i}").alias("sample")
        )
        for i, p in enumerate(marks)
    ]
    return sample.select(F.explode(F.array(*points)).alias("q")).select("q.*")


def missing_ratio(df: DataFrame) -> DataFrame:
    """Share of NULL cells per column in %, columns without any left out, largest first."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in df.columns])
    return (
        shares.unpivot([], df.columns, "column", "missing_pct")
        .where(F.col("missing_pct") > 0)
        .orderBy(F.desc("missing_pct"), F.asc("column"))
    )


def weighted_metrics(results: DataFrame, metrics: Sequence[str], weight: str = "n") -> DataFrame:
    """Mean of per-group metrics weighted by group length."""
    return results.agg(*[(F.sum(F.col(m) * F.col(weight)) / F.sum(weight)).alias(m) for m in metrics])
