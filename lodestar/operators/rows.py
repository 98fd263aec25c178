"""Group-wise selection, ordering, splitting, sampling and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import HASH_RANGE, hash_fraction, key_hash
from lodestar.functions.text import tokenize, unnest
from lodestar.operators.scaling import (
    materialise,
    salted_lookup,
    top_k_per_key,
    with_row_number,
)


def group_max_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """Rows that hold the maximum of their group, ties included.

    The maximum is a partial aggregate; rows meet it by join, so a hot group is never one task's sort.
    """
    best = df.groupBy(key).agg(F.max(column).alias("_best"))
    return df.join(best, key).where(F.col(column) == F.col("_best")).select(*df.columns)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by an explicit order, as a partial aggregate of whole rows."""
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(c) for c in [*ordered, *[c for c in rest if c not in ordered]]])
    return df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def days_since_threshold(
    df: DataFrame, key: str, date: str, value: str, threshold: float, name: str = "day"
) -> DataFrame:
    """Days since the first date on which a key reaches the threshold; earlier rows and keys that never
    reach it are dropped."""
    first = df.where(F.col(value) >= threshold).groupBy(key).agg(F.min(date).alias("_first"))
    return (
        df.join(first, key)
        .withColumn(name, F.datediff(date, "_first"))
        .where(F.col(name) >= 0)
        .drop("_first")
    )


def split_per_user(
    ratings: DataFrame, user: str, order: Sequence[str], start: int = 1, stop: int = 10, max_test: int | None = None
) -> DataFrame:
    """Add ``part``: a user's ratings number start..stop in the given order are ``test``, others ``base``.

    The order must be total. ``max_test`` limits the test rows over all users in that order.
    """
    order_cols = [F.asc(c) for c in order]
    test = top_k_per_key(ratings, [user], order_cols, stop, "_n").where(F.col("_n") >= start).drop("_n")
    if max_test is not None:
        test = with_row_number(test, order, "_all").where(F.col("_all") <= max_test).drop("_all")
    keys = list(dict.fromkeys([user, *order]))
    marked = test.select(*keys, F.lit("test").alias("_part"))
    return ratings.join(marked, keys, "left").select(
        *ratings.columns, F.coalesce("_part", F.lit("base")).alias("part")
    )


def kfold_blocks(df: DataFrame, k: int, order: Sequence[str], name: str = "fold") -> DataFrame:
    """Positional folds 1..k: consecutive blocks of the ordered rows, sizes equal up to one row."""
    numbered = with_row_number(df, order, "_pos")
    n = numbered.agg(F.max("_pos")).first()[0] or 0
    small, longer = divmod(n, k)
    edge = longer * (small + 1)
    pos = F.col("_pos") - 1
    if small == 0:
        fold = pos + 1
    else:
        fold = F.when(pos < edge, F.floor(pos / (small + 1)) + 1).otherwise(
            F.floor((pos - edge) / small) + longer + 1
        )
    return numbered.withColumn(name, fold.cast("int")).drop("_pos")


def surrogate_key(df: DataFrame, columns: Sequence[str], name: str = "id") -> DataFrame:
    """Distinct groups with a dense id 1..n in the order of the columns."""
    return with_row_number(df.select(*columns).distinct(), list(columns), name)


def top_groups(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    """All rows of the k keys with the largest maximum."""
    best = df.groupBy(key).agg(F.max(value).alias("_m")).orderBy(F.desc("_m"), F.asc(key)).limit(k)
    return df.join(best.select(key), key, "left_semi")


def extreme_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def tail_rows(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Last k rows of the order, in that order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(k).orderBy(*[F.asc(c) for c in order])


def union_with_origin(frames: Mapping[str, DataFrame], origin: str = "origin") -> DataFrame:
    """Stack tables by column name, missing columns as NULL, with a column that names the table."""
    out = None
    for name, frame in frames.items():
        frame = frame.withColumn(origin, F.lit(name))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def common_words(a: DataFrame, b: DataFrame, column: str = "value") -> DataFrame:
    """Distinct words found in both texts."""
    each = [unnest(df, tokenize(column), "word").distinct() for df in (a, b)]
    return each[0].join(each[1], "word", "left_semi")


def sample_hash(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    return df.where(hash_fraction(keys, seed) < fraction)


def sample_n(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all, if fewer): the n smallest key hashes."""
    numbered = with_row_number(df.withColumn("_h", key_hash(keys, seed)), ["_h", *keys], "_pos")
    return numbered.where(F.col("_pos") <= n).drop("_h", "_pos")


def split_weights(df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Disjoint random parts with the given shares of all rows (weights need not sum to one)."""
    total, low, parts = float(sum(weights)), 0.0, []
    fraction = hash_fraction(keys, seed)
    for i, weight in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + weight / total
        parts.append(df.where((fraction >= low) & (fraction < high)))
        low = high
    return parts


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], share: float = 0.8, seed: int = 42, name: str = "part"
) -> DataFrame:
    """Mark ``train``/``test`` so that every class is split at the same share up to one row.

    Rows are numbered over (class, hash); the share applies to the position inside the class, which is
    the number minus the rows of earlier classes, so a class is never sorted by one task.
    """
    hashed = df.withColumn("_h", key_hash(keys, seed))
    numbered = with_row_number(hashed, [label, "_h", *keys], "_pos")
    classes = numbered.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    place = F.col("_pos") - F.col("_first")
    return (
        salted_lookup(numbered, classes, [label])
        .withColumn(name, F.when(place < F.round(F.col("_n") * share), "train").otherwise("test"))
        .drop("_h", "_pos", "_n", "_first")
    )


def shuffle_splits(df: DataFrame, keys: Sequence[str], splits: int = 8, share: float = 0.5, seed: int = 42) -> DataFrame:
    """Independent random halves: one row per (split, row) with its part."""
    return df.select("*", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split")).withColumn(
        "part", F.when(hash_fraction([*keys, "split"], seed) < share, "train").otherwise("test")
    )


def fold_column(keys: Sequence[str], k: int, seed: int = 42) -> Column:
    return F.floor(hash_fraction(keys, seed) * k).cast("int")


def bootstrap(df: DataFrame, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Sample with replacement of exactly the same size.

    Draw i picks row number hash(i); draws are counted per picked row before the join, and the row is
    repeated that often (a count that stays near ln n / ln ln n).
    """
    numbered = materialise(with_row_number(df, list(keys), "_pos"))
    n = numbered.count()
    # two hashes give 63 bits, enough for any row count
    wide = F.pmod(key_hash(["id"], seed), F.lit(HASH_RANGE // 2)) * F.lit(HASH_RANGE) + key_hash(["id"], seed + 1)
    picks = (
        df.sparkSession.range(1, n + 1)
        .select((F.pmod(wide, F.lit(max(n, 1))) + 1).alias("_pos"))
        .groupBy("_pos")
        .agg(F.count(F.lit(1)).cast("int").alias("_times"))
    )
    return (
        numbered.join(picks, "_pos")
        .withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .drop("_pos", "_times")
    )
