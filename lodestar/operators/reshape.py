"""Wide and long forms, dummy columns, encodings and normal forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.rows import surrogate_key

MAX_COLUMNS = 10000


def melt(
    df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, var: str = "variable", value: str = "value",
    drop_null: bool = False,
) -> DataFrame:
    values = list(values) if values is not None else [c for c in df.columns if c not in ids]
    out = df.unpivot(list(ids), values, var, value)
    return out.where(F.col(value).isNotNull()) if drop_null else out


def column_values(df: DataFrame, column: str) -> list:
    """Sorted distinct values that become columns; more than Spark's pivot limit is an error, not a cut."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"{column} has more than {MAX_COLUMNS} values")
    return sorted(r[0] for r in rows)


def pivot_table(
    df: DataFrame, index: str | Sequence[str], columns: str, values: str, agg: str = "avg", names: Sequence | None = None
) -> DataFrame:
    """Pivot with mean, max, count ...; ``agg=None`` style pivots use ``pivot_unique``."""
    index = [index] if isinstance(index, str) else list(index)
    names = list(names) if names is not None else column_values(df, columns)
    return df.groupBy(*index).pivot(columns, names).agg(getattr(F, agg)(values))


def pivot_unique(
    df: DataFrame, index: str | Sequence[str], columns: str, values: str, names: Sequence | None = None
) -> DataFrame:
    """Pivot without aggregation; a cell with two rows is an error, raised while the pivot runs."""
    index = [index] if isinstance(index, str) else list(index)
    names = list(names) if names is not None else column_values(df, columns)
    cells = df.groupBy(*index, columns).agg(F.first(values).alias("_v"), F.count(F.lit(1)).alias("_n"))
    checked = cells.withColumn(
        "_v", F.when(F.col("_n") == 1, F.col("_v")).otherwise(F.raise_error(F.lit("duplicate entries in pivot")))
    )
    return checked.groupBy(*index).pivot(columns, names).agg(F.first("_v", ignorenulls=True))


def stack(df: DataFrame, ids: Sequence[str], level: str, value: str) -> DataFrame:
    """Columns to rows; NULL cells are dropped."""
    return melt(df, ids, var=level, value=value, drop_null=True)


def transpose(df: DataFrame, key: str) -> DataFrame:
    """Swap rows and columns of a small table (Spark limits the row count itself)."""
    return df.transpose(F.col(key))


def split_sex_age(df: DataFrame, column: str = "variable") -> DataFrame:
    """``m1524`` to sex ``m`` and age ``15-24``, ``65`` to ``65+``; the unknown group ``mu`` is dropped."""
    digits = F.substr(column, F.lit(2))
    age = (
        F.when(digits == "04", "0-4")
        .when(digits == "65", "65+")
        .otherwise(F.concat(F.left(digits, F.length(digits) - 2), F.lit("-"), F.right(digits, F.lit(2))))
    )
    return df.where(~F.col(column).isin("mu", "fu")).withColumns({"sex": F.substring(column, 1, 1), "age": age})


def day_columns_to_date(
    df: DataFrame, ids: Sequence[str], year: str = "year", month: str = "month", value: str = "value"
) -> DataFrame:
    """Columns d1..d31 to one row per day that holds a value."""
    days = [c for c in df.columns if c not in ids and c.startswith("d") and c[1:].isdigit()]
    long = melt(df, list(ids), days, "_day", value, drop_null=True)
    rest = [c for c in ids if c not in (year, month)]
    return long.select(
        *rest,
        F.make_date(F.col(year).cast("int"), F.col(month).cast("int"), F.substr("_day", F.lit(2)).cast("int")).alias("date"),
        value,
    )


def normalise(df: DataFrame, entity: Sequence[str], name: str = "id") -> tuple[DataFrame, DataFrame]:
    """Split a wide table into entities with a dense id and facts that refer to it."""
    entities = surrogate_key(df, entity, name)
    facts = df.join(entities, list(entity)).drop(*entity)
    return entities, facts


def dummy_levels(train: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    return {c: column_values(train, c) for c in columns}


def dummies(df: DataFrame, levels: Mapping[str, Sequence], prefixes: Mapping[str, str] | None = None) -> DataFrame:
    """0/1 columns for the levels fixed on the training rows; unseen levels give zeros."""
    prefixes = prefixes or {}
    flags: dict[str, Column] = {}
    for column, values in levels.items():
        for v in values:
            flags[f"{prefixes.get(column, column)}_{v}"] = F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(flags).drop(*levels)


def ordinal_encode(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Code 0..n-1 by sorted value."""
    codes = surrogate_key(df.where(F.col(column).isNotNull()), [column], "_code")
    return df.join(codes, column, "left").withColumn(name or f"{column}_code", F.col("_code") - 1).drop("_code")


def ordinal_decode(df: DataFrame, codes: DataFrame, code: str, value: str) -> DataFrame:
    return df.join(codes.select(code, value), code, "left")
