"""Column expressions and row-wise jobs: recoding, imputing, dates, rates, distances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EARTH_RADIUS_KM = 6373.0  # fixed value: the radius in km that the distances must use


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


@F.arrow_udf(T.StructType([T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType()))]))
def _stored(vectors: pa.Array) -> pa.Array:
    _, _, places, x = vectors.flatten()
    if places.null_count:  # a dense vector stores all its components
        sizes = pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        counted = pa.array(np.arange(ends[-1]) - np.repeat(ends[:-1], sizes), pa.int32())
        places = pc.coalesce(places, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), counted).cast(places.type))
    return pa.StructArray.from_arrays([places, x], ["i", "x"], mask=vectors.is_null())


def stored_components(features: str | Column) -> Column:
    """Places ``i`` and values ``x`` of the components that a vector column stores: a sparse vector is not filled up with zeros."""
    return _stored(col(features))


HASH_RANGE = 1 << 32


def key_hash(keys: Sequence[str | Column], seed: int | Column = 42) -> Column:
    """A number in [0, 2^32) from a row key: the first 32 bits of an MD5, so that samples are the same on
    every layout of the data and can be drawn by other engines too."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    text = F.concat_ws(":", *[col(k).cast("string") for k in keys], seed.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_fraction(keys: Sequence[str | Column], seed: int = 42) -> Column:
    """A reproducible number in [0, 1) from a row key."""
    return key_hash(keys, seed) / F.lit(float(HASH_RANGE))


# --- filters -----------------------------------------------------------------------------------


def filter_bounds(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """Keep rows inside all bounds ``{column: (low, high, low_closed, high_closed)}``; None is no limit."""
    tests = []
    for name, (low, high, low_closed, high_closed) in bounds.items():
        if low is not None:
            tests.append(F.col(name) >= low if low_closed else F.col(name) > low)
        if high is not None:
            tests.append(F.col(name) <= high if high_closed else F.col(name) < high)
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df


# The limits of an ordinary house sale (low, high, low closed, high closed).
SALE_BOUNDS = {
    "valeurfonc": (10, 1000000, False, False),
    "sterr": (None, 10000, False, False),
    "nbpprinc": (0, 10, False, True),
    "sbati": (None, 500, False, True),
}


def filter_extremes(df: DataFrame, bounds: Mapping[str, tuple] = SALE_BOUNDS) -> DataFrame:
    return filter_bounds(df, bounds)


def filter_time(
    df: DataFrame,
    ts: str,
    start: str | None = None,
    end: str | None = None,
    months: Sequence[int] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows with ``start <= ts < end``, month in a set, hour in ``[from, to)``."""
    kind = df.schema[ts].dataType
    out = df
    if start is not None:
        out = out.where(F.col(ts) >= F.lit(start).cast(kind))
    if end is not None:
        out = out.where(F.col(ts) < F.lit(end).cast(kind))
    if months is not None:
        out = out.where(F.month(ts).isin(list(months)))
    if hours is not None:
        out = out.where((F.hour(ts) >= hours[0]) & (F.hour(ts) < hours[1]))
    return out


# --- recoding ----------------------------------------------------------------------------------


def recode(c: str | Column, mapping: Mapping, nulls: Sequence = ("0", "")) -> Column:
    """Replace codes by labels; unmapped codes stay, codes in ``nulls`` become NULL."""
    c = col(c)
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    labelled = F.coalesce(table[c], c)
    return F.when(~c.isin(list(nulls)), labelled) if nulls else labelled


def recode_join(df: DataFrame, name: str, codes: DataFrame) -> DataFrame:
    """The same for a large code table ``(code, label)``; Spark broadcasts it when it is small enough."""
    joined = df.join(codes.select(F.col("code").alias(name), "label"), name, "left")
    return joined.withColumn(name, F.coalesce("label", name)).drop("label").select(*df.columns)


def score_labels(c: str | Column, scores: Mapping[str, float], default: float | None = None) -> Column:
    """Ordinal score of a label as double; labels without a score get the default."""
    table = F.create_map(*[F.lit(x) for k, v in scores.items() for x in (k, float(v))])
    score = table[col(c)]
    return score if default is None else F.coalesce(score, F.lit(float(default)))


def collapse_levels(
    c: str | Column, groups: Mapping[str, Sequence[str]], missing: str = "(Inconnu)", other: str = "Other"
) -> Column:
    """Many labels to few groups; NULL to ``missing``, everything else to ``other``."""
    c = col(c)
    out = F.when(c.isNull(), F.lit(missing))
    for group, members in groups.items():
        out = out.when(c.isin(list(members)), F.lit(group))
    return out.otherwise(F.lit(other))


# --- missing values ----------------------------------------------------------------------------


def column_kinds(df: DataFrame) -> tuple[list[str], list[str]]:
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return numeric, text


def impute(
    df: DataFrame,
    numeric: str | float = "mean",
    categorical: str = "missing",
    add_indicator: bool = False,
    fitted: Mapping | None = None,
) -> DataFrame:
    """Fill NULL numbers with the mean, median or a constant and NULL text with a label.

    Pass ``fitted`` (from ``impute_values`` on the training rows) to avoid reading the scored rows.
    """
    values = dict(fitted) if fitted is not None else impute_values(df, numeric, categorical)
    out = df
    if add_indicator:
        out = out.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in values})
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def impute_values(df: DataFrame, numeric: str | float = "mean", categorical: str = "missing") -> dict:
    from lodestar.operators.scaling import exact_median

    numbers, text = column_kinds(df)
    if numeric == "mean" and numbers:
        row = df.agg(*[F.avg(c).alias(c) for c in numbers]).first().asDict()
    elif numeric == "median":
        row = {c: (exact_median(df, c).first() or {"median": None})["median"] for c in numbers}
    else:
        row = {c: numeric for c in numbers}
    return {**{c: v for c, v in row.items() if v is not None}, **{c: categorical for c in text}}


# --- dates -------------------------------------------------------------------------------------


def split_at(c: str | Column, pos: int) -> tuple[Column, Column]:
    """Split text after ``pos`` characters, counted from the right when negative."""
    c = col(c)
    if pos >= 0:
        return F.substring(c, 1, pos), F.substr(c, F.lit(pos + 1))
    cut = F.greatest(F.length(c) + pos, F.lit(0))
    return F.left(c, cut), F.right(c, F.lit(-pos))


def timestamp_from_parts(
    year: Column, month: Column, day: Column, hour: Column, minute: Column, century: int = 2000
) -> Column:
    """Timestamp from a two-digit year and text parts; an empty hour is 0."""
    hour = F.when(hour == "", F.lit("0")).otherwise(hour)
    return F.make_timestamp_ntz(
        F.lit(century) + year.cast("int"), month.cast("int"), day.cast("int"), hour.cast("int"), minute.cast("int"),
        F.lit(0).cast("decimal(16,6)"),
    )


def parse_date(c: str | Column, formats: Sequence[str]) -> Column:
    """First format that fits; the order of formats settles day-first or month-first."""
    return F.coalesce(*[F.to_date(F.try_to_timestamp(col(c), F.lit(f))) for f in formats])


def calendar_features(df: DataFrame, date: str, origin: str = "2013-01-01") -> DataFrame:
    d = F.to_date(date)
    return df.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "day": F.day(d),
            "weekday": F.weekday(d),
            "week": F.weekofyear(d),
            "n_days": F.datediff(d, F.lit("1970-01-01").cast("date")),
            "isweekend": F.weekday(d).isin(5, 6).cast("int"),
            "quarter": F.quarter(d),
            "days_from_origin": F.datediff(d, F.lit(origin).cast("date")),
        }
    )


def holiday_features(df: DataFrame, date: str, holidays: DataFrame, days: int = 2) -> DataFrame:
    """Flags around holidays ``(holiday DATE)``: the day, the next days, the last days, either.

    The calendar becomes one row per day near a holiday, so the join stays an equality on the date.
    """
    near = (
        holidays.select(F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("_step"), "holiday")
        .select(F.date_add("holiday", F.col("_step")).alias("_day"), "_step")
        .groupBy("_day")
        .agg(
            F.max((F.col("_step") == 0).cast("int")).alias("_is"),
            F.max((F.col("_step") <= 0).cast("int")).alias("_next"),
            F.max((F.col("_step") >= 0).cast("int")).alias("_last"),
        )
    )
    joined = df.join(near, F.to_date(date) == F.col("_day"), "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(0))
    return joined.select(
        *df.columns,
        flag("_is").alias("isHoliday"),
        flag("_next").alias("isHoliday_in_next_days"),
        flag("_last").alias("isHoliday_in_last_days"),
        F.greatest(flag("_next"), flag("_last")).alias("isHoliday_within_days"),
    )


def add_weeks(date: str | Column, week: str | Column) -> Column:
    """Date of the n-th week counted from 1."""
    return F.date_add(col(date), (7 * (col(week) - 1)).cast("int"))


# --- numbers -----------------------------------------------------------------------------------


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2) - F.radians(lat1), F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def rate_columns(
    df: DataFrame, prefix: str = "Nb ", denominator: str = "Population", out_prefix: str = "Taux de "
) -> DataFrame:
    """For each numeric ``Nb X`` add ``Taux de X`` = X / population * 100; NULL where the population is 0."""
    numeric, _ = column_kinds(df)
    base = F.nullif(F.col(f"`{denominator}`"), F.lit(0))
    return df.withColumns(
        {
            out_prefix + c[len(prefix):]: F.col(f"`{c}`") / base * 100
            for c in numeric
            if c.startswith(prefix)
        }
    )


def per_million(value: str | Column, population: str | Column) -> Column:
    return col(value) / (F.nullif(col(population), F.lit(0)) / 1000000)


def annotate(c: str | Column, threshold: float, above: str = "large", below: str = "small") -> Column:
    return F.when(col(c) > threshold, F.lit(above)).otherwise(F.lit(below))


def zscore(df: DataFrame, columns: Sequence[str], population: bool = True, suffix: str = "_z") -> DataFrame:
    """Standardise columns; the moments of all columns come from one aggregate."""
    spread = F.stddev_pop if population else F.stddev_samp
    m = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[spread(c).alias(f"s_{c}") for c in columns]
    ).first()

    def scaled(c: str) -> Column:
        mean, dev = m[f"m_{c}"], m[f"s_{c}"]
        return (F.col(c) - F.lit(mean)) / F.lit(dev) if dev else F.lit(None).cast("double")

    return df.withColumns({c + suffix: scaled(c) for c in columns})


def ratio_to(df: DataFrame, columns: Sequence[str], by: DataFrame, suffix: str = "_ratio") -> DataFrame:
    """Divide columns by the values of a one-row frame (a reference row or the means)."""
    base = by.select(*columns).limit(2).collect()
    if len(base) != 1:
        raise ValueError("the reference must be exactly one row")
    return df.withColumns({c + suffix: F.col(c) / F.lit(float(base[0][c])) for c in columns})


# --- fixed-width weather records -----------------------------------------------------------------


def parse_weather(lines: DataFrame, value: str = "value") -> DataFrame:
    """Year and temperature from fixed positions; code 9999 and bad quality marks are dropped."""
    c = F.col(value)
    fields = lines.select(
        F.substring(c, 16, 4).alias("year"), F.substring(c, 88, 5).alias("temp"), F.substring(c, 93, 1).alias("quality")
    )
    return fields.where((F.col("temp") != "+9999") & F.col("quality").rlike("^[01459]$")).select(
        F.col("year").cast("int").alias("year"), F.col("temp").cast("int").alias("temp")
    )


def count_lines_containing(lines: DataFrame, words: Sequence[str], value: str = "value") -> DataFrame:
    """Total lines and lines containing each word, in one pass."""
    return lines.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(value).contains(w)).alias(f"n_{w}") for w in words],
    )


def profile_columns(df: DataFrame) -> DataFrame:
    """Kind, distinct values and NULL count of every column.

    Distinct counts come from one grouped count per column over (column, value) pairs, so no task
    holds the value set of a column.
    """
    numeric, _ = column_kinds(df)
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit("numeric" if c in numeric else "categorical").alias("kind"),
                        F.col(c).cast("string").alias("value"),
                    )
                    for c in df.columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    return (
        cells.groupBy("column", "kind", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column", "kind")
        .agg(
            F.count("value").alias("distinct_values"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        )
    )
