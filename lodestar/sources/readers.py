"""Sources: text, delimited, JSON, Parquet, database, edge list and labelled folders.

Every reader takes an explicit schema (or reads plain strings and converts named columns), so no
pass over the data is spent on inference unless the job asks for it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RATINGS = "user INT, item INT, rating DOUBLE, ts BIGINT"


def read_lines(spark: SparkSession, path: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """One row per line of a file, folder or glob."""
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    return lines.repartition(partitions) if partitions else lines


def read_posts(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Header-less tab-separated posts, lines trimmed; unlabelled files have no ``tags`` column."""
    names = ["id", "title", "body"] + (["tags"] if labelled else [])
    fields = F.split(F.btrim("value", F.lit(" \t\r\n")), "\t")
    return spark.read.text(path).select(*[F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_json_view(
    spark: SparkSession, path: str, name: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """JSON lines registered as a temporary view; the schema is inferred only when none is given."""
    table = spark.read.json(path, schema=schema) if schema else spark.read.json(path)
    table.createOrReplaceTempView(name)
    return table


def read_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, spread: bool = False
) -> DataFrame:
    """Parquet table. ``spread`` deals the rows out to all cores, for a table that is known to be one row group."""
    table = spark.read.parquet(path)
    table = table.select(*columns) if columns else table
    return table.repartition(spark.sparkContext.defaultParallelism) if spread else table


def read_csv_typed(
    spark: SparkSession,
    path: str,
    casts: Mapping[str, str] | None = None,
    dates: Mapping[str, str] | None = None,
    sep: str = ",",
    missing: Sequence[str] = ("", "NaN"),
    strict: bool = True,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with header read as strings; ``casts`` are column types, ``dates`` are column formats.

    ``strict`` raises on a value that does not convert, otherwise it becomes NULL.
    """
    raw = spark.read.csv(path, header=True, sep=sep, inferSchema=False)
    raw = raw.select(*columns) if columns else raw
    out: dict[str, Column] = {}
    for name, kind in (casts or {}).items():
        text = F.when(~F.col(name).isin(list(missing)), F.col(name))
        out[name] = text.cast(kind) if strict else text.try_cast(kind)
    for name, fmt in (dates or {}).items():
        out[name] = F.to_date(name, fmt) if strict else F.to_date(F.try_to_timestamp(F.col(name), F.lit(fmt)))
    return raw.withColumns(out) if out else raw


def read_delim(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str | T.StructType,
    na: str = "-",
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Typed delimited source with a missing-value mark; compression follows the file extension."""
    return spark.read.csv(
        path if isinstance(path, str) else list(path), sep=sep, header=header, schema=schema, nullValue=na
    )


def read_years(
    spark: SparkSession,
    path_of: Callable[[int], str],
    years: Sequence[int],
    schema: str | T.StructType,
    separators: Mapping[int, str] | None = None,
    na: str = "-",
) -> DataFrame:
    """Stack one file per year. Years that share a separator are read by one scan."""
    separators = separators or {}
    by_sep: dict[str, list[str]] = {}
    for year in years:
        by_sep.setdefault(separators.get(year, ","), []).append(path_of(year))
    frames = [read_delim(spark, paths, schema, na=na, sep=sep) for sep, paths in sorted(by_sep.items())]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_sql(spark: SparkSession, url: str | None, query: str, **options: str) -> DataFrame:
    """A query pushed to a database, or run over registered views when no URL is given.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` for a parallel read.
    """
    if url is None:
        return spark.sql(query)
    if "partitionColumn" in options:
        return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) AS q", **options).load()
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def read_edges(
    spark: SparkSession, path: str, sep: str = " ", directed: bool = True, kind: str = "BIGINT"
) -> DataFrame:
    """Edge list ``src, dst``; ``#`` lines are comments. Undirected edges are stored once, smaller end first."""
    raw = spark.read.csv(path, sep=sep, schema=f"src {kind}, dst {kind}", comment="#")
    edges = raw.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    if not directed:
        edges = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return edges.distinct()


def graph_size(edges: DataFrame) -> DataFrame:
    """Node and edge counts in one pass over the edges."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("node"), F.lit(0).alias("edge"))
    return ends.agg(F.count_distinct("node").alias("nodes"), F.expr("count(*) div 2").alias("edges"))


def canonical_edges(edges: DataFrame) -> DataFrame:
    """Each undirected edge once with ``src < dst``, loops dropped."""
    return (
        edges.where(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


def read_labelled_dirs(
    spark: SparkSession, root: str, positive: str = "pos", whole_files: bool = True
) -> DataFrame:
    """Documents below ``root/<label folder>/``; ``label`` is 1 for the positive folder.

    A file is one document, or one document per line with ``whole_files=False`` (large corpora).
    """
    files = spark.read.text(f"{root}/*/*", wholetext=whole_files).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )
    return files.withColumn(
        "label", (F.element_at(F.split("path", "/"), -2) == F.lit(positive)).cast("int")
    )


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=RATINGS)


def merge_nodes(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Upsert nodes by key: incoming properties win where present, label arrays are united."""
    old, new = existing.alias("old"), incoming.alias("new")
    columns = [c for c in dict.fromkeys(existing.columns + incoming.columns) if c not in (key, "labels")]

    def pick(name: str) -> Column:
        sides = [F.col(f"{s}.{name}") for s, df in (("new", incoming), ("old", existing)) if name in df.columns]
        return F.coalesce(*sides).alias(name)

    empty = F.array().cast("array<string>")
    labels = F.array_sort(
        F.array_union(F.coalesce("old.labels", empty), F.coalesce("new.labels", empty))
    ).alias("labels")
    return old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full").select(
        F.coalesce(f"new.{key}", f"old.{key}").alias(key), labels, *[pick(c) for c in columns]
    )


def load_relations(rows: DataFrame, src: str, dst: str, kind: str) -> DataFrame:
    """Relations ``src, type, dst``; every input row creates one, as CREATE does."""
    return rows.select(F.col(src).alias("src"), F.lit(kind).alias("type"), F.col(dst).alias("dst"))


_INT_STEPS = (("tinyint", 8), ("smallint", 16), ("int", 32))
_FLOAT32_MAX = 3.4028234663852886e38


def narrowest_types(df: DataFrame) -> dict[str, str]:
    """Smallest type per numeric column by strict limits, from one aggregate over all columns."""
    ints = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not ints + floats:
        return {}
    bounds = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in ints + floats], *[F.max(c).alias(f"max_{c}") for c in ints + floats]
    ).first()
    kinds: dict[str, str] = {}
    for name in ints:
        low, high = bounds[f"min_{name}"], bounds[f"max_{name}"]
        fits = [t for t, bits in _INT_STEPS if low is not None and -(2 ** (bits - 1)) < low and high < 2 ** (bits - 1) - 1]
        kinds[name] = fits[0] if fits else "bigint"
    for name in floats:
        low, high = bounds[f"min_{name}"], bounds[f"max_{name}"]
        kinds[name] = "float" if low is not None and -_FLOAT32_MAX < low and high < _FLOAT32_MAX else "double"
    return kinds


def narrow_types(df: DataFrame) -> DataFrame:
    kinds = narrowest_types(df)
    return df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items()}) if kinds else df
