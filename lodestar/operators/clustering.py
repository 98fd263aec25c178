"""Clustering on Spark ML and the tables around it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans, PowerIterationClustering
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import zscore
from lodestar.operators.aggregates import corr_matrix
from lodestar.operators.scaling import column_percentiles, hot_keys, materialise, salted_lookup, with_row_number
from lodestar.operators.spectral import cells_of, laplacian_eigenvectors, truncated_svd
from lodestar.sources.readers import canonical_edges


def as_vector(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name, handleInvalid="error").transform(df)


def kmeans(df: DataFrame, features: str, k: int, seed: int = 42, max_iter: int = 20):
    """Fitted k-means (k-means|| start); ``transform`` gives the cluster, ``summary.trainingCost`` the cost."""
    return KMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed, maxIter=max_iter).fit(df)


def kmeans_centres(model, spark) -> DataFrame:
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cluster INT, centre ARRAY<DOUBLE>")


def kmeans_sweep(df: DataFrame, features: str, ks: Sequence[int], seed: int = 42) -> DataFrame:
    """Within-cluster cost by number of clusters."""
    stored = materialise(df.select(features))
    costs = [(int(k), float(kmeans(stored, features, k, seed).summary.trainingCost)) for k in ks]
    return df.sparkSession.createDataFrame(costs, "k INT, cost DOUBLE")


def cluster_profile(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Size and column means of every cluster."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in columns])


def bisecting_clusters(df: DataFrame, features: str, k: int, seed: int = 42):
    """Top-down hierarchy of clusters; stands in for bottom-up linkage, which needs all distances."""
    return BisectingKMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed).fit(df)


def cluster_graph(edges: DataFrame, k: int, max_iter: int = 20) -> DataFrame:
    """``node, cluster`` by power iteration on the similarity graph, the distributed relative of
    spectral clustering. Vertex ids are replaced by dense numbers and back."""
    und = canonical_edges(edges)
    nodes = materialise(
        with_row_number(und.select(F.explode(F.array("src", "dst")).alias("node")).distinct(), ["node"], "_n")
    )
    pairs = und.join(nodes.select(F.col("node").alias("src"), F.col("_n").alias("a")), "src").join(
        nodes.select(F.col("node").alias("dst"), F.col("_n").alias("b")), "dst"
    )
    found = PowerIterationClustering(k=k, maxIter=max_iter, srcCol="a", dstCol="b", initMode="degree").assignClusters(
        pairs.select("a", "b")
    )
    return found.join(nodes, F.col("id") == F.col("_n")).select("node", "cluster")


def pca(df: DataFrame, columns: Sequence[str], k: int, id_col: str):
    """Standardised PCA: (axis table, projected rows).

    The axis table holds the explained share and eigenvalue per axis; the eigenvalues of the correlation
    matrix sum to the number of columns.
    """
    z = zscore(df.na.drop(subset=list(columns)), columns)
    vectors = assemble(z, [f"{c}_z" for c in columns], "_z")
    model = PCA(k=k, inputCol="_z", outputCol="_axes").fit(vectors)
    shares = [(i + 1, float(s), float(s) * len(columns)) for i, s in enumerate(model.explainedVariance)]
    axes = df.sparkSession.createDataFrame(shares, "axis INT, share DOUBLE, eigenvalue DOUBLE")
    rows = model.transform(vectors).select(id_col, *columns, vector_to_array("_axes").alias("axes"))
    return axes, rows


def axis_correlations(rows: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Correlation of the variables with the axes and its square (quality of representation)."""
    wide = rows.select(*columns, *[F.col("axes")[i].alias(f"axis{i + 1}") for i in range(k)])
    names = [f"axis{i + 1}" for i in range(k)]
    cells = corr_matrix(wide, [*columns, *names]).where(F.col("a").isin(list(columns)) & F.col("b").isin(names))
    return cells.select(F.col("a").alias("variable"), F.col("b").alias("axis"), "value", F.pow("value", 2).alias("cos2"))


def spectral_clusters(edges: DataFrame, k: int, seed: int = 42) -> tuple[list[float], DataFrame]:
    """The k smallest eigenvalues of the graph's Laplacian and ``node, cluster`` by k-means on its vertices' components."""
    values, rows = laplacian_eigenvectors(edges, k)
    if not values:
        return values, rows.select("node", F.lit(0).alias("cluster"))
    placed = as_vector(materialise(rows), "axes")
    return values, kmeans(placed, "features", k, seed).transform(placed).select("node", "cluster")


def lsa(df: DataFrame, id_col: str, features: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Truncated SVD of a vector column with unique ids: (singular values, ``id, axes`` of every row). The vectors may be
    sparse and of any length; a row of zeros has zeros as axes."""
    ids = materialise(with_row_number(df.select(F.col(id_col).alias("id")), ["id"], "_n"))
    numbered = df.select(F.col(id_col).alias("_id"), features).join(ids, F.col("_id").eqNullSafe(F.col("id"))).select("_n", features)
    return lsa_cells(cells_of(numbered, "_n", features), ids, k)


def lsa_weights(weights: DataFrame, k: int, tol: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """As ``lsa`` for unique ``weights(doc, word, weight)``: the words are the columns, whatever their number."""
    stored = materialise(weights)
    ids = materialise(with_row_number(stored.select(F.col("doc").alias("id")).distinct(), ["id"], "_n"))
    words = materialise(with_row_number(stored.select("word").distinct(), ["word"], "col"))
    rows = salted_lookup(stored, ids.select(F.col("id").alias("doc"), F.col("_n").alias("row")), ["doc"])
    placed = salted_lookup(rows, words, ["word"], hot_keys(stored, ["word"]))
    return lsa_cells(placed.select("row", "col", F.col("weight").alias("value")), ids, k, tol)


def lsa_cells(cells: DataFrame, ids: DataFrame, k: int, tol: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    singular, rows, _ = truncated_svd(cells, k, tol=tol)
    values = [(i + 1, v) for i, v in enumerate(singular)]
    zeros = F.array_repeat(F.lit(0.0), len(singular))
    projected = ids.join(rows.withColumnRenamed("id", "_row"), F.col("_n") == F.col("_row"), "left")
    return (
        ids.sparkSession.createDataFrame(values, "axis INT, singular DOUBLE"),
        projected.select("id", F.coalesce("axes", zeros).alias("axes")),
    )


def scale_expressions(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """Standard, robust (median and quartiles), min-max or unit-norm scaling as ``<column>_s``."""
    if kind == "unit":
        norm = F.sqrt(sum((F.col(c) * F.col(c) for c in columns[1:]), F.col(columns[0]) * F.col(columns[0])))
        return df.withColumns({f"{c}_s": F.col(c) / F.nullif(norm, F.lit(0.0)) for c in columns})
    if kind == "standard":
        return zscore(df, columns, population=True, suffix="_s")
    if kind == "minmax":
        m = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
        centre = {c: m[f"lo_{c}"] for c in columns}
        width = {c: m[f"hi_{c}"] - m[f"lo_{c}"] for c in columns}
    elif kind == "robust":
        q = {r["column"]: r for r in column_percentiles(df, columns, [0.25, 0.5, 0.75]).collect()}
        centre = {c: q[c]["p1"] for c in columns}
        width = {c: q[c]["p2"] - q[c]["p0"] for c in columns}
    else:
        raise ValueError(f"unknown kind {kind}")
    return df.withColumns(
        {f"{c}_s": (F.col(c) - F.lit(float(centre[c]))) / F.lit(float(width[c]) or 1.0) for c in columns}
    )
