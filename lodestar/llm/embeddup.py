"""Embedding near-duplicates: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors are one entry. Centres are fitted on a bounded sample (at most ``sample_rows`` entries, chosen by hash);
every entry goes to the cell of its nearest centre, and a cell of more than ``block_rows`` entries is split into
blocks by hash. A pair of blocks is one bounded matrix product in one task.

No link is lost at a cell border. For unit vectors with cosine at least ``t`` the distance is at most
``d = sqrt(2 - 2t)``. If ``y`` is nearer to centre ``c`` and ``x`` to centre ``a``, then ``x`` lies at most ``d``
beyond the plane halfway between ``a`` and ``c``; so ``x`` is compared with the blocks of just those cells ``c``
for which ``x.(a - c) <= d |a - c|``. Clustered vectors reach few cells; vectors without any structure reach
most, and then the work is that of all block pairs.

A task returns one row per linked entry (its number of links there and the smallest entry of its group there),
never the pairs. Components are then found over these rows.

Defined results: vectors that are null, empty, zero, hold null or non-finite components or have another length than
most vectors link with nothing and are their own component; a row with a null id has a null component and is
kept; rows that repeat an id belong together and count once; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import store
from lodestar.llm.vectors import is_valid, main_dimension, matrix
from lodestar.operators.graph import connected_components

THRESHOLD = 0.9
BLOCK_ROWS = 4096
SAMPLE_ROWS = 16_384
MOST_CELLS = 1024


def _unit(x: np.ndarray) -> np.ndarray:
    # scaled first, so that very large or small components neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Unit centres; an empty cell takes the vector that fits its own cell worst."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(rounds):
        fit = x @ centres.T
        home = fit.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        worst = np.argsort(fit.max(axis=1), kind="stable")
        lost = np.flatnonzero(np.bincount(home, minlength=k) == 0)
        sums[lost] = x[worst[: len(lost)]]
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    return centres


def _local_groups(rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes along the given links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[rows], label[cols])
        new = label.copy()
        np.minimum.at(new, rows, low)
        np.minimum.at(new, cols, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def linked_in_blocks(entries: DataFrame, dim: int, threshold: float, block_rows: int, sample_rows: int) -> DataFrame:
    """``entry, links, root`` rows of ``entries(entry, size, vector)``: per block pair and linked entry the number
    of linked vectors (copies counted) and the smallest entry of its group within the pair."""
    spark = entries.sparkSession
    total = entries.count()
    # a hash share that is expected to give the sample; the few rows beyond it are left out by the limit
    share = F.pmod(F.xxhash64("entry"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, sample_rows / max(total, 1)))
    picked = entries.where(share).select("entry", "vector").limit(sample_rows).collect()
    sample = _unit(np.array([r["vector"] for r in sorted(picked, key=lambda r: r["entry"])], dtype=np.float64).reshape(-1, dim))
    if not len(sample):
        sample = _unit(np.array([r["vector"] for r in entries.limit(1).collect()], dtype=np.float64))
    k = max(1, min(MOST_CELLS, math.ceil(total / block_rows), len(sample)))
    centres = spherical_kmeans(sample, k)
    gaps = centres[:, None, :] - centres[None, :, :]
    widths = np.sqrt((gaps * gaps).sum(axis=2)) * math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    kind = entries.schema["vector"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = _unit(matrix(batch.column("vector"), dim)) @ centres.T
            home = fit.argmax(axis=1)
            reach = (fit[np.arange(len(home)), home][:, None] - fit) <= widths[home]
            yield pa.RecordBatch.from_pydict(
                {
                    "entry": batch.column("entry"),
                    "size": batch.column("size"),
                    "vector": batch.column("vector"),
                    "cell": pa.array(home.astype(np.int32)),
                    "reached": pa.array([np.flatnonzero(r).astype(np.int32) for r in reach], pa.list_(pa.int32())),
                }
            )

    homes = store(
        entries.select("entry", "size", "vector").mapInArrow(
            assign, f"entry long, size long, vector {kind}, cell int, reached array<int>"
        )
    )
    counts = {r["cell"]: r["n"] for r in homes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = [max(1, math.ceil(counts.get(c, 0) / block_rows)) for c in range(k)]
    first = np.concatenate([[0], np.cumsum(blocks)])
    block_of = F.element_at(F.array(*[F.lit(int(b)) for b in first[:-1]]), F.col("cell") + 1) + F.pmod(
        F.xxhash64("entry"), F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1).cast("long")
    ).cast("int")
    ranges = F.array(*[F.sequence(F.lit(int(first[c])), F.lit(int(first[c + 1]) - 1)) for c in range(k)])
    met = (
        homes.select(
            "entry", "size", "vector", block_of.alias("own"),
            F.explode("reached").alias("cell"),
        )
        .withColumn("other", F.explode(F.element_at(ranges, F.col("cell") + 1)))
        .select(
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "entry", "size", "vector"
        )
    )

    def compare(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        own, ids, size = (table.column(c).to_numpy() for c in ("own", "entry", "size"))
        order = np.argsort(ids, kind="stable")
        own, ids, size = own[order], ids[order], size[order]
        x = _unit(matrix(table.column("vector"), dim)[order])
        left = np.flatnonzero(own == low)
        right = left if low == high else np.flatnonzero(own == high)
        links, ends = np.zeros(len(ids), np.int64), []
        for start in range(0, len(left), 512):
            part = left[start : start + 512]
            i, j = np.nonzero(x[part] @ x[right].T >= threshold)
            i, j = part[i], right[j]
            i, j = i[i != j], j[i != j]
            np.add.at(links, i, size[j])
            if low != high:
                np.add.at(links, j, size[i])
            if len(i):
                tied = _local_groups(i, j, len(ids))
                moved = np.flatnonzero(tied != np.arange(len(ids)))
                ends.append((moved, tied[moved]))
        if ends:
            root = _local_groups(np.concatenate([e[0] for e in ends]), np.concatenate([e[1] for e in ends]), len(ids))
        else:
            root = np.arange(len(ids))
        some = links > 0
        return pa.table({"entry": ids[some], "links": links[some], "root": ids[root[some]]})

    return met.groupBy("low", "high").applyInArrow(compare, "entry long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, vector)``."""
    rows = vectors.select("vec_id", "vector")
    valid = rows.where(F.col("vec_id").isNotNull() & is_valid(F.col("vector")))
    dim = main_dimension(valid, "vector")
    alone = rows.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if dim is None:
        return alone
    takes_part = F.col("vec_id").isNotNull() & is_valid(F.col("vector")) & (F.size("vector") == dim)
    valid = rows.where(takes_part)
    entries = store(
        valid.distinct()
        .groupBy("vector")
        .agg(F.min("vec_id").alias("entry"), F.count(F.lit(1)).alias("size"))
        .select("entry", "size", "vector")
    )
    found = store(linked_in_blocks(entries, dim, threshold, block_rows, sample_rows))
    edges = found.where(F.col("entry") != F.col("root")).select(F.col("entry").alias("src"), F.col("root").alias("dst"))
    links = found.groupBy("entry").agg(F.sum("links").alias("links"))
    components = connected_components(edges).withColumnRenamed("node", "entry")
    labelled = (
        entries.join(links, "entry", "left")
        .join(components, "entry", "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "entry").alias("component_id"),
        )
    )
    joined = valid.join(labelled, "vector").select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
    left_out = rows.where(~F.coalesce(takes_part, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return joined.unionByName(left_out)
