"""Hard negatives by rotated one-bit codes with stored alignments.

Vectors become integers (``floor(scale * x)``) and are rotated by one random orthogonal matrix. The first code of a vector is the
signs of its rotated components, the next one the signs of what is left when the components are halved towards zero, and so on.
The alignments of a vector with the unit vectors of its codes are stored: they are the coordinates of its projection on their
span, and the residual, whose length is stored, is orthogonal to all of them. One code alone is the plain one-bit code.

The inner product of two sign vectors is a popcount, so the product of the coded parts of two vectors is a sum of popcounts
times alignments. By Cauchy-Schwarz the rest is at most ``|coded anchor| |row residual| + |anchor residual| |row|``, always, not
just likely. This gives each anchor and row an interval that holds their integer inner product; only rows whose interval can
reach the answer are scored, with integers.

Anchors and rows are hashed into blocks; a task takes a block of each, and returns at most ``positives + 1`` rows per anchor,
then ``negatives`` rows per anchor and positive score. Rows of equal label and integers are one entry with its smallest
ids, so a hot group of copies is one row, and ties go to the smaller ids exactly.

Defined results: rows with a null id or label, a null or empty vector, a null or non-finite component, or another length than
most vectors take no part, as do rows whose squared integer length is 2^62 or more (their scores need not fit a long); zero
vectors take part; a row that repeats id, label and vector counts once; an anchor without another row of its label, or a positive
without a row in its range, gives no rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import store
from lodestar.llm.vectors import main_dimension

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
SCALE = 256
ANCHOR_CODES = 6
ROW_CODES = 5
ANCHOR_BLOCK = 8192
ROW_BLOCK = 4096
_CHUNK_PAIRS = 1 << 18
_ROUNDING = 1e-4  # far above what single precision loses, far below the intervals


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


class Coder:
    """One-bit codes of a dimension; the same for the same seed."""

    def __init__(self, dim: int, seed: int = 23):
        self.dim, self.words = dim, (dim + 63) // 64
        self.rotation = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))[0]

    def encode(self, x: np.ndarray, codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code words (code, word, row), coordinates (code, row), and the lengths of the coded part and of the residual."""
        turned = x.astype(np.float64) @ self.rotation
        rest, bits, signs = turned.copy(), [], []
        step = np.abs(turned).max(axis=1, initial=0.0) / 2  # halved from code to code, so that no component is left far off
        for _ in range(codes):
            positive = rest >= 0
            packed = np.zeros((len(x), self.words * 8), np.uint8)
            flat = np.packbits(positive, axis=1)
            packed[:, : flat.shape[1]] = flat
            bits.append(np.ascontiguousarray(packed.view(np.uint64).T))
            signs.append(np.where(positive, 1.0, -1.0) / math.sqrt(self.dim))
            rest -= signs[-1] * (math.sqrt(self.dim) * step)[:, None]
            step = step / 2
        units = np.stack(signs, axis=1)  # row, code, component
        along = np.einsum("nij,nj->ni", units, turned)
        fitted = np.einsum("nij,nj->ni", np.linalg.pinv(units @ units.transpose(0, 2, 1), hermitian=True), along)
        coded = np.einsum("ni,nij->nj", fitted, units)
        return np.stack(bits), fitted.T.copy(), _lengths(coded), _lengths(turned - coded)

    def intervals(self, anchors: tuple, rows: tuple, anchor_norms: np.ndarray, row_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (anchor, row) of the inner products.

        Two unit sign vectors that differ in ``p`` of ``d`` signs have the product ``1 - 2p/d``."""
        (a_bits, a_along, a_coded, a_rest), (r_bits, r_along, _, r_rest) = anchors, rows
        differing = np.zeros((len(a_rest), len(r_rest)), np.float32)
        for i, a_words in enumerate(a_bits):
            part = np.zeros_like(differing)
            for j, r_words in enumerate(r_bits):
                scale = r_along[j].astype(np.float32)
                for word in range(self.words):
                    part += np.bitwise_count(a_words[word][:, None] ^ r_words[word][None, :]) * scale
            part *= a_along[i].astype(np.float32)[:, None]
            differing += part
        middle = np.outer(a_along.sum(axis=0), r_along.sum(axis=0)) - differing * (2.0 / self.dim)
        half = np.outer(a_coded, r_rest) + np.outer(a_rest, row_norms) + _ROUNDING * (np.outer(anchor_norms, row_norms) + 1.0)
        return middle - half, middle + half


def _places(group: np.ndarray, groups: int) -> np.ndarray:
    """Position of each row in its group; ``group`` is ascending."""
    return np.arange(len(group)) - np.searchsorted(group, np.arange(groups))[group]


class _Block:
    """The anchors and rows of a task, in chunks of anchors with their intervals."""

    def __init__(self, table: pa.Table, dim: int, coder: Coder, anchor_codes: int, row_codes: int):
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        keys, ids, labels = (table.column(c).to_numpy() for c in ("key", "entry", "label"))
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        whole = flat.astype(np.int64).reshape(-1, dim)

        def places(own: np.ndarray) -> np.ndarray:
            at = np.flatnonzero(own)
            return at[np.argsort(ids[at], kind="stable")]

        asking, given = places(asks), places(~asks)
        self.anchor, self.anchor_keys, self.anchor_labels = whole[asking], keys[asking], labels[asking]
        self.row, self.row_keys, self.row_ids, self.row_labels = whole[given], keys[given], ids[given], labels[given]
        self.anchor_norms, self.row_norms = _lengths(self.anchor.astype(np.float64)), _lengths(self.row.astype(np.float64))
        self.coder, self.codes, self.coded = coder, anchor_codes, coder.encode(self.row, row_codes)
        self.ranges = table.column("scores").take(pa.array(asking)).to_pylist()

    def chunks(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        step = max(1, _CHUNK_PAIRS // max(1, len(self.row)))
        for start in range(0, len(self.anchor) if len(self.row) else 0, step):
            part = slice(start, start + step)
            coded = self.coder.encode(self.anchor[part], self.codes)
            low, high = self.coder.intervals(coded, self.coded, self.anchor_norms[part], self.row_norms)
            yield part, low, high, self.anchor_labels[part][:, None] == self.row_labels[None, :]

    def score(self, part: slice, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Integer products of the pairs, by anchor, then higher score, then smaller id."""
        own, scores = self.anchor[part], np.empty(len(i), np.int64)
        for at in range(0, len(i), 1 << 16):
            k = slice(at, at + (1 << 16))
            scores[k] = np.einsum("ij,ij->i", own[i[k]], self.row[j[k]])
        order = np.lexsort((self.row_ids[j], -scores, i))
        return i[order], j[order], scores[order]


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, -k]


def _concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def prepare(vectors: DataFrame, keep: int, scale: int = SCALE) -> tuple[DataFrame, DataFrame, int | None]:
    """The rows that take part, ``vec_id, label, vector`` (integers), their entries ``entry, ids, label, vector`` (the
    ``keep`` smallest ids), and the dimension."""
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~odd & (F.size("vector") > 0)
    rows = vectors.select("vec_id", "label", "vector").where(F.coalesce(good, F.lit(False)))
    dim = main_dimension(rows, "vector")
    floored = F.transform("vector", lambda x: F.floor(x.cast("double") * scale))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    same = rows.where(F.size("vector") == (dim or 0))
    whole = same.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), floored.alias("vector"))
    whole = store(whole.where(square < float(1 << 62)).distinct())
    first = Window.partitionBy("label", "vector").orderBy("vec_id")
    entries = (
        whole.withColumn("at", F.row_number().over(first))
        .where(F.col("at") <= keep)
        .groupBy("label", "vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("entry"), "ids", "label", "vector")
    )
    # ids need not be unique over labels and vectors, so an entry gets a key of its own
    key = F.xxhash64("entry", "label", "vector")
    return whole, store(entries.withColumn("key", key)), dim


def _paired(anchors: DataFrame, entries: DataFrame, anchor_block: int, row_block: int) -> DataFrame:
    """Every anchor beside every block of rows and every row beside every block of anchors."""
    n_a, n_r = max(1, math.ceil(anchors.count() / anchor_block)), max(1, math.ceil(entries.count() / row_block))

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("key", F.lit(7)), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    fixed = ["key", "entry", "label", "vector"]
    left = anchors.select(block(n_a).alias("a"), every(n_r).alias("r"), F.lit(True).alias("asks"), *fixed, "scores")
    right = entries.select(every(n_a).alias("a"), block(n_r).alias("r"), F.lit(False).alias("asks"), *fixed)
    return left.unionByName(right, allowMissingColumns=True)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    anchor_codes: int = ANCHOR_CODES,
    row_codes: int = ROW_CODES,
    anchor_block: int = ANCHOR_BLOCK,
    row_block: int = ROW_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of
    ``vectors(vec_id, label, vector)`` that satisfy ``anchors`` (a condition on the id): the best rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``."""
    spark = vectors.sparkSession
    whole, entries, dim = prepare(vectors, positives + 1, scale)
    if dim is None:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)
    coder = Coder(dim)
    asking = store(
        whole.where(anchors)
        .join(entries.select("key", "label", "vector"), ["label", "vector"])
        .select(F.col("vec_id").alias("anchor_id"), "key")
    )
    asked = entries.join(asking.select("key").distinct(), "key", "left_semi").select("key", "entry", "label", "vector")
    none = F.lit(None).cast("array<long>").alias("scores")

    def best_positives(table: pa.Table) -> pa.Table:
        block, k = _Block(table, dim, coder, anchor_codes, row_codes), positives + 1
        out_a, out_r, out_s = [], [], []
        for part, lower, upper, same in block.chunks():
            least = _largest(np.where(same, lower, -np.inf), k)
            i, j = np.nonzero(same & (upper >= least[:, None]))
            i, j, scores = block.score(part, i, j)
            first = _places(i, len(lower)) < k
            out_a.append(block.anchor_keys[part][i[first]])
            out_r.append(block.row_keys[j[first]])
            out_s.append(scores[first])
        return pa.table({"anchor": _concat(out_a, np.int64), "key": _concat(out_r, np.int64), "score": _concat(out_s, np.int64)})

    met = (
        _paired(asked.withColumn("scores", none), entries, anchor_block, row_block)
        .groupBy("a", "r")
        .applyInArrow(best_positives, "anchor long, key long, score long")
    )
    names = entries.select("key", "entry", "ids")
    by_id = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id")
    by_entry = Window.partitionBy("anchor").orderBy(F.desc("score"), "entry")
    near = store(
        met.join(names, "key")
        .withColumn("at", F.row_number().over(by_entry))
        .where(F.col("at") <= positives + 1)
        .select("anchor", "score", F.explode("ids").alias("vec_id"))
        .withColumn("at", F.row_number().over(by_id))
        .where(F.col("at") <= positives + 1)
        .groupBy("anchor")
        .agg(F.sort_array(F.collect_list(F.struct("at", "vec_id", "score"))).alias("near"))
    )

    def best_negatives(table: pa.Table) -> pa.Table:
        block = _Block(table, dim, coder, anchor_codes, row_codes)
        size = np.array([len(r) for r in block.ranges], np.int64)
        width = int(size.max(initial=0))
        wanted = [r + r[:1] * (width - len(r)) for r in block.ranges]
        # smallest and largest integer of each range
        floors = np.array([[-(-low * s // 100) for s in r] for r in wanted], np.int64).reshape(-1, width)
        tops = np.array([[high * s // 100 for s in r] for r in wanted], np.int64).reshape(-1, width)
        wanted = np.array(wanted, np.int64).reshape(-1, width)
        out: list[list[np.ndarray]] = [[], [], [], []]
        for part, lower, upper, same in block.chunks():
            floor, top = floors[part], tops[part]
            # rows that surely are in every range bound what the others must reach
            sure = ~same & (upper <= top.min(axis=1)[:, None]) & (lower >= floor.max(axis=1)[:, None])
            least = np.maximum(_largest(np.where(sure, lower, -np.inf), negatives), floor.min(axis=1))
            i, j = np.nonzero(~same & (upper >= least[:, None]) & (lower <= top.max(axis=1)[:, None]))
            i, j, scores = block.score(part, i, j)
            for w in range(width):
                kept = np.flatnonzero((scores >= floor[i, w]) & (scores <= top[i, w]) & (size[part][i] > w))
                kept = kept[_places(i[kept], len(lower)) < negatives]
                out[0].append(block.anchor_keys[part][i[kept]])
                out[1].append(wanted[part][i[kept], w])
                out[2].append(block.row_keys[j[kept]])
                out[3].append(scores[kept])
        names = ("anchor", "positive_score", "key", "score")
        return pa.table({n: _concat(c, np.int64) for n, c in zip(names, out)})

    ranges = near.select(F.col("anchor").alias("key"), F.array_distinct("near.score").alias("scores"))
    by_id = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "vec_id")
    by_entry = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "entry")
    hard = (
        _paired(asked.join(ranges, "key"), entries, anchor_block, row_block)
        .groupBy("a", "r")
        .applyInArrow(best_negatives, "anchor long, positive_score long, key long, score long")
        .join(names, "key")
        .withColumn("at", F.row_number().over(by_entry))
        .where(F.col("at") <= negatives)
        .select("anchor", "positive_score", "score", F.explode("ids").alias("vec_id"))
        .withColumn("rank", F.row_number().over(by_id))
        .where(F.col("rank") <= negatives)
        .groupBy("anchor", "positive_score")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("hard"))
        .groupBy("anchor")
        .agg(F.collect_list(F.struct("positive_score", "hard")).alias("ranges"))
    )
    own = F.slice(F.filter("near", lambda p: p["vec_id"] != F.col("anchor_id")), 1, positives)
    chosen = (
        asking.join(near.join(hard, "anchor").withColumnRenamed("anchor", "key"), "key")
        .select("anchor_id", "ranges", F.explode(own).alias("positive"))
        .select("anchor_id", "positive", F.explode("ranges").alias("range"))
        .where(F.col("range.positive_score") == F.col("positive.score"))
        .select("anchor_id", "positive", F.explode("range.hard").alias("negative"))
    )
    return chosen.select(
        "anchor_id",
        F.col("positive.vec_id").alias("positive_id"),
        F.col("negative.rank").alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("negative.score").alias("negative_score"),
    )
