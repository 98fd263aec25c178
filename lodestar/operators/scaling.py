"""Building blocks that keep work spread over the cluster.

* ``materialise`` cuts lineage with a table written to the shared checkpoint folder.
* ``with_row_number`` and ``running_totals`` replace windows without a partition key, which Spark
  would run in one task, by a range-partitioned sort plus one offset per range.
* ``exact_percentiles`` finds percentiles from value counts instead of one aggregation buffer.
* ``block_product`` and ``block_top_k`` replace all-pairs joins: rows are hashed into blocks of
  bounded size on both sides, each pair of blocks is one numpy product, and no key (however hot)
  decides where a row goes.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_ROWS = 1024
BLOCK_ENTRIES = 1 << 21
PRODUCT_STEP = 1 << 21
MOST_TASKS = 4096
MOST_PANELS = 16
HOT_ROWS = 10_000
_LOCAL_BITS = 33


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only for local runs without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lodestar-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write the frame once and read it back: later stages start from files, not from lineage."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/lodestar-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Stored state of a loop. Two folders are written in turn, so a loop of any length keeps at most the
    state it reads and the state it writes; use it only for frames that depend on the round before."""

    def __init__(self, spark: SparkSession):
        base = f"{checkpoint_folder(spark)}/lodestar-{uuid.uuid4().hex}"
        self._spark = spark
        self._paths = (f"{base}-a", f"{base}-b")
        self._round = 0

    def store(self, df: DataFrame) -> DataFrame:
        path = self._paths[self._round % 2]
        self._round += 1
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def piece_offsets(parts: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Exclusive running sums over one row per range; the row count is the partition count."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_range", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_before_{a}") for a in amounts]
    )


def with_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Number rows 1..n in a total order, each range of the order sorted by its own task."""
    keys = _as_columns(order)
    ranged = (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id())
    )
    stored = (
        materialise(ranged)
        .withColumn("_range", F.shiftright("_id", _LOCAL_BITS))
        .withColumn("_local", F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    offsets = piece_offsets(stored.groupBy("_range").agg(F.count(F.lit(1)).alias("n")), ["n"])
    return (
        stored.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_local") + F.col("_before_n") + 1)
        .drop("_id", "_range", "_local", "_before_n")
    )


def row_at(df: DataFrame, order: Sequence[str], place: int, accuracy: int = 10_000) -> DataFrame:
    """The row at ``place`` (1..n) of a total order whose first column is a number; nulls come first.

    A quantile sketch gives a narrow range of that column; rows below it are counted and only those inside are sorted, a
    thousandth of the table unless many values are equal. A range that missed the place becomes the whole table. ``df`` is read
    three times, so it should be stored."""
    value = F.col(order[0]).cast("double")
    nulls, n = df.agg(F.count_if(value.isNull()), F.count(F.lit(1))).first()
    if place <= nulls:
        inside, below = value.isNull(), 0
    else:
        margin, at = 5 / accuracy, (place - nulls) / (n - nulls)
        low, high = df.agg(F.percentile_approx(value, [max(0.0, at - margin), min(1.0, at + margin)], accuracy).alias("q")).first()["q"]
        inside = (value >= F.lit(low)) & (value <= F.lit(high))
        under, within = df.agg(F.count_if(value < F.lit(low)), F.count_if(inside)).first()
        below = nulls + under
        if not below < place <= below + within:
            inside, below = F.lit(True), 0
    found = with_row_number(df.where(inside), list(order), "_at")
    return found.where(F.col("_at") == place - below).drop("_at")


def running_totals(df: DataFrame, order: Sequence[str | Column], amounts: Sequence[str]) -> DataFrame:
    """Add ``cum_<amount>`` (inclusive) over a total order of rows that are distinct on ``order``.

    The input is stored first: it is read for the range bounds and for the sums. Every range is summed by its
    own task, and one offset per range (an exclusive sum over the ranges before) is added.
    """
    keys = _as_columns(order)
    stored = materialise(materialise(df).repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    parts = stored.groupBy("_range").agg(*[F.sum(a).alias(a) for a in amounts])
    offsets = piece_offsets(parts, amounts)
    within = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    local = stored.select("*", *[F.sum(a).over(within).alias(f"_cum_{a}") for a in amounts])
    return local.join(F.broadcast(offsets), "_range").select(
        *df.columns, *[(F.col(f"_cum_{a}") + F.col(f"_before_{a}")).alias(f"cum_{a}") for a in amounts]
    )


def hot_keys(rows: DataFrame, on: Sequence[str], limit: int = HOT_ROWS) -> DataFrame:
    """``on, _salts``: the keys of more than ``limit`` rows and into how many parts of about ``limit`` rows they are cut.

    Stored; it has fewer rows than the table has times ``limit``."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    return materialise(counts.select(*on, F.ceil(F.col("_n") / limit).cast("int").alias("_salts")))


def salted_lookup(rows: DataFrame, lookup: DataFrame, on: Sequence[str], hot: DataFrame | None = None) -> DataFrame:
    """Inner join with a table of one row per key, for use before an aggregate on the same key.

    There Spark keeps the join's partitions for the aggregate and cannot split a hot key. The rows of a hot key are spread
    by a hash of the row, and only its lookup row is repeated, once per part: the lookup grows by less than two rows per
    ``HOT_ROWS`` rows, whatever the number of its keys. ``hot`` are the ``hot_keys`` of the rows or of a table that holds them, where known.
    """
    hot = hot_keys(rows, on) if hot is None else hot
    if hot.isEmpty():
        return rows.join(lookup, list(on))
    hot, salts = F.broadcast(hot), F.coalesce("_salts", F.lit(1))
    part = F.pmod(F.xxhash64(*rows.columns), salts).cast("int")
    salted = rows.join(hot, list(on), "left").select(*rows.columns, part.alias("_salt"))
    copies = F.explode(F.sequence(F.lit(0), salts - 1))
    repeated = lookup.join(hot, list(on), "left").select(*lookup.columns, copies.alias("_salt"))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")


def exact_percentiles(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Interpolated percentiles (columns ``p0..``) plus ``n``, one row per group.

    Equal values are counted before any shuffle, so a value that fills a third of the table is one
    row; positions come from running counts over (group, value).
    """
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    running = running_totals(counts, [*by, "_value"], ["n"]).withColumn("_start", F.col("cum_n") - F.col("n"))
    marks = [F.col("_total") * 0 + p * (F.col("_total") - 1) for p in probabilities]
    if by:
        totals = running.groupBy(*by).agg(F.sum("n").alias("_total"), F.min("_start").alias("_base"))
        placed = salted_lookup(running, totals, by)
    else:
        total = running.agg(F.sum("n")).first()[0] or 0
        placed = running.select("*", F.lit(total).cast("long").alias("_total"), F.lit(0).cast("long").alias("_base"))
    placed = placed.withColumn("_from", F.col("_start") - F.col("_base")).withColumn(
        "_to", F.col("cum_n") - F.col("_base")
    )

    def value_at(index: Column) -> Column:
        return F.max(F.when((F.col("_from") <= index) & (index < F.col("_to")), F.col("_value")))

    picked = placed.groupBy(*by).agg(
        F.max("_total").alias("n"),
        *[value_at(F.floor(m)).alias(f"_lo{i}") for i, m in enumerate(marks)],
        *[value_at(F.ceil(m)).alias(f"_hi{i}") for i, m in enumerate(marks)],
    )

    def between(i: int, p: float) -> Column:
        mark = p * (F.col("n") - 1)
        return (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (mark - F.floor(mark))).alias(f"p{i}")

    return picked.select(*by, "n", *[between(i, p) for i, p in enumerate(probabilities)])


def column_percentiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Interpolated percentiles of several columns, exact: ``column, n, p0..``; a column without values has no row.

    Quantile sketches give a narrow range of values around each percentile. One pass counts the rows below and inside the
    ranges; only values inside, a thousandth of the rows, are counted value by value and shuffled. A range that missed its
    percentile, as on small tables, becomes the whole column.
    """
    margin = 5 / accuracy
    value = [F.col(c).cast("double") for c in columns]
    cells = [(i, p) for i in range(len(columns)) for p in probabilities]
    ends = [f(p) for p in probabilities for f in (lambda p: max(0.0, p - margin), lambda p: min(1.0, p + margin))]
    first = df.agg(
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(value)],
        *[F.percentile_approx(v, ends, accuracy).alias(f"q{i}") for i, v in enumerate(value)],
    ).first()

    def inside(c: int, low: float, high: float) -> Column:
        return (value[cells[c][0]] >= F.lit(low)) & (value[cells[c][0]] <= F.lit(high))

    ranges = []
    for c, (i, p) in enumerate(cells):
        marks, at = first[f"q{i}"], 2 * (c % len(probabilities))
        low, high = (-math.inf, math.inf) if marks is None else (marks[at], marks[at + 1])
        ranges.append((low if p > margin else -math.inf, high if p < 1 - margin else math.inf))
    counts = df.agg(
        *[F.count_if(value[i] < F.lit(ranges[c][0])).alias(f"b{c}") for c, (i, _) in enumerate(cells)],
        *[F.count_if(inside(c, *ranges[c])).alias(f"i{c}") for c in range(len(cells))],
    ).first()
    below, within = [], []
    for c, (i, p) in enumerate(cells):
        mark, n = p * (first[f"n{i}"] - 1), first[f"n{i}"]
        if n and not (counts[f"b{c}"] <= math.floor(mark) and math.ceil(mark) < counts[f"b{c}"] + counts[f"i{c}"]):
            ranges[c] = (-math.inf, math.inf)
            below.append(0)
            within.append(n)
        else:
            below.append(counts[f"b{c}"])
            within.append(counts[f"i{c}"])
    hits = F.array(*[F.when(inside(c, *ranges[c]), F.struct(F.lit(c).alias("cell"), value[i].alias("v"))) for c, (i, _) in enumerate(cells)])
    rows = df.select(F.explode(F.array_compact(hits)).alias("h")).select("h.*").groupBy("cell", "v").agg(F.count(F.lit(1)).alias("n"))
    running = running_totals(rows, ["cell", "v"], ["n"])
    # rank of a value in its column: its place in the running count, less the cells before, plus the rows below the range
    shift = [below[c] - sum(within[:c]) for c in range(len(cells))]
    offset = F.element_at(F.array(*[F.lit(x).cast("long") for x in shift]), F.col("cell") + 1)
    place = running.select("cell", "v", (F.col("cum_n") - F.col("n") + offset).alias("a"), (F.col("cum_n") + offset).alias("b"))
    marks = [p * (first[f"n{i}"] - 1) for i, p in cells]
    wanted = lambda f: F.element_at(F.array(*[F.lit(int(f(m))) for m in marks]), F.col("cell") + 1)
    hit = lambda k: F.max(F.when((F.col("a") <= k) & (k < F.col("b")), F.col("v")))
    found = {r["cell"]: (r["lo"], r["hi"]) for r in place.groupBy("cell").agg(hit(wanted(math.floor)).alias("lo"), hit(wanted(math.ceil)).alias("hi")).collect()}
    out = []
    for i, name in enumerate(columns):
        if first[f"n{i}"]:
            own = [(*found[c], marks[c] - math.floor(marks[c])) for c in range(len(cells)) if cells[c][0] == i]
            out.append((name, first[f"n{i}"], *[float(lo + (hi - lo) * part) for lo, hi, part in own]))
    schema = "column string, n long" + "".join(f", p{j} double" for j in range(len(probabilities)))
    return df.sparkSession.createDataFrame(out, schema)


def exact_median(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return exact_percentiles(df, value, [0.5], by).withColumnRenamed("p0", "median")


def top_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each key. Spark limits every map partition to k rows per key before the
    shuffle (WindowGroupLimit), so a hot key sends k rows per task and not all its rows."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def _block(column: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(blocks)).cast("int")


def _all_blocks(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _product_blocks(left: DataFrame, right: DataFrame, entries: int, masked: bool) -> tuple[int, int, int]:
    """Blocks of rows, inner keys and columns: about ``entries`` entries a side, and in each pair of blocks at most about four times as
    many products or cells. Inner keys are cut only where one hot row or column fills a block."""
    n = [f.count() for f in (left, right)]
    at = [max(1, math.ceil(m / entries), min(8, math.ceil(m / max(1, entries // 64)))) for m in n]
    if not masked:
        per_k = [f.groupBy("k").agg(F.count(F.lit(1)).cast("double").alias(name)) for f, name in ((left, "_n"), (right, "_m"))]
        products = per_k[0].join(per_k[1], "k").agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0.0
        dense = math.prod(f.agg(F.approx_count_distinct(c)).first()[0] or 1 for f, c in ((left, "row"), (right, "col")))
        grow = math.sqrt(max(1.0, min(products, dense) / (4 * entries * at[0] * at[1])))
        at = [math.ceil(b * grow) for b in at]
    sides = ((left, "row", at[0]), (right, "col", at[1]))
    full = [f.groupBy(_block(c, b).alias("_b")).count().agg(F.max("count")).first()[0] or 0 for f, c, b in sides]
    return at[0], max(1, math.ceil(max(full) / (4 * entries))), at[1]


def sparse_cells(i, p, v, starts, j, w, cols: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Summed cells ``row, column, value`` of a product, for ranges of rows with about ``step`` single products each.

    ``i, p, v`` are the left entries by row; ``j, w`` the right ones by inner key, those of key ``p`` from ``starts[p]`` on."""
    each = np.diff(starts)[p]
    done = np.concatenate([[0], np.cumsum(each)])
    firsts = np.append(np.flatnonzero(np.diff(i, prepend=-1)), len(i))  # first entry of each row
    at = 0
    while at < len(firsts) - 1:
        upto = max(at + 1, int(np.searchsorted(done[firsts], done[firsts[at]] + step, "right")) - 1)
        low, high, at = firsts[at], firsts[upto], upto
        n = each[low:high]
        if not n.sum():
            continue
        mine = np.repeat(np.arange(low, high), n)
        theirs = np.arange(len(mine)) - np.repeat(np.cumsum(n) - n, n) + starts[p[mine]]
        code, value = i[mine] * cols + j[theirs], v[mine] * w[theirs]
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))
        yield code[first] // cols, code[first] % cols, np.add.reduceat(value[order], first)


def dense_cells(i, p, v, starts, j, w, rows: int, cols: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same cells from dense panels of ``size`` rows, inner keys and columns."""
    q = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for r in range(0, rows, size):
        a = slice(*np.searchsorted(i, [r, r + size]))
        left = {k: np.flatnonzero(p[a] // size == k) + a.start for k in np.unique(p[a] // size)}
        for c in range(0, cols, size):
            z = np.zeros((min(size, rows - r), min(size, cols - c)))
            for k, mine in left.items():
                b = slice(*np.searchsorted(q, [k * size, (k + 1) * size]))
                theirs = np.flatnonzero((j[b] >= c) & (j[b] < c + size)) + b.start
                x, y = np.zeros((len(z), size)), np.zeros((size, z.shape[1]))
                x[i[mine] - r, p[mine] - k * size] = v[mine]
                y[q[theirs] - k * size, j[theirs] - c] = w[theirs]
                z += x @ y
            found = np.nonzero(z)
            yield found[0] + r, found[1] + c, z[found]


def block_product(
    left: DataFrame, right: DataFrame, mask: DataFrame | None = None, size: int = BLOCK_ROWS, entries: int = BLOCK_ENTRIES
) -> DataFrame:
    """Sparse matrix product of ``left(row, k, value)`` and ``right(k, col, value)`` as
    ``(row, col, value)`` without zero entries; with ``mask(row, col)`` only those cells.

    Entries must be unique per cell. A task multiplies a block of rows by a block of columns over all inner keys, each of about
    ``entries`` entries, and returns summed cells: single products are never shuffled, and a key, however hot, is spread by the hash
    of its rows and columns. Blocks that are nearly full are multiplied in dense panels of ``size``. Only where a hot row or
    column makes a block too large are inner keys cut as well, and the parts added up.
    """
    row_type, col_type = left.schema["row"].dataType, right.schema["col"].dataType
    masked = mask is not None
    n_row, n_k, n_col = _product_blocks(left, right, entries, masked)
    lhs = left.select(
        _block("row", n_row).alias("_r"), _block("k", n_k).alias("_k"), _all_blocks(n_col).alias("_c"),
        "row", "k", F.col("value").cast("double").alias("value"),
    )
    if masked:
        lhs = lhs.select("*", F.lit(None).cast(col_type).alias("col"), F.lit(False).alias("asked")).unionByName(
            mask.distinct().select(
                _block("row", n_row).alias("_r"), _all_blocks(n_k).alias("_k"), _block("col", n_col).alias("_c"),
                "row", F.lit(None).cast(left.schema["k"].dataType).alias("k"),
                F.lit(None).cast("double").alias("value"), "col", F.lit(True).alias("asked"),
            )
        )
    rhs = right.select(
        _all_blocks(n_row).alias("_r"), _block("k", n_k).alias("_k"), _block("col", n_col).alias("_c"),
        "k", "col", F.col("value").cast("double").alias("value"),
    )
    schema = T.StructType(
        [T.StructField("row", row_type), T.StructField("col", col_type), T.StructField("value", T.DoubleType())]
    )

    def multiply(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"row": [], "col": [], "value": []})
        if masked:
            wanted, a = a[a["asked"]], a[~a["asked"]]
            a, b = a[a["row"].isin(wanted["row"])], b[b["col"].isin(wanted["col"])]
        if a.empty or b.empty:
            return none
        inner = pd.Index(pd.unique(pd.concat([a["k"], b["k"]])))
        rows, cols = pd.Index(pd.unique(a["row"])), pd.Index(pd.unique(b["col"]))
        i, p, v = rows.get_indexer(a["row"]), inner.get_indexer(a["k"]), a["value"].to_numpy()
        j, q, w = cols.get_indexer(b["col"]), inner.get_indexer(b["k"]), b["value"].to_numpy()
        order = np.argsort(i, kind="stable")
        i, p, v = i[order], p[order], v[order]
        order = np.argsort(q, kind="stable")
        j, q, w = j[order], q[order], w[order]
        starts = np.searchsorted(q, np.arange(len(inner) + 1))
        full = 32 * int(np.diff(starts)[p].sum()) > len(rows) * len(inner) * len(cols)
        if full:
            parts = dense_cells(i, p, v, starts, j, w, len(rows), len(cols), size)
        else:
            parts = sparse_cells(i, p, v, starts, j, w, len(cols), PRODUCT_STEP)
        asked = None
        if masked:
            r, c = rows.get_indexer(wanted["row"]), cols.get_indexer(wanted["col"])
            asked = np.sort((r * len(cols) + c)[(r >= 0) & (c >= 0)])
        out = []
        for r, c, value in parts:
            keep = value != 0
            if masked:
                code = r * len(cols) + c
                spot = np.minimum(np.searchsorted(asked, code), len(asked) - 1)
                keep &= (asked[spot] == code) if len(asked) else False
            out.append((r[keep], c[keep], value[keep]))
        if not out:
            return none
        r, c, value = (np.concatenate(part) for part in zip(*out, strict=True))
        return pd.DataFrame({"row": rows[r], "col": cols[c], "value": value})

    cell, tasks = ["_r", "_k", "_c"], min(n_row * n_k * n_col, MOST_TASKS)
    parts = lhs.repartition(tasks, *cell).groupBy(*cell).cogroup(rhs.repartition(tasks, *cell).groupBy(*cell)).applyInPandas(multiply, schema)
    return parts if n_k == 1 else parts.groupBy("row", "col").agg(F.sum("value").alias("value"))


def first_in_rows(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places ``row, column`` of the k smallest cells of each row, in order; of equal cells the first, not-a-number last."""
    k = min(k, x.shape[1])
    least = np.partition(x, k - 1, axis=1)[:, k - 1 : k]
    rows, cols = np.nonzero(~(x > least))  # at least k cells of a row, more only where cells are equal
    order = np.lexsort((cols, x[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    firsts = np.searchsorted(rows, np.arange(len(x)))
    some = np.arange(len(rows)) - firsts[rows] < k
    return rows[some], cols[some]


def block_top_k(
    queries: DataFrame,
    base: DataFrame,
    score: Callable[[np.ndarray, np.ndarray], np.ndarray],
    k: int,
    size: int = 4 * BLOCK_ROWS,
    digits: int = 9,
) -> DataFrame:
    """Exact k best ``base(id, vector)`` rows for every ``queries(id, vector)`` row, larger score first
    and smaller base id on ties: ``(query_id, base_id, score, rank)``.

    Every block pair keeps k rows per query row, so at most k times the number of base blocks are
    merged per query. Scores are rounded to ``digits`` so that ties do not hang on float noise.

    ``size`` base rows are compared at once. A row is sent once per block of the other side, so where both sides have many times
    ``size`` rows, a block has up to ``MOST_PANELS`` times as many and its task compares panel by panel.
    """
    q = queries.select(F.col("id").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
    b = base.select(F.col("id").alias("base_id"), F.col("vector").cast("array<double>").alias("vector"))
    counts = q.count(), b.count()
    panels = min(MOST_PANELS, max(1, min(counts) // (4 * size)))
    n_q, n_b = (max(1, math.ceil(n / (panels * size))) for n in counts)
    lhs = q.select(_block("query_id", n_q).alias("_q"), _all_blocks(n_b).alias("_b"), "query_id", "vector")
    rhs = b.select(_all_blocks(n_q).alias("_q"), _block("base_id", n_b).alias("_b"), "base_id", "vector")
    schema = T.StructType(
        [
            T.StructField("query_id", q.schema["query_id"].dataType),
            T.StructField("base_id", b.schema["base_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "base_id": [], "score": []})
        right = right.sort_values("base_id")
        ids = right["base_id"].to_numpy()
        train = np.stack(right["vector"].to_numpy()).astype(float)
        out = []
        for start in range(0, len(left), 256):
            piece = left.iloc[start : start + 256]
            vectors, parts = np.stack(piece["vector"].to_numpy()).astype(float), []
            for at in range(0, len(train), size * 2):
                scores = np.round(score(vectors, train[at : at + size * 2]), digits)
                rows, cols = first_in_rows(-scores, k)
                parts.append((rows, cols + at, scores[rows, cols]))
            rows, cols, best_scores = (np.concatenate(part) for part in zip(*parts, strict=True))
            if len(parts) > 1:
                order = np.lexsort((cols, -best_scores, rows))
                rows, cols, best_scores = rows[order], cols[order], best_scores[order]
                some = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                rows, cols, best_scores = rows[some], cols[some], best_scores[some]
            out.append(pd.DataFrame({"query_id": piece["query_id"].to_numpy()[rows], "base_id": ids[cols], "score": best_scores}))
        return pd.concat(out)

    found = lhs.groupBy("_q", "_b").cogroup(rhs.groupBy("_q", "_b")).applyInPandas(best, schema)
    return top_k_per_key(found, ["query_id"], [F.desc("score"), F.asc("base_id")], k)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
