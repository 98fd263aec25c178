"""Text features over tables: stems, vocabularies, TF-IDF, graph-of-words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import IDF, HashingTF, NGram, StopWordsRemover, Tokenizer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.columns import hash_fraction, stored_components
from lodestar.functions.text import unnest
from lodestar.operators.scaling import materialise, top_k_per_key, with_row_number

# The suffix rules of the published Porter stemmer (suffix, replacement), longest first.
STEP2 = (
    ("ational", "ate"), ("ization", "ize"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("tional", "tion"), ("biliti", "ble"), ("entli", "ent"), ("ousli", "ous"), ("ation", "ate"), ("alism", "al"),
    ("aliti", "al"), ("iviti", "ive"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
    ("alli", "al"), ("ator", "ate"), ("eli", "e"),
)
STEP3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = (
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion",
    "al", "er", "ic", "ou",
)


STEM_CACHE = 500_000
TOKEN_ROWS = 1_000
OFTEN = 1_000


def _shape(stem: str) -> str:
    """The word as a string of v and c, runs collapsed: its measure is the number of vc pairs."""
    out = ""
    previous = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and previous == "c")
        previous = "v" if vowel else "c"
        out += previous
    return out


def _measure(stem: str) -> int:
    kinds = _shape(stem)
    return sum(1 for a, b in zip(kinds, kinds[1:]) if a == "v" and b == "c")


def _short_end(stem: str) -> bool:
    return len(stem) >= 3 and _shape(stem)[-3:] == "cvc" and stem[-1] not in "wxy"


def _replace(word: str, rules: Sequence[tuple[str, str]]) -> str:
    for suffix, new in rules:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def porter_stem(word: str) -> str:
    """Stem of one lower-case English word."""
    if len(word) <= 2:
        return word
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            word = word[: -len(suffix)] + new
            break
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix) and "v" in _shape(word[: -len(suffix)]):
                word = word[: -len(suffix)]
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                    word = word[:-1]
                elif _measure(word) == 1 and _short_end(word):
                    word += "e"
                break
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    word = _replace(_replace(word, STEP2), STEP3)
    for suffix in STEP4:
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stem_arrays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known: dict[str | None, str | None] = {None: None}

    def lookup(word: str | None) -> str | None:
        if word not in known:
            if len(known) >= STEM_CACHE:
                known.clear()
                known[None] = None
            known[word] = porter_stem(word)
        return known[word]

    for batch in batches:
        # the different words of the batch are stemmed, its tokens only point at them
        coded = batch.flatten().dictionary_encode()
        stems = pa.array([lookup(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
        sizes = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        yield pa.ListArray.from_arrays(ends, stems, mask=batch.is_null())


def stem(tokens: str | Column) -> Column:
    """Stems of a token array. Python sees each different word of a batch once; no shuffle is needed."""
    return _stem_arrays(F.col(tokens) if isinstance(tokens, str) else tokens)


class Stemmer(Transformer, HasInputCol, HasOutputCol):
    """Pipeline stage that replaces the tokens of an array by their stems."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), stem(self.getInputCol()))


def vector_norm(features: str) -> Column:
    """Length of a vector, from its stored components only."""
    return F.sqrt(F.aggregate(stored_components(features)["x"], F.lit(0.0), lambda s, v: s + v * v))


def positions(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """``doc, pos, word`` rows of a token array."""
    return unnest(df, tokens, "word", [F.col(doc).alias("doc")], pos="pos")


def _grouped(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and distinct words of a batch of token arrays ``_t``: row, dictionary, word code, first place of each pair among the
    positions, and the positions, in order of row, code and position."""
    tokens = batch.column("_t")
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = tokens.flatten().dictionary_encode(null_encoding="encode")
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    order = np.lexsort((codes, row))  # stable: positions stay in order
    row, codes, pos = row[order], codes[order], pos[order]
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(codes, prepend=-1) != 0))
    return row[first], flat.dictionary, codes[first], first, pos


def _with_tokens(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    return df.select(F.col(doc).alias("doc"), tokens.cast("array<string>").alias("_t"))


def word_spots(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """``doc, size, word, at`` per row of the table and distinct word: the number of the row's tokens and the word's positions. A row's
    words are gathered where the row is, without a shuffle."""
    rows = _with_tokens(df, doc, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, TOKEN_ROWS):
                batch = whole.slice(start, TOKEN_ROWS)
                row, words, codes, first, pos = _grouped(batch)
                size = pc.list_value_length(batch.column("_t")).take(pa.array(row))
                at = pa.ListArray.from_arrays(pa.array(np.append(first, len(pos)), pa.int32()), pa.array(pos, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(pa.array(row)), size.cast(pa.int32()), words.take(pa.array(codes)), at], names=["doc", "size", "word", "at"]
                )

    kind = rows.schema["doc"].dataType
    schema = T.StructType(
        [T.StructField("doc", kind), T.StructField("size", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("at", T.ArrayType(T.IntegerType()))]
    )
    return rows.mapInArrow(run, schema)


def _sized_counts(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """``doc, word, n, size`` per document and word; only documents of several rows need a shuffle to come together."""
    spots = word_spots(df, doc, tokens).where(F.col("word").isNotNull())
    counts = spots.select("doc", "word", F.size("at").cast("long").alias("n"), "size")
    if df.groupBy(doc).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        return counts
    return counts.groupBy("doc", "word").agg(F.sum("n").alias("n"), F.first("size").alias("size"))


def doc_term(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """Count per (document, word)."""
    return _sized_counts(df, doc, tokens).select("doc", "word", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def vocabulary(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """Words with an index 0.. by first appearance over (document, position)."""
    rows = _with_tokens(df, doc, tokens)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first place of every word among some rows."""
        for whole in batches:
            for start in range(0, whole.num_rows, TOKEN_ROWS):
                batch = whole.slice(start, TOKEN_ROWS)
                row, words, codes, first, pos = _grouped(batch)
                rank = pc.rank(batch.column("doc"), sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()
                pos = pos[first]
                order = np.lexsort((pos, rank[row], codes))
                best = order[np.flatnonzero(np.diff(codes[order], prepend=-1))]
                yield pa.RecordBatch.from_arrays(
                    [words.take(pa.array(codes[best])), batch.column("doc").take(pa.array(row[best])), pa.array(pos[best], pa.int32())], names=["word", "doc", "pos"]
                )

    kind = rows.schema["doc"].dataType
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("doc", kind), T.StructField("pos", T.IntegerType())])
    first = rows.mapInArrow(run, schema).groupBy("word").agg(F.min(F.struct("doc", "pos")).alias("_first"))
    numbered = with_row_number(first.select("word", "_first.doc", "_first.pos"), ["doc", "pos"], "_n")
    return numbered.select("word", (F.col("_n") - 1).alias("index"))


def to_sequences(df: DataFrame, doc: str, tokens: str | Column, vocab: DataFrame, max_len: int | None = None) -> DataFrame:
    """Word ids per document (1-based, words outside the vocabulary left out), padded with 0.

    A row's positions are gathered per word before the join, so a frequent word joins once per document, and are put in order
    after it for a batch of documents at once.
    """
    found = word_spots(df, doc, tokens).join(vocab, "word").select("doc", F.struct("at", (F.col("index") + 1).cast("long").alias("id")).alias("s"))
    whole = found.groupBy("doc").agg(F.collect_list("s").alias("s"))

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("s")
            n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
            at, ids = words.flatten().flatten()
            times = pc.list_value_length(at).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.repeat(np.arange(len(n_words)), n_words), times)
            ids = np.repeat(ids.to_numpy(zero_copy_only=False), times)
            order = np.lexsort((ids, at.flatten().to_numpy(zero_copy_only=False), row))
            ends = np.searchsorted(row, np.arange(len(n_words) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids[order], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), lists], names=["doc", "ids"])

    kind = whole.schema["doc"].dataType
    schema = T.StructType([T.StructField("doc", kind), T.StructField("ids", T.ArrayType(T.LongType()))])
    rows = whole.mapInArrow(in_order, schema)
    rows = df.select(F.col(doc).alias("doc")).join(rows, "doc", "left").select(
        "doc", F.coalesce("ids", F.array().cast("array<bigint>")).alias("ids")
    )
    longest = max_len
    if max_len is None:
        rows = materialise(rows)
        longest = rows.agg(F.max(F.size("ids"))).first()[0] or 0
    padding = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(longest) - F.size("ids"), F.lit(0)))
    padded = F.concat("ids", padding)
    return rows.select("doc", (padded if max_len is None else F.slice(padded, 1, max(max_len, 1))).alias("ids"))


def tfidf(df: DataFrame, doc: str, tokens: str | Column) -> DataFrame:
    """Share of the document's tokens times ln(documents / documents with the word) + 1.

    Words in at least one of ``OFTEN`` documents are no more than ``OFTEN`` times the mean number of words of a document, however many
    documents there are: their frequencies are sent to the counts. Only the counts of other words are shuffled to theirs."""
    # stored, because it is read for the document frequencies and again for the weights
    counts = materialise(_sized_counts(df, doc, tokens))
    n_docs = df.count()
    spread = materialise(counts.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    often = F.broadcast(spread.where(F.col("df") * OFTEN >= n_docs))
    rare = counts.join(often, "word", "left_anti").join(spread.where(F.col("df") * OFTEN < n_docs), "word")
    weight = F.col("n") / F.col("size") * (F.log(F.lit(float(n_docs)) / F.col("df")) + 1)
    return counts.join(often, "word").unionByName(rare).select("doc", "word", weight.alias("tfidf"))


def tfidf_top(df: DataFrame, doc: str, tokens: str | Column, k: int = 4, digits: int = 12) -> DataFrame:
    """The k heaviest words of each document, ties by word."""
    weights = tfidf(df, doc, tokens).withColumn("tfidf", F.round("tfidf", digits))
    return top_k_per_key(weights, ["doc"], [F.desc("tfidf"), F.asc("word")], k)


def tfidf_stages(
    text: str, out: str, num_features: int = 1 << 18, stopwords: Sequence[str] | None = None, ngram: int | None = None,
    stems: bool = False,
) -> Pipeline:
    """Tokens, optionally without stop words, as stems, as n-grams, then hashed counts and IDF as one pipeline."""
    stages = [Tokenizer(inputCol=text, outputCol="_words")]
    last = "_words"
    if stopwords is not None:
        stages.append(StopWordsRemover(inputCol=last, outputCol="_kept", stopWords=list(stopwords)))
        last = "_kept"
    if stems:
        stages.append(Stemmer(inputCol=last, outputCol="_stems"))
        last = "_stems"
    if ngram:
        stages.append(NGram(n=ngram, inputCol=last, outputCol="_grams"))
        last = "_grams"
    stages.append(HashingTF(inputCol=last, outputCol="_tf", numFeatures=num_features))
    stages.append(IDF(inputCol="_tf", outputCol=out))
    return Pipeline(stages=stages)


def tfidf_hashed(
    train: DataFrame, test: DataFrame, text: str, num_features: int = 1 << 18, out: str = "features"
) -> tuple[DataFrame, DataFrame]:
    """Fit on the training rows, apply to both."""
    model = tfidf_stages(text, out, num_features).fit(train)
    drop = ["_words", "_tf"]
    return model.transform(train).drop(*drop), model.transform(test).drop(*drop)


def matrix_density(coords: DataFrame, row: str, col: str, value: str | None = None) -> DataFrame:
    """Non-zero cells, rows, columns and the filled share in %; cells must be unique."""
    coords = materialise(coords)
    cells = coords.where(F.col(value) != 0) if value else coords
    # one distinct count per side keeps the aggregates mergeable without a set per task
    rows = coords.select(row).distinct().agg(F.count(F.lit(1)).alias("rows"))
    cols = coords.select(col).distinct().agg(F.count(F.lit(1)).alias("cols"))
    counts = {"cells": cells.count(), "rows": rows.first()[0], "cols": cols.first()[0]}
    size = counts["rows"] * counts["cols"]
    one = coords.sparkSession.range(1)
    return one.select(
        *[F.lit(v).cast("long").alias(k) for k, v in counts.items()],
        F.lit(100.0 * counts["cells"] / size if size else None).cast("double").alias("filled_pct"),
    )


def graph_of_words(df: DataFrame, doc: str, tokens: str | Column, window: int = 3) -> DataFrame:
    """Distinct edges ``doc, src, dst`` between different tokens less than ``window`` places apart.

    A document is one row, so its pairs are formed and made distinct inside the row: no self-join and
    no shuffle. Pairs are kept as text while they are compared, which Spark does by hashing.
    """
    mark = "\u0001"

    def pairs(t: Column) -> Column:
        shifted = [
            F.zip_with(
                F.slice(t, 1, F.greatest(F.size(t) - step, F.lit(0))),
                F.slice(t, step + 1, F.greatest(F.size(t) - step, F.lit(0))),
                lambda a, b: F.when(a != b, F.concat(a, F.lit(mark), b)),
            )
            for step in range(1, window)
        ]
        return F.array_distinct(F.array_compact(F.concat(*shifted)))

    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    rows = df.select(F.col(doc).alias("doc"), F.transform(F.array(tokens), pairs)[0].alias("_p"))
    edges = unnest(rows, "_p", "_p", ["doc"])
    return edges.select(
        "doc", F.substring_index("_p", mark, 1).alias("src"), F.substring_index("_p", mark, -1).alias("dst")
    )


def graph_of_words_size(edges: DataFrame) -> DataFrame:
    """Nodes and edges per document, from one pass over the edge ends."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("edge")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("edge"))
    )
    nodes = edges.select("doc", F.explode(ends).alias("e")).groupBy("doc", "e.node").agg(F.sum("e.edge").alias("edges"))
    return nodes.groupBy("doc").agg(F.count(F.lit(1)).alias("nodes"), F.sum("edges").alias("edges"))


_TRIANGLE_PAIRS = 1 << 20  # pairs of neighbours that are compared at once


def _cycles(src: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
    """Cycles of three among distinct edges between ``n`` numbered vertices, one row per start.

    Pairs of neighbours are taken only at the end with the smallest degree of a triangle: undirected
    edges point to the larger degree, so a word linked to all others starts almost no pair.
    """
    directed = np.unique(src * n + dst)
    und = np.unique(np.minimum(src, dst) * n + np.maximum(src, dst))
    a, b = und // n, und % n
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n)
    low = (degree[a] < degree[b]) | ((degree[a] == degree[b]) & (a < b))
    up = np.sort(np.where(low, a, b) * n + np.where(low, b, a))
    u, v = up // n, up % n
    ends = np.searchsorted(u, np.arange(n), side="right")
    later = ends[u] - np.arange(len(u)) - 1  # neighbours of the same vertex that follow
    total = np.concatenate([[0], np.cumsum(later)])

    def known(keys: np.ndarray) -> np.ndarray:
        return directed[np.minimum(np.searchsorted(directed, keys), len(directed) - 1)] == keys

    out, i = [], 0
    while i < len(u):
        j = max(i + 1, int(np.searchsorted(total, total[i] + _TRIANGLE_PAIRS, side="right")) - 1)
        left = np.repeat(np.arange(i, j), later[i:j])
        right = left + 1 + np.arange(len(left)) - np.repeat(total[i:j] - total[i], later[i:j])
        for y, z in ((v[left], v[right]), (v[right], v[left])):
            x = u[left]
            ring = known(x * n + y) & known(y * n + z) & known(z * n + x)
            x, y, z = x[ring], y[ring], z[ring]
            out += [np.stack(t, axis=1) for t in ((x, y, z), (y, z, x), (z, x, y))]
        i = j
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def _rings(table: pa.Table) -> list[pa.Array]:
    """The three corners of the cycles of one document's edges, as words; loops and edges with a null have none."""
    table = table.filter(pc.not_equal(table.column("src"), table.column("dst")))
    ends = pa.concat_arrays([*table.column("src").chunks, *table.column("dst").chunks, pa.array([], table.column("src").type)])
    coded = ends.dictionary_encode()
    at, n = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)
    found = _cycles(at[: len(table)], at[len(table) :], n)
    return [coded.dictionary.take(pa.array(found[:, i])) for i in range(3)]


def directed_triangles(edges: DataFrame) -> DataFrame:
    """Cycles n1 -> n2 -> n3 -> n1 per document, one row per start. A document's edges meet in one group, in one shuffle."""
    word = edges.schema["src"].dataType.simpleString()

    def find(table: pa.Table) -> pa.Table:
        corners = _rings(table)
        return pa.table([pa.array([table.column("doc")[0].as_py()] * len(corners[0]), table.column("doc").type), *corners], ["doc", "n1", "n2", "n3"])

    schema = f"doc {edges.schema['doc'].dataType.simpleString()}, n1 {word}, n2 {word}, n3 {word}"
    return edges.where(F.col("doc").isNotNull()).select("doc", "src", "dst").groupBy("doc").applyInArrow(find, schema)


def graph_features(edges: DataFrame) -> DataFrame:
    """``doc, feature, n`` for nodes, edges and directed triangles: all of a document's from one group of its edges."""

    def count(table: pa.Table) -> pa.Table:
        doc = table.column("doc")[0].as_py()
        src, dst = (table.column(c).cast(pa.string()) for c in ("src", "dst"))
        join = lambda *parts: pc.binary_join_element_wise(*parts, " ", null_handling="skip")
        nodes = pa.chunked_array([*src.chunks, *dst.chunks], pa.string()).unique()
        links = join(src, dst)
        rings = join(*[c.cast(pa.string()) for c in _rings(table)]) if doc is not None else pa.array([], pa.string())
        found = pa.table({"feature": pa.chunked_array([nodes, *links.chunks, rings], pa.string())}).group_by("feature").aggregate([([], "count_all")])
        docs = pa.array([doc] * len(found), table.column("doc").type)
        return pa.table([docs, found.column("feature"), found.column("count_all")], ["doc", "feature", "n"])

    schema = f"doc {edges.schema['doc'].dataType.simpleString()}, feature string, n long"
    return edges.select("doc", "src", "dst").groupBy("doc").applyInArrow(count, schema)


def attach_vectors(vocab: DataFrame, vectors: DataFrame, dim: int, seed: int = 42, limit: float = 0.25) -> DataFrame:
    """Pre-trained vectors of the words; unknown words get uniform values from a hash of the word."""
    unit = F.transform(
        F.sequence(F.lit(1), F.lit(dim)), lambda i: hash_fraction(["word", i], seed) * (2 * limit) - limit
    )
    return vocab.join(vectors.select("word", F.col("vector").cast("array<double>").alias("_v")), "word", "left").select(
        *vocab.columns, F.coalesce("_v", unit).alias("vector"), F.col("_v").isNotNull().alias("known")
    )
