"""Ranked lexical search, hybrid of term-at-a-time and document-at-a-time over an inverted index.

``count_terms`` reads every text once: a row per document with its length and the counts of the asked terms. ``search`` packs
these rows into shards of bounded size, in the order of the document ids, and turns each shard into posting lists with the
largest contribution per window of documents. Per item and shard:

* Term at a time: the short lists (less than ``short_share`` of the shard's documents) are summed into one sorted list of
  accumulators. From there on it is one more iterator, bounded by its own window maxima. Its ``k`` best sums are lower bounds
  of final scores and give the first threshold.
* Document at a time: the long lists and this iterator advance together through the windows. A window whose maxima add up to
  less than the threshold is skipped in all lists. In a window, the iterators with the smallest maxima that together stay below
  the threshold bring in no document; they are looked up only for documents that can still reach it.

Contributions are non-negative integers, so the bounds are exact and nothing is lost; equal scores are never skipped. A task
hands its threshold from shard to shard and emits at most ``k`` rows per item and shard. Documents are never shuffled.

A document's length, its terms' counts and the collection's counts are as given in ``Collection``. The items are taken in blocks of
at most about ``block_pairs`` item-term pairs, which travel with the tasks.

Defined results: a document without a term (null, empty, only delimiters) is not counted and never returned; every other row is
a document of its own, also if it repeats an id or has a null id (last among equal scores); rows that share an item id are one
item with the terms of all; an item without terms, or whose terms no document holds, has no rows; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import store

SHARD_DOCS = 32_768
SHARD_POSTINGS = 8_000_000
WINDOW = 512
SHORT_SHARE = 1 / 32
BLOCK_PAIRS = 1_000_000

# every byte of a delimiter becomes a space; only A-Z change their case, and bytes of other characters stay
_BYTES = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


@dataclass(frozen=True)
class Collection:
    """``documents`` with a term, their ``terms`` with repeats, and documents per term number."""

    documents: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        n = self.documents
        return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in self.holding], np.int64)

    def contributions(self, weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = 100 - 90 + (90 * lengths * self.documents) // self.terms
        return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))


def item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``item_id, term`` of ``items(item_id, text)``."""
    rows = items.select("item_id", "text")
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t or b""))) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            take = np.repeat(np.arange(len(found)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(take)), pa.array([t for f in found for t in f], pa.binary())],
                names=["item_id", "term"],
            )

    return rows.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, length, terms, counts`` per row of ``docs(doc_id, text)`` that has a term: how many it has, and which
    numbers of the vocabulary occur how often."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                take, lengths, terms, counts = [], [], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
                for n, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                    words = terms_of(text or b"")
                    if words:
                        known = [w for w in map(number.get, words) if w is not None]
                        ids, times = np.unique(np.array(known, np.int32), return_counts=True)
                        take.append(n)
                        lengths.append(len(words))
                        terms.append(ids)
                        counts.append(times)
                ends = pa.array(np.cumsum([len(t) for t in terms]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(take, pa.int64())),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(terms), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int64())),
                    ],
                    names=["doc_id", "length", "terms", "counts"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, length long, terms array<int>, counts array<long>")


def collection_of(counted: DataFrame, n_terms: int) -> Collection:
    whole = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("l")).first()
    holding = np.zeros(n_terms, np.int64)
    per_term = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    for row in per_term.collect():  # one row per asked term of the block
        holding[row["term"]] = row["n"]
    return Collection(whole["n"], whole["l"] or 0, holding)


class _List:
    """Ascending documents of a shard, their contributions, and per window the place and the largest contribution."""

    def __init__(self, docs: np.ndarray, scores: np.ndarray, edges: np.ndarray):
        self.docs, self.scores = docs, scores
        self.place = np.searchsorted(docs, edges)
        self.most = np.zeros(len(edges) - 1, np.int64)
        filled = np.flatnonzero(np.diff(self.place))
        if len(filled):
            self.most[filled] = np.maximum.reduceat(scores, self.place[filled])

    def part(self, window: int) -> slice:
        return slice(self.place[window], self.place[window + 1])


def _best(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller document."""
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


class Shard:
    """Posting lists of some documents (numbered by id order) and the search over them."""

    def __init__(self, size: int, lengths, owners, terms, counts, collection: Collection, weights, window: int, short_share: float):
        self.edges = np.arange(0, size + window, window)
        self.short, self.window = short_share * size, window
        scores = collection.contributions(weights[terms], counts, lengths[owners])
        order = np.lexsort((owners, terms))
        terms, owners, scores = terms[order], owners[order], scores[order]
        cuts = np.flatnonzero(np.diff(terms, prepend=-1, append=-1)) if len(terms) else np.zeros(1, np.int64)
        self.spans = {int(terms[a]): (a, b) for a, b in zip(cuts[:-1], cuts[1:])}
        self.owners, self.scores = owners, scores
        self.lists: dict[int, _List] = {}

    def _long(self, term: int) -> _List:
        if term not in self.lists:
            a, b = self.spans[term]
            self.lists[term] = _List(self.owners[a:b], self.scores[a:b], self.edges)
        return self.lists[term]

    def accumulate(self, terms: list[int]) -> _List:
        """Term at a time: the sums of the short lists."""
        spans = [self.spans[t] for t in terms]
        docs = np.concatenate([self.owners[a:b] for a, b in spans] or [np.empty(0, np.int64)])
        scores = np.concatenate([self.scores[a:b] for a, b in spans] or [np.empty(0, np.int64)])
        own, at = np.unique(docs, return_inverse=True)
        sums = np.zeros(len(own), np.int64)
        np.add.at(sums, at, scores)
        return _List(own, sums, self.edges)

    def search(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents, scores and the new threshold; no document below ``least`` is needed."""
        here = [int(t) for t in terms if int(t) in self.spans]
        length = {t: self.spans[t][1] - self.spans[t][0] for t in here}
        summed = self.accumulate([t for t in here if length[t] < self.short])
        iterators = [summed] + [self._long(t) for t in here if length[t] >= self.short]
        if len(summed.scores) >= k:
            least = max(least, int(np.partition(summed.scores, len(summed.scores) - k)[-k]))
        docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        bounds = np.array([i.most for i in iterators])
        for window in np.flatnonzero(bounds.sum(axis=0) >= max(least, 1)):
            most = bounds[:, window]
            if most.sum() < least:
                continue
            some, sums = self._in_window(iterators, most, window, least)
            if len(some):
                docs, scores = _best(np.concatenate([docs, some]), np.concatenate([scores, sums]), k)
                if len(docs) == k:
                    least = max(least, int(scores[-1]))
        return docs, scores, least

    def _in_window(self, iterators: list[_List], most: np.ndarray, window: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(most, kind="stable")
        reach = np.cumsum(most[order])
        optional = int(np.searchsorted(reach, least))  # these alone stay below the threshold
        base = self.edges[window]
        total = np.zeros(self.window, np.int64)
        for n in order[optional:]:
            part = iterators[n].part(window)
            total[iterators[n].docs[part] - base] += iterators[n].scores[part]
        rest = int(reach[optional - 1]) if optional else 0
        found = np.flatnonzero((total > 0) & (total + rest >= least))
        sums = total[found]
        for n in order[:optional][::-1]:
            if not len(found):
                break
            part = iterators[n].part(window)
            docs = iterators[n].docs[part] - base
            if len(docs):
                at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                sums += np.where(docs[at] == found, iterators[n].scores[part][at], 0)
            rest -= int(most[n])
            able = sums + rest >= least
            found, sums = found[able], sums[able]
        return found + base, sums


def _shards(batches: Iterator[pa.RecordBatch], docs: int, postings: int) -> Iterator[pa.Table]:
    """Rows of a task in tables of at most ``docs`` rows and about ``postings`` postings."""
    held, n, p = [], 0, 0
    for whole in batches:
        for start in range(0, whole.num_rows, 1024):
            batch = whole.slice(start, 1024)
            more = len(batch.column("terms").flatten())
            if held and (n + batch.num_rows > docs or p + more > postings):
                yield pa.Table.from_batches(held)
                held, n, p = [], 0, 0
            held.append(batch)
            n, p = n + batch.num_rows, p + more
    if held:
        yield pa.Table.from_batches(held)


def search_counted(
    counted: DataFrame,
    items: list[tuple[int, np.ndarray]],
    collection: Collection,
    k: int,
    shard_docs: int = SHARD_DOCS,
    shard_postings: int = SHARD_POSTINGS,
    window: int = WINDOW,
    short_share: float = SHORT_SHARE,
) -> DataFrame:
    """``item, doc_id, score``: for each ``(item, term numbers)`` at least its k best rows of ``counted``."""
    kind = counted.schema["doc_id"].dataType.simpleString()
    sent = counted.sparkSession.sparkContext.broadcast((items, collection, collection.weights()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, whole, weights = sent.value
        least = np.zeros(len(asked), np.int64)
        for table in _shards(batches, shard_docs, shard_postings):
            ids = table.column("doc_id").combine_chunks()
            order = pc.sort_indices(ids, null_placement="at_end")
            table, ids = table.take(order), ids.take(order)
            terms = table.column("terms").combine_chunks()
            owners = np.repeat(np.arange(len(ids)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))
            shard = Shard(
                len(ids),
                table.column("length").to_numpy(),
                owners,
                terms.flatten().to_numpy(),
                table.column("counts").combine_chunks().flatten().to_numpy(),
                whole,
                weights,
                window,
                short_share,
            )
            found = []
            for n, (_, numbers) in enumerate(asked):
                docs, scores, least[n] = shard.search(numbers, k, int(least[n]))
                found.append((np.full(len(docs), asked[n][0], np.int64), docs, scores))
            item, docs, scores = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (list(zip(*found)) or [[], [], []]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), ids.take(pa.array(docs)), pa.array(scores)], names=["item", "doc_id", "score"]
            )

    return counted.mapInArrow(run, f"item long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_pairs: int = BLOCK_PAIRS, **sizes) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of ``docs(doc_id, text)`` for each of ``items(item_id, text)``.

    ``sizes`` are the shard sizes, window and share of ``search_counted``."""
    spark = docs.sparkSession
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    pairs = store(item_terms(items))
    blocks = max(1, math.ceil(pairs.count() / block_pairs))
    out = spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # about block_pairs rows
        if not own:
            continue
        vocabulary = {bytes(t): n for n, t in enumerate(sorted({bytes(r["term"]) for r in own}))}
        ids = list(dict.fromkeys(r["item_id"] for r in own))
        place = {v: n for n, v in enumerate(ids)}
        numbers: list[list[int]] = [[] for _ in ids]
        for r in own:
            numbers[place[r["item_id"]]].append(vocabulary[bytes(r["term"])])
        counted = store(count_terms(docs, vocabulary))
        collection = collection_of(counted, len(vocabulary))
        if not collection.documents:
            continue
        asked = [(n, np.array(sorted(t), np.int32)) for n, t in enumerate(numbers)]
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = (
            search_counted(counted, asked, collection, k, **sizes)
            .withColumn("rank", F.row_number().over(best))
            .where(F.col("rank") <= k)
        )
        names = spark.createDataFrame([(n, v) for n, v in enumerate(ids)], f"item long, item_id {item_kind}")
        out = out.unionByName(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
