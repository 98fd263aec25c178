"""Quality classifier: perplexity under an interpolated modified Kneser-Ney bigram model of trusted text.

Words are white-space separated and case-sensitive, so that markup, shouting and filler change them. A word is its 64-bit hash,
whose low bits are the number of its language. There is no vocabulary limit: what is kept per word (context totals,
continuation counts) stays in Spark, in shards by a hash of the word, as bigram counts do, in shards by a hash of
the bigram: a frequent word's bigrams spread over all shards. Only sums per language reach the driver.

Counting: every block of documents sends each shard its distinct bigrams with counts, packed; a shard adds them up, and what they
say about single words is added up once more.
Scoring: a block sends the shards its distinct words and bigrams, packed; a shard looks them up and returns their counts. The block's
words travel as small numbers, and come together with the counts of all shards. No text is shuffled.

    p(w | v) = (1 - u) * ((c(v w) - D(c)) / c(v .) + lambda(v) * p1(w)),   p1: share of the language's bigrams that end with w
    p(unknown) = u,   u = 1 / (trusted words of the language + 2)

``D`` has three values from the counts of counts. The absolute discount of p1 goes back to the words in equal parts, so it cancels out: every trusted
word ends at least one bigram.

A language's threshold comes from the log perplexity of its trusted documents held out from the counts (one in ``HELD_OUT``,
by a hash of the id): the median plus ``SLACK`` times the spread, the distance from the median to the upper quantile. The spread
is drawn to that of the distances of all languages as if ``SPREAD_WEIGHT`` documents had it, so that few held-out documents do
not set it alone; the median is always the language's own. A language without held-out documents cannot be judged, and its
documents with words are kept.

Defined results: a null language is ``und``; a document without words has no perplexity and is rejected; without any trusted text
every document with words is kept; repeated rows each get their row; other columns are ignored. Documents must be a stored
table or another frame whose rows come in the same order each time it is computed; a block that changes between two
attempts is an error, never a wrong sum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_partitions, store

LANGUAGES = 1_000
HELD_OUT = 10
SPREAD_WEIGHT = 20
UPPER_QUANTILE = 0.99
SLACK = 1.5
BLOCK_WORDS = 2_000_000
BROADCAST_IDS = 2_000_000
_LANGUAGE_BITS = 10
_START = np.uint64(0x5851F42D4C957F2D)  # the context of a document's first word


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed byte planes: sorted numbers come as differences, whose high bytes are mostly zero."""
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a)
        parts.append(np.array([len(raw), raw.dtype.itemsize], np.int64).tobytes())
        parts.append(raw.view(np.uint8).reshape(len(raw), -1).T.tobytes())
    return zlib.compress(b"".join(parts), 1)


def _unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw, at, out = zlib.decompress(data), 0, []
    for kind in kinds:
        n, width = np.frombuffer(raw, np.int64, 2, at)
        at += 16
        planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += int(n * width)
    return out


def _differences(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=sorted_keys.dtype.type(0)).astype(sorted_keys.dtype)


def _shards_of(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _by_shard(keys: np.ndarray, shards: int) -> list[tuple[int, np.ndarray]]:
    """Positions of each shard's keys, in key order."""
    shard = _shards_of(keys, shards)
    order = np.lexsort((keys, shard))
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    return [(s, order[cuts[s] : cuts[s + 1]]) for s in range(shards) if cuts[s] < cuts[s + 1]]


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15)
    mixed = ((mixed ^ (mixed >> np.uint64(29))) ^ right) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _add_up(keys: list[np.ndarray], *columns: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct keys (of one column or two) in order, and the sums of each column."""
    parts = [np.concatenate(k) for k in zip(*keys)] if isinstance(keys[0], tuple) else [np.concatenate(keys)]
    order = np.lexsort(parts[::-1])
    parts = [k[order] for k in parts]
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in parts], axis=0)
    at = np.flatnonzero(new)
    sums = [np.add.reduceat(np.concatenate(c)[order], at) if len(at) else np.empty(0, np.int64) for c in columns]
    return [k[at] for k in parts] + sums


def hashed_words(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, words``: the words of a document as hashes of language and word."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    split = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")
    return docs.select("doc_id", lang.alias("lang"), split.alias("split")).select(
        "doc_id", "lang", F.transform("split", lambda w: F.xxhash64("lang", w)).alias("words")
    )


@dataclass
class Model:
    """What is known per language, and the stored shards ``shard, data`` of bigrams and of words."""

    languages: dict[str, int]
    unknown_share: np.ndarray  # per language, the last entry for all others
    mass: np.ndarray  # distinct bigrams that end in the language
    discounts: np.ndarray  # D for counts 1, 2, 3 and more
    shards: int
    pairs: DataFrame | None  # left, right, c
    words: DataFrame | None  # word, c(v .), how many words follow it once, twice, oftener, how many precede it

    def keys(self, hashes: np.ndarray, langs: list[str], lengths: np.ndarray) -> np.ndarray:
        """Hashes whose low bits are the number of the language."""
        number = np.array([self.languages.get(x, len(self.languages)) for x in langs], np.uint64)
        return ((hashes.view(np.uint64) >> np.uint64(_LANGUAGE_BITS)) << np.uint64(_LANGUAGE_BITS)) | np.repeat(number, lengths)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of at most ``BLOCK_WORDS`` words (or one document), with their hashes and lengths."""
    lengths = pc.list_value_length(batch.column("words")).fill_null(0).to_numpy(zero_copy_only=False)
    start = 0
    while start < batch.num_rows:
        stop, words = start + 1, int(lengths[start])
        while stop < batch.num_rows and words + lengths[stop] <= BLOCK_WORDS and stop - start < 60_000:
            words += int(lengths[stop])
            stop += 1
        part = batch.slice(start, stop - start)
        yield part, part.column("words").flatten().to_numpy(zero_copy_only=False), lengths[start:stop].astype(np.int64)
        start = stop


def _previous(ids: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    starts = np.cumsum(lengths) - lengths
    before[starts[lengths > 0]] = first
    return before


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct words of a block with the mark of the start, the words as positions among them, and the mark's position."""
    distinct, ids = np.unique(np.append(keys, _START), return_inverse=True)
    return distinct, ids[:-1], int(ids[-1])


def train(trusted: DataFrame) -> Model:
    """A model of the documents ``doc_id, lang, text``."""
    spark = trusted.sparkSession
    shards = shuffle_partitions(spark)
    hashed = hashed_words(trusted)
    tokens = (
        hashed.groupBy("lang").agg(F.sum(F.size("words")).alias("tokens")).where("tokens > 0")
        .orderBy(F.desc("tokens"), "lang").limit(LANGUAGES).collect()
    )
    languages = {row["lang"]: n for n, row in enumerate(tokens)}
    share = [1 / (row["tokens"] + 2) for row in tokens]
    # languages without trusted text: every word is as unlikely as the least likely unknown word
    share.append(min(share, default=1.0))
    model = Model(languages, np.array(share), np.zeros(len(share)), np.array([0.5, 0.75, 0.9]), shards, None, None)
    if not tokens:
        return model

    def count_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, hashes, lengths in _blocks(batch):
                distinct, ids, first = _numbered(model.keys(hashes, part.column("lang").to_pylist(), lengths))
                pairs, times = np.unique(_previous(ids, lengths, first) * len(distinct) + ids, return_counts=True)
                left, right = distinct[pairs // len(distinct)], distinct[pairs % len(distinct)]
                shard = _shards_of(_pair_keys(left, right), shards)
                sent = [(s, np.flatnonzero(shard == s)) for s in np.unique(shard).tolist()]
                packed = [_pack(_differences(left[at]), right[at], times[at].astype(np.int64)) for _, at in sent]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in sent], pa.int32()), "data": pa.array(packed, pa.binary())})

    def add_pairs(table: pa.Table) -> pa.Table:
        keys, times = [], []
        for data in table.column("data"):
            steps, right, n = _unpack(data.as_py(), np.uint64, np.uint64, np.int64)
            keys.append((np.cumsum(steps, dtype=np.uint64), right))
            times.append(n)
        left, right, sums = _add_up(keys, times)
        packed = _pack(_differences(left), right, sums)
        return pa.table({"shard": table.column("shard")[:1], "data": pa.array([packed], pa.binary())})

    schema = "shard int, data binary"
    pairs = store(hashed.select("lang", "words").mapInArrow(count_block, schema).groupBy("shard").applyInArrow(add_pairs, schema))

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the bigrams of a shard say about single words, for the words' shards."""
        for batch in batches:
            for data in batch.column("data"):
                steps, right, n = _unpack(data.as_py(), np.uint64, np.uint64, np.int64)
                left, one = np.cumsum(steps, dtype=np.uint64), np.ones(len(n), np.int64)
                none = np.zeros(len(n), np.int64)
                stats = [(n, none), (n == 1, none), (n == 2, none), (n >= 3, none), (none, one)]
                words, *sums = _add_up([left, right], *[[a.astype(np.int64), b] for a, b in stats])
                sent = _by_shard(words, shards)
                packed = [_pack(_differences(words[at]), *[x[at] for x in sums]) for _, at in sent]
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s for s, _ in sent], pa.int32()), "data": pa.array(packed, pa.binary())})

    def add_words(table: pa.Table) -> pa.Table:
        parts = [_unpack(data.as_py(), np.uint64, *[np.int64] * 5) for data in table.column("data")]
        words, *sums = _add_up([np.cumsum(x[0], dtype=np.uint64) for x in parts], *[[x[i] for x in parts] for i in range(1, 6)])
        packed = _pack(_differences(words), *sums)
        return pa.table({"shard": table.column("shard")[:1], "data": pa.array([packed], pa.binary())})

    words = store(pairs.mapInArrow(profile, schema).groupBy("shard").applyInArrow(add_words, schema))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams that occur once to four times, and bigrams by the language of their last word; one row per task."""
        total = np.zeros(4 + len(share), np.int64)
        for batch in batches:
            for data in batch.column("data"):
                _, right, n = _unpack(data.as_py(), np.uint64, np.uint64, np.int64)
                total[:4] += np.bincount(np.minimum(n, 5), minlength=6)[1:5]
                language = (right & np.uint64((1 << _LANGUAGE_BITS) - 1)).astype(np.int64)
                total[4:] += np.bincount(language, minlength=len(share))
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(total)), pa.int32()), "n": pa.array(total)})

    found = {r["at"]: r["n"] for r in pairs.mapInArrow(sums, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    n1, n2, n3, n4 = (float(found[i]) for i in range(4))
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        model.discounts = np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.95, 2.95])
    model.mass = np.array([float(found[4 + i]) for i in range(len(share))])
    model.pairs, model.words = pairs, words
    return model


_ROW = "shard int, kind int, block binary, data binary, doc_ids array<long>, langs array<string>, lengths array<int>"
_PAIRS, _WORDS, _ASKED_PAIRS, _ASKED_WORDS, _BASE = range(5)
_NAMES = [f.split()[0] for f in _ROW.split(", ")]


def _asked(distinct: np.ndarray, ids: np.ndarray, before: np.ndarray, shards: int) -> tuple[list, list, np.ndarray, np.ndarray]:
    """Distinct words and bigrams of a block by shard, the bigrams' keys, and each word's place among them."""
    pairs, place = np.unique(before * len(distinct) + ids, return_inverse=True)
    keys = _pair_keys(distinct[pairs // len(distinct)], distinct[pairs % len(distinct)])
    return _by_shard(distinct, shards), _by_shard(keys, shards), keys, place


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, n_words, log_prob, log_perplexity`` for every row of ``docs(doc_id, lang, text)``."""
    shards, discounts = model.shards, model.discounts
    has_counts = model.pairs is not None
    small = Model(**{**model.__dict__, "pairs": None, "words": None})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            for part, hashes, lengths in _blocks(batch):
                langs, doc_ids = part.column("lang").to_pylist(), part.column("doc_id").to_pylist()
                distinct, ids, first = _numbered(small.keys(hashes, langs, lengths))
                digest = hashlib.blake2b(hashes.tobytes() + lengths.tobytes(), digest_size=12)
                # partitions may hold the same rows; a task that runs again has the same partition
                digest.update(repr((TaskContext.get().partitionId(), number, doc_ids)).encode())
                block = digest.digest()
                rows = []
                if has_counts and len(ids):
                    words, pairs, keys, _ = _asked(distinct, ids, _previous(ids, lengths, first), shards)
                    rows += [(s, _ASKED_WORDS, _pack(_differences(distinct[at]))) for s, at in words]
                    rows += [(s, _ASKED_PAIRS, _pack(_differences(keys[at]))) for s, at in pairs]
                n = len(rows)
                rows.append((int.from_bytes(block[:4], "little") % shards, _BASE, _pack(_differences(distinct), ids.astype(np.uint32)) if len(ids) else None))
                none = [None] * n
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([block] * (n + 1), pa.binary()),
                        pa.array([r[2] for r in rows], pa.binary()),
                        pa.array([*none, doc_ids], pa.list_(pa.int64())),
                        pa.array([*none, langs], pa.list_(pa.string())),
                        pa.array([*none, lengths.tolist()], pa.list_(pa.int32())),
                    ],
                    names=_NAMES,
                )

    def look_up(table: tuple, wanted: np.ndarray) -> list[np.ndarray]:
        keys, *columns = table
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        return [np.where(hit, c[at], 0) for c in columns]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a shard come before the requests to it."""
        shard, tables = None, {}
        no_key = np.zeros(1, np.uint64)
        for batch in batches:
            out = []
            for n in range(batch.num_rows):
                if batch.column("shard")[n].as_py() != shard:
                    shard = batch.column("shard")[n].as_py()
                    tables = {_PAIRS: (no_key, np.zeros(1, np.int64)), _WORDS: (no_key, *[np.zeros(1, np.int64)] * 5)}
                kind, data = batch.column("kind")[n].as_py(), batch.column("data")[n].as_py()
                if kind == _PAIRS:
                    steps, right, c = _unpack(data, np.uint64, np.uint64, np.int64)
                    keys = _pair_keys(np.cumsum(steps, dtype=np.uint64), right)
                    order = np.argsort(keys)
                    tables[kind] = (keys[order], c[order])
                elif kind == _WORDS:
                    steps, *stats = _unpack(data, np.uint64, *[np.int64] * 5)
                    tables[kind] = (np.cumsum(steps, dtype=np.uint64), *stats)
                elif kind in (_ASKED_PAIRS, _ASKED_WORDS):
                    wanted = np.cumsum(_unpack(data, np.uint64)[0], dtype=np.uint64)
                    data = _pack(*look_up(tables[kind - _ASKED_PAIRS], wanted))
                out.append(data)
            wanted = pa.array([k.as_py() >= _ASKED_PAIRS for k in batch.column("kind")])
            columns = [pa.array(out, pa.binary()) if c == "data" else batch.column(c) for c in _NAMES]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES).filter(wanted)

    def log_probs(base: bytes, replies: dict, langs: list[str], lengths: np.ndarray) -> np.ndarray:
        """Log probability of every word of a block."""
        steps, ids = _unpack(base, np.uint64, np.uint32)
        distinct, ids = np.cumsum(steps, dtype=np.uint64), ids.astype(np.int64)
        before = _previous(ids, lengths, int(np.searchsorted(distinct, _START)))
        stats, c = np.zeros((5, len(distinct)), np.int64), np.zeros(0, np.int64)
        if has_counts:
            words, pairs, keys, place = _asked(distinct, ids, before, shards)
            for s, at in words:
                stats[:, at] = _unpack(replies.pop((_ASKED_WORDS, s)), *[np.int64] * 5)
            c = np.zeros(len(keys), np.int64)
            for s, at in pairs:
                c[at] = _unpack(replies.pop((_ASKED_PAIRS, s)), np.int64)[0]
            c = c[place]
        language = np.repeat([small.languages.get(x, len(small.languages)) for x in langs], lengths)
        share = small.unknown_share[language]
        logs = np.log(share)
        after = stats[4][ids]
        at = np.flatnonzero(after > 0)
        if len(at):
            total = stats[0].astype(float)
            held = discounts[0] * stats[1] + discounts[1] * stats[2] + discounts[2] * stats[3]
            back_off = np.where(stats[0] > 0, held / np.maximum(stats[0], 1), 1.0)
            v, times = before[at], c[at]
            p = back_off[v] * (after[at] / small.mass[language[at]])
            p += np.where(times > 0, (times - discounts[np.clip(times, 1, 3) - 1]) / np.maximum(total[v], 1), 0.0)
            logs[at] = np.log1p(-share[at]) + np.log(p)
        return logs

    def finish(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        changed = ValueError("the documents of a block changed while they were scored; store them first")
        if kinds.count(_BASE) != 1:
            raise changed
        base = kinds.index(_BASE)
        packed, shard = table.column("data").to_pylist(), table.column("shard").to_pylist()
        replies = {(kinds[n], shard[n]): packed[n] for n in range(len(kinds)) if n != base}
        words = np.array(table.column("lengths")[base].values).astype(np.int64)
        langs = table.column("langs")[base].as_py()
        total = np.zeros(len(words))
        if packed[base] is not None:
            if len(replies) != len(kinds) - 1:
                raise changed
            logs = log_probs(packed[base], replies, langs, words)
            total = np.bincount(np.repeat(np.arange(len(words)), words), weights=logs, minlength=len(words))
        log_perplexity = pa.array(-total / np.maximum(words, 1), mask=words == 0)
        return pa.table(
            {
                "doc_id": pa.array(table.column("doc_ids")[base].as_py(), pa.int64()),
                "lang": pa.array(langs, pa.string()),
                "n_words": pa.array(words),
                "log_prob": pa.array(total),
                "log_perplexity": log_perplexity,
            }
        )

    asked = hashed_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")).mapInArrow(ask, _ROW)
    if has_counts:
        empty = [f"CAST(NULL AS {f.split()[1]}) AS {f.split()[0]}" for f in _ROW.split(", ")[4:]]
        for kind, part in ((_PAIRS, model.pairs), (_WORDS, model.words)):
            asked = asked.unionByName(part.selectExpr("shard", f"{kind} AS kind", "CAST(NULL AS BINARY) AS block", "data", *empty))
        asked = asked.repartition(shards, "shard").sortWithinPartitions("shard", "kind").mapInArrow(answer, _ROW)
    return asked.groupBy("block").applyInArrow(
        finish, "doc_id long, lang string, n_words long, log_prob double, log_perplexity double"
    )


def thresholds(held_out: DataFrame, upper: float = UPPER_QUANTILE, slack: float = SLACK) -> DataFrame:
    """``lang, threshold`` of scored trusted documents."""
    valid = held_out.where("log_perplexity IS NOT NULL").select("lang", "log_perplexity")
    middle = valid.groupBy("lang").agg(F.percentile_approx("log_perplexity", F.lit(0.5), F.lit(10_000)).alias("median"))
    # one row per language
    far = valid.join(F.broadcast(middle), "lang").withColumn("far", F.col("log_perplexity") - F.col("median"))
    spread = F.percentile_approx("far", F.lit(upper), F.lit(10_000))
    each = far.groupBy("lang", "median").agg(spread.alias("own"), F.count(F.lit(1)).alias("n"))
    drawn = (F.col("n") * F.col("own") + SPREAD_WEIGHT * F.col("every")) / (F.col("n") + SPREAD_WEIGHT)
    return each.crossJoin(F.broadcast(far.agg(spread.alias("every")))).select("lang", (F.col("median") + slack * drawn).alias("threshold"))


def classify(
    docs: DataFrame, trusted_ids: DataFrame, upper: float = UPPER_QUANTILE, slack: float = SLACK
) -> DataFrame:
    """``doc_id, lang, n_words, log_perplexity, threshold, kept`` for every row of ``docs(doc_id, lang, text)``; the trusted
    text is that of the ``doc_id`` in ``trusted_ids``."""
    given = docs.select("doc_id", "lang", "text")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    trusted = store(trusted_ids.select("doc_id").where("doc_id IS NOT NULL").distinct())
    learned = trusted.where(~held)
    # ids of at most 16 MB are sent to the documents; above that the trusted texts are shuffled to them once and stored
    if trusted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        text = given.join(F.broadcast(learned), "doc_id", "left_semi")
    else:
        text = store(given.join(learned, "doc_id", "left_semi"))
    model = train(text)
    scored = store(score(given, model))
    found = thresholds(scored.join(trusted.where(held), "doc_id", "left_semi"))
    limit = F.coalesce("threshold", F.lit(float("inf")))
    judged = scored.join(F.broadcast(found), "lang", "left")
    return judged.select(
        "doc_id", "lang", "n_words", "log_perplexity", limit.alias("threshold"),
        F.coalesce(F.col("log_perplexity") <= limit, F.lit(False)).alias("kept"),
    )
