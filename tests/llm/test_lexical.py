"""Ranked lexical search against scoring every document by the definition."""

import math
import re

import numpy as np
import pytest

from lodestar.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, score long, terms array<int>, item_id long"
ITEMS = "item_id long, text string, rank int, doc_id long"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    known = [(i, terms(t)) for i, t in docs]
    known = [(i, t) for i, t in known if t]
    n, total = len(known), sum(len(t) for _, t in known)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, words in asked.items():
        weight = {}
        for w in words:
            df = sum(w in t for _, t in known)
            weight[w] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) if n else 0
        scored = []
        for i, t in known:
            m = 100 - 90 + (90 * len(t) * n) // total
            score = sum(weight[w] * ((1_000_000_000 * t.count(w)) // (1000 * t.count(w) + 8 * m)) for w in words if w in t)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out.add((item, rank, i, -s))
    return out


def found(spark, docs, items, k=10, **sizes):
    left = spark.createDataFrame([(i, t, 1, [1], 2) for i, t in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    rows = [tuple(r) for r in lexical.search(left, right, k, **sizes).select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n=700):
    """Words of very uneven frequency, copies, and documents of very uneven length."""
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(300)]
    odds = 1 / np.arange(1, 301)
    odds /= odds.sum()
    docs = [(int(i * 3 % n), " ".join(rng.choice(words, rng.integers(1, 60), p=odds))) for i in range(n)]
    docs += [(10_000 + i, docs[5][1]) for i in range(80)]
    docs += [(20_000, " ".join(rng.choice(words, 20_000, p=odds))), (20_001, None), (20_002, ""), (20_003, ".,;"), (None, docs[7][1])]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 25), p=odds))) for i in range(25)]
    items += [(100, docs[5][1]), (101, None), (102, "nowhere"), (3, "w299 W1"), (None, "w2 w17")]
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"shard_docs": 97, "window": 16, "short_share": 0.1}, {"window": 8, "short_share": 0.0}, {"short_share": 2.0}])
def test_ranking_equals_scoring_everything(spark, sizes):
    docs, items = corpus(1)
    assert found(spark, docs, items, **sizes) == brute(docs, items, 10)


def test_items_in_blocks(spark):
    docs, items = corpus(2, 120)
    assert found(spark, docs, items, 3, block_pairs=40, shard_postings=100) == brute(docs, items, 3)


def test_terms_and_their_case():
    text = "Äpfel-ÄPFEL été x İ a_b A1\x00b\x7f„c“ 😀 Z[z]"
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


def test_windows_are_skipped():
    """The threshold makes most windows of a frequent term needless."""
    n, whole = 4096, lexical.Collection(4096, 4096 * 10, np.array([4096, 20]))
    owners = np.concatenate([np.arange(n), np.arange(0, 20)])
    numbers = np.concatenate([np.zeros(n, np.int32), np.ones(20, np.int32)])
    counts = np.ones(n + 20, np.int64)
    shard = lexical.Shard(n, np.full(n, 10), owners, numbers, counts, whole, whole.weights(), 64, 0.01)
    seen, inner = [], shard._in_window
    shard._in_window = lambda lists, most, window, least: seen.append(window) or inner(lists, most, window, least)
    docs, scores, _ = shard.search(np.array([0, 1]), 10, 0)
    assert docs.tolist() == list(range(10)) and len(set(scores.tolist())) == 1 and seen == [0]


def test_odd_tables(spark):
    assert found(spark, [], [(1, "a")]) == set()
    assert found(spark, [(1, "a")], []) == set()
    assert found(spark, [(1, None), (2, "!")], [(1, "a"), (2, None)]) == set()
    same = [(4, "a b")] * 12 + [(3, "a b")] * 2
    assert len(lexical.search(spark.createDataFrame([(i, t, 1, [1], 2) for i, t in same], DOCS), spark.createDataFrame([(1, "a", 1, 1)], ITEMS)).collect()) == 10


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "z")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "X")], "item_id string, text string")
    got = sorted((r["rank"], r["doc_id"]) for r in lexical.search(docs, items).collect())
    assert got == [(1, "a"), (2, "b"), (3, None)]
