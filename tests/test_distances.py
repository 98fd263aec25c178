"""Distance histograms against breadth-first search in plain Python."""

from collections import Counter, deque

import numpy as np
import pytest

from lodestar.operators import graph as G


def brute(edges):
    out = Counter()
    for g in {e[0] for e in edges if None not in e}:
        near = {}
        for _, s, d in (e for e in edges if e[0] == g and None not in e):
            near.setdefault(s, set()).add(d)
            near.setdefault(d, set()).add(s)
        for source in near:
            dist, queue = {source: 0}, deque([source])
            while queue:
                v = queue.popleft()
                for w in near[v]:
                    if w not in dist:
                        dist[w] = dist[v] + 1
                        queue.append(w)
            out.update((g, d) for d in dist.values())
    return dict(out)


def histogram(spark, edges, schema="graph long, src long, dst long", **options):
    return {(r["graph"], r["d"]): r["n"] for r in G.sp_histogram(spark.createDataFrame(edges, schema), **options).collect()}


@pytest.mark.parametrize("bits", [64, 5])
def test_histograms_of_random_graphs(spark, bits):
    rng = np.random.default_rng(bits)
    edges = []
    for g, (n, m) in enumerate([(150, 190), (70, 60), (10, 40)]):
        edges += [(g, int(a), int(b)) for a, b in rng.integers(0, n, size=(m, 2))]
    edges += [(7, 0, i) for i in range(1, 130)] + [(8, 1, 1), (9, None, 2), (None, 1, 2), (0, 3, 3)]
    assert histogram(spark, edges, bits=bits) == brute(edges)


def test_histogram_of_a_long_path_and_of_nothing(spark):
    got = histogram(spark, [("p", f"v{i:03}", f"v{i + 1:03}") for i in range(79)], "graph string, src string, dst string")
    assert got == {("p", 0): 80} | {("p", d): 2 * (80 - d) for d in range(1, 80)}
    assert histogram(spark, []) == {}
