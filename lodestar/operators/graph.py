"""Graph jobs on edge tables ``(src, dst)``.

Loops write their state once per round to the shared checkpoint folder (``materialise``), so lineage
stays short and a lost executor costs one round. Sums and minima per vertex are partial before the
shuffle; a hub meets its one-row state by join, which the adaptive skew join can split.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.columns import key_hash
from lodestar.operators.aggregates import corr_matrix
from lodestar.operators.scaling import Rounds, block_product, checkpoint_folder, hot_keys, materialise, salted_lookup, with_row_number
from lodestar.sources.readers import canonical_edges


def _with_outdegree(edges: DataFrame) -> DataFrame:
    links = edges.select("src", "dst").distinct()
    degree = links.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    return materialise(links.join(degree, "src"))


def pagerank_iter(edges: DataFrame, iters: int = 10, damping: float = 0.85) -> DataFrame:
    """Un-normalised ranks starting at 1 on the pages with links.

    A page without in-links is missing after the first round; a page without links receives only.
    """
    links = _with_outdegree(edges)
    ranks = links.select("src").distinct().select(F.col("src").alias("node"), F.lit(1.0).alias("rank"))
    rounds = Rounds(edges.sparkSession)
    for _ in range(iters):
        shares = links.join(ranks, links.src == ranks.node).select(F.col("dst").alias("node"), (F.col("rank") / F.col("deg")).alias("share"))
        ranks = rounds.store(
            shares.groupBy("node").agg((F.lit(1 - damping) + damping * F.sum("share")).alias("rank"))
        )
    return ranks


def pagerank_tol(
    edges: DataFrame, tol: float = 1e-4, damping: float = 0.85, names: DataFrame | None = None
) -> DataFrame:
    """Un-normalised ranks of all vertices until no rank moves by more than ``tol``; optional names ``(node, name)``."""
    links = _with_outdegree(edges)
    nodes = materialise(links.select(F.explode(F.array("src", "dst")).alias("node")).distinct())
    ranks = nodes.withColumn("rank", F.lit(1.0))
    rounds = Rounds(edges.sparkSession)
    while True:
        inflow = (
            links.join(ranks, links.src == ranks.node)
            .groupBy("dst")
            .agg(F.sum(F.col("rank") / F.col("deg")).alias("inflow"))
        )
        step = rounds.store(
            ranks.withColumnRenamed("rank", "old")
            .join(inflow, F.col("node") == F.col("dst"), "left")
            .select("node", "old", (F.lit(1 - damping) + damping * F.coalesce("inflow", F.lit(0.0))).alias("rank"))
        )
        moved = step.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0]
        ranks = step.select("node", "rank")
        if moved is None or moved <= tol:
            break
    return ranks if names is None else ranks.join(names, "node")


def pagerank_markov(
    edges: DataFrame, damping: float = 0.85, tol: float = 1e-6, iters: int | None = None
) -> DataFrame:
    """Ranks that sum to 1; pages without links spread their rank over all pages. Stops when the
    Euclidean change is at most ``tol``, or after exactly ``iters`` rounds if these are asked for."""
    links = _with_outdegree(edges)
    nodes = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    sinks = links.select(F.col("src").alias("node")).distinct().withColumn("has_links", F.lit(True))
    nodes = materialise(nodes.join(sinks, "node", "left").select("node", F.col("has_links").isNull().alias("sink")))
    n = nodes.count()
    if n == 0:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    ranks = nodes.withColumn("rank", F.lit(1.0 / n))
    loose = ranks.agg(F.sum(F.when(F.col("sink"), F.col("rank")))).first()[0] or 0.0
    rounds = Rounds(edges.sparkSession)
    for done in itertools.count(1):
        inflow = (
            links.join(ranks, links.src == ranks.node)
            .groupBy("dst")
            .agg(F.sum(F.col("rank") / F.col("deg")).alias("inflow"))
        )
        base = F.lit((1 - damping) / n + damping * loose / n)
        step = rounds.store(
            ranks.withColumnRenamed("rank", "old")
            .join(inflow, F.col("node") == F.col("dst"), "left")
            .select("node", "sink", "old", (base + damping * F.coalesce("inflow", F.lit(0.0))).alias("rank"))
        )
        seen = step.agg(
            F.sqrt(F.sum(F.pow(F.col("rank") - F.col("old"), 2))).alias("moved"),
            F.sum(F.when(F.col("sink"), F.col("rank"))).alias("loose"),
        ).first()
        loose = seen["loose"] or 0.0
        ranks = step.select("node", "sink", "rank")
        if done == iters or (iters is None and seen["moved"] <= tol):
            return ranks.select("node", "rank")


def extreme_pages(ranks: DataFrame) -> DataFrame:
    """Pages with the highest and the lowest rank (smallest id on ties)."""
    return ranks.agg(
        F.max_by("node", F.struct("rank", -F.col("node"))).alias("highest"),
        F.min_by("node", F.struct("rank", "node")).alias("lowest"),
    )


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``node, component`` with the smallest vertex id as component id.

    Contraction: each round every vertex points to the neighbour with the smallest hash (a new hash per
    round) and the ends of all edges are replaced, so the edge table shrinks by a constant factor in
    expectation whatever the shape, long chains included. The graph of one round is read only once.
    """
    rounds = Rounds(edges.sparkSession)
    work = rounds.store(canonical_edges(edges))
    vertices = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    if nodes is not None:
        vertices = vertices.unionByName(nodes.select("node"))
    maps: list[DataFrame] = []
    for round_no in itertools.count():
        if work.isEmpty():
            break
        both = work.unionByName(work.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(round_no)), F.col(c))  # noqa: E731,B023
        best = both.groupBy(F.col("src").alias("node")).agg(F.min(order("dst")).alias("_to"))
        own = F.struct(F.xxhash64(F.col("node"), F.lit(round_no)).alias("col1"), F.col("node").alias("dst"))
        hop = materialise(
            best.select("node", F.when(F.col("_to") < own, F.col("_to.dst")).otherwise(F.col("node")).alias("to"))
        )
        maps.append(hop)
        moved = work.join(hop.select(F.col("node").alias("src"), F.col("to").alias("_s")), "src").join(
            hop.select(F.col("node").alias("dst"), F.col("to").alias("_d")), "dst"
        )
        work = rounds.store(canonical_edges(moved.select(F.col("_s").alias("src"), F.col("_d").alias("dst"))))
    labels = vertices.distinct().withColumn("root", F.col("node"))
    for hop in maps:
        step = hop.select(F.col("node").alias("_n"), F.col("to").alias("_to"))
        labels = labels.join(step, F.col("root") == F.col("_n"), "left").select(
            "node", F.coalesce("_to", "root").alias("root")
        )
    labels = materialise(labels)
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")


def oriented(edges: DataFrame) -> DataFrame:
    """Canonical edges that point from the end with fewer neighbours to the other (ties by id)."""
    und = materialise(canonical_edges(edges))
    deg = und.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(
        F.count(F.lit(1)).alias("deg")
    )
    deg = materialise(deg)
    placed = und.join(deg.select(F.col("node").alias("src"), F.col("deg").alias("ds")), "src").join(
        deg.select(F.col("node").alias("dst"), F.col("deg").alias("dd")), "dst"
    )
    keep = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    return materialise(
        placed.select(
            F.when(keep, F.col("src")).otherwise(F.col("dst")).alias("src"),
            F.when(keep, F.col("dst")).otherwise(F.col("src")).alias("dst"),
        )
    )


def triangles(edges: DataFrame) -> DataFrame:
    """Each triangle once as ``a, b, c``.

    With edges pointing to the larger degree every vertex has at most sqrt(2m) out-neighbours, so the
    pairs formed at a vertex stay bounded even for a hub that touches a third of all edges.
    """
    up = oriented(edges)
    first = up.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    second = up.select(F.col("src").alias("a"), F.col("dst").alias("c"))
    wedges = first.join(second, "a").where(F.col("b") < F.col("c"))
    closing = canonical_edges(up).select(F.col("src").alias("b"), F.col("dst").alias("c"))
    return wedges.join(closing, ["b", "c"])


def triangle_count(edges: DataFrame, with_zero: bool = True) -> DataFrame:
    corners = triangles(edges).select(F.explode(F.array("a", "b", "c")).alias("node"))
    counts = corners.groupBy("node").agg(F.count(F.lit(1)).alias("triangles"))
    if not with_zero:
        return counts
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return nodes.join(counts, "node", "left").select("node", F.coalesce("triangles", F.lit(0)).alias("triangles"))


def degrees(edges: DataFrame) -> DataFrame:
    """In, out and total degree from one pass over the edge ends."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                F.struct(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")),
            )
        ).alias("e")
    ).select("e.*")
    return ends.groupBy("node").agg(
        F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"), F.sum(F.col("i") + F.col("o")).alias("degree")
    )


def influence(activity: DataFrame, user: str, target: str, kind: str, wanted: str = "RT") -> DataFrame:
    """Distinct users who re-sent something of the target."""
    links = activity.where(F.col(kind) == wanted).select(F.col(target).alias("node"), F.col(user).alias("by")).distinct()
    return links.groupBy("node").agg(F.count(F.lit(1)).alias("influence"))


def influence_by(df: DataFrame, metric: str, value: str = "influence") -> DataFrame:
    return df.groupBy(metric).agg(F.avg(value).alias("mean_influence"), F.count(F.lit(1)).alias("nodes"))


def rank_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return corr_matrix(df, [a, b], "spearman").where(F.col("a") != F.col("b")).select("value")


def core_numbers(edges: DataFrame) -> DataFrame:
    """k-core number of every vertex; parallel edges of a directed graph count as in- plus out-degree.

    Every vertex starts at its degree and moves to the largest h for which h neighbours have at least h.
    Neighbours are counted per value before the window, which then holds at most as many rows per
    vertex as there are different core values, not one per neighbour. The vertices that hear of a vertex's value are kept as lists
    of about ``HOT_ROWS`` at most, so a round shuffles a row per vertex and value sent, and the edges only as counts.
    """
    links = edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct()
    both = materialise(links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    core = materialise(both.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("core")))
    part = F.pmod(F.xxhash64("src"), F.coalesce("_salts", F.lit(1)))
    spread = both.join(F.broadcast(hot_keys(both, ["dst"])), "dst", "left").groupBy("dst", part.alias("_part"))
    hearers = materialise(spread.agg(F.collect_list("src").alias("srcs")).drop("_part"))

    def update(state: DataFrame) -> DataFrame:
        told = hearers.join(state.select(F.col("node").alias("dst"), F.col("core").alias("c")), "dst")
        near = told.select(F.explode("srcs").alias("node"), "c").groupBy("node", "c").agg(F.count(F.lit(1)).alias("n"))
        high = F.expr("sum(n) over (partition by node order by c desc rows unbounded preceding)")
        best = near.withColumn("h", F.least(F.col("c"), high)).groupBy("node").agg(F.max("h").alias("h"))
        return state.join(best, "node").select("node", F.least("core", "h").alias("core"), F.col("core").alias("old"))

    rounds = Rounds(edges.sparkSession)
    while True:
        # two updates per stored round: values only fall, so an unchanged second update is the end
        step = rounds.store(update(update(core).drop("old")))
        changed = not step.where(F.col("core") != F.col("old")).isEmpty()
        core = step.select("node", "core")
        if not changed:
            return core


def modularity(edges: DataFrame, clustering: DataFrame) -> DataFrame:
    """Sum over clusters of l/m - (d/2m)^2 for undirected edges and ``clustering(node, cluster)``."""
    und = canonical_edges(edges)
    a = clustering.select(F.col("node").alias("src"), F.col("cluster").alias("cs"))
    b = clustering.select(F.col("node").alias("dst"), F.col("cluster").alias("cd"))
    placed = und.join(a, "src").join(b, "dst")
    # clusters on both ends are counted per pair first, so a large cluster is a few rows from here on
    pairs = placed.groupBy("cs", "cd").agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("cs").alias("cluster"), F.col("n").alias("d"),
                         F.when(F.col("cs") == F.col("cd"), F.col("n")).otherwise(0).alias("l")),
                F.struct(F.col("cd").alias("cluster"), F.col("n").alias("d"), F.lit(0).cast("long").alias("l")),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("cluster").agg(F.sum("l").alias("l"), F.sum("d").alias("d"))
    m = F.sum("d") / 2
    return per.agg((F.sum("l") / m - F.sum(F.pow(F.col("d").cast("double"), 2)) / F.pow(2 * m, 2)).alias("modularity"))


def random_labels(nodes: DataFrame, k: int = 2, seed: int = 42) -> DataFrame:
    return nodes.select("node", F.pmod(key_hash(["node"], seed), F.lit(k)).cast("int").alias("cluster"))


def shortest_paths(edges: DataFrame) -> DataFrame:
    """Breadth-first distances ``graph, src, dst, d`` inside each undirected graph ``(graph, src, dst)``."""
    both = edges.select("graph", "src", "dst").unionByName(
        edges.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    both = materialise(both.where(F.col("src") != F.col("dst")).distinct())
    frontier = both.select("graph", "src").distinct().select("graph", "src", F.col("src").alias("dst"))
    found = materialise(frontier.withColumn("d", F.lit(0)))
    parts, frontier = [found], found
    hop = both.select("graph", F.col("src").alias("dst"), F.col("dst").alias("next"))
    for d in itertools.count(1):
        reached = frontier.join(hop, ["graph", "dst"]).select("graph", "src", F.col("next").alias("dst")).distinct()
        # a vertex at distance d was not seen at distance d-1 or d-2, so two layers are enough to compare
        for layer in parts[-2:]:
            reached = reached.join(layer.select("graph", "src", "dst"), ["graph", "src", "dst"], "left_anti")
        frontier = materialise(reached.withColumn("d", F.lit(d)))
        if frontier.isEmpty():
            break
        parts.append(frontier)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sp_histogram(edges: DataFrame, bits: int = 64) -> DataFrame:
    """Ordered vertex pairs per graph and distance (distance 0 counts the vertices) of undirected graphs ``(graph, src, dst)``.

    Breadth-first search from ``bits`` vertices at once: a row holds, for one vertex and one block of start vertices, a set of
    those that have reached it as one number. A round sends the new part of each set along the edges, joins sets with ``bit_or``
    and takes off what was there. Only the number of new bits per graph leaves a round, and the sets of the last two
    rounds are all that is stored: a sixty-fourth of the vertex pairs. Edges with a null and loops are ignored.
    """
    spark = edges.sparkSession
    links = edges.select("graph", "src", "dst").na.drop()
    both = links.unionByName(links.select("graph", F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    nodes = materialise(links.select("graph", F.explode(F.array("src", "dst")).alias("node")).distinct())
    numbered = materialise(with_row_number(nodes, ["graph", "node"], "_n"))
    first = numbered.groupBy("graph").agg(F.min("_n").alias("_first"))
    place = F.col("_n") - F.col("_first")
    start = F.expr(f"shiftleft(1L, cast(pmod(_n - _first, {bits}) as int))")
    own = salted_lookup(numbered, first, ["graph"])
    state = own.select("graph", F.floor(place / bits).alias("block"), "node", start.alias("seen"), start.alias("fresh"))
    hop = materialise(both.where(F.col("src") != F.col("dst")).select("graph", F.col("src").alias("node"), F.col("dst").alias("next")))
    out, rounds = f"{checkpoint_folder(spark)}/lodestar-{uuid.uuid4().hex}", Rounds(spark)
    for d in itertools.count():
        state = rounds.store(state)
        counts = state.groupBy("graph").agg(F.sum(F.bit_count("fresh")).cast("long").alias("n")).where("n > 0")
        counts.write.parquet(f"{out}/d={d}")
        front = state.where("fresh <> 0")
        if front.isEmpty():
            break
        sent = front.select("graph", "block", "node", "fresh").join(hop, ["graph", "node"])
        met = sent.groupBy("graph", "block", F.col("next").alias("node")).agg(F.bit_or("fresh").alias("come"))
        seen = F.coalesce("seen", F.lit(0).cast("long"))
        fresh = F.coalesce("come", F.lit(0).cast("long")).bitwiseAND(F.bitwise_not(seen))
        merged = state.drop("fresh").join(met, ["graph", "block", "node"], "full")
        state = merged.select("graph", "block", "node", seen.bitwiseOR(fresh).alias("seen"), fresh.alias("fresh"))
    kind = edges.schema["graph"].dataType.simpleString()
    return spark.read.schema(f"graph {kind}, n long, d int").parquet(out).select("graph", "d", "n")


def sp_kernel(first: DataFrame, second: DataFrame) -> DataFrame:
    """Dot products of distance histograms, ``row`` from the first and ``col`` from the second collection."""
    left = first.select(F.col("graph").alias("row"), F.col("d").alias("k"), F.col("n").alias("value"))
    right = second.select(F.col("d").alias("k"), F.col("graph").alias("col"), F.col("n").alias("value"))
    return block_product(left, right)


def cycle_path_graphs(spark: SparkSession, lo: int = 3, hi: int = 102) -> DataFrame:
    """Edges ``kind, graph, src, dst`` of the cycles and paths with lo..hi vertices."""
    sizes = spark.range(lo, hi + 1).withColumnRenamed("id", "size")
    steps = sizes.select("size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1)).alias("src"))
    ring = steps.select("size", "src", F.pmod(F.col("src") + 1, F.col("size")).alias("dst"))
    cycles = ring.select(F.lit("cycle").alias("kind"), (2 * F.col("size")).alias("graph"), "src", "dst")
    paths = ring.where(F.col("dst") > 0).select(
        F.lit("path").alias("kind"), (2 * F.col("size") + 1).alias("graph"), "src", "dst"
    )
    return cycles.unionByName(paths)


def random_walks(edges: DataFrame, num_walks: int, length: int, seed: int = 42) -> DataFrame:
    """``walk, nodes``: walks of ``length`` vertices from every vertex, the same for the same seed.

    Edges are numbered per source vertex, and a step is an equality join on (vertex, edge number): no
    vertex ever holds its neighbours as one array, and walks at a hub spread over its edge numbers.
    """
    links = edges.select("src", "dst").distinct()
    numbered = with_row_number(links, ["src", "dst"], "_pos")
    deg = materialise(numbered.groupBy("src").agg(F.count(F.lit(1)).alias("deg"), F.min("_pos").alias("_first")))
    steps = materialise(
        numbered.join(deg, "src").select(F.col("src").alias("at"), (F.col("_pos") - F.col("_first")).alias("pick"), F.col("dst").alias("next"))
    )
    outs = deg.select(F.col("src").alias("at"), "deg")
    nodes = links.select(F.explode(F.array("src", "dst")).alias("start")).distinct()
    walks = nodes.select("start", F.explode(F.sequence(F.lit(1), F.lit(num_walks))).alias("walk")).select(
        "start", "walk", F.col("start").alias("at"), F.array("start").alias("nodes")
    )
    rounds = Rounds(edges.sparkSession)
    for step in range(1, length):
        choice = F.pmod(key_hash(["start", "walk", F.lit(step)], seed), F.col("deg"))
        walks = (
            walks.join(outs, "at", "left")
            .withColumn("pick", choice)
            .join(steps, ["at", "pick"], "left")
            .select(
                "start", "walk", F.coalesce("next", "at").alias("at"),
                F.when(F.col("next").isNull(), F.col("nodes")).otherwise(F.concat("nodes", F.array("next"))).alias("nodes"),
            )
        )
        if step % 5 == 0:
            walks = rounds.store(walks)
    return walks.select("start", "walk", "nodes")


def graph_match(
    nodes: DataFrame, relations: DataFrame, kind: str, src_label: str | None = None, dst_label: str | None = None
) -> DataFrame:
    """Names at both ends of all relations of a type, by label: ``nodes(id, labels, name)``."""
    a = nodes.select(F.col("id").alias("src"), F.col("name").alias("src_name"), F.col("labels").alias("_sl"))
    b = nodes.select(F.col("id").alias("dst"), F.col("name").alias("dst_name"), F.col("labels").alias("_dl"))
    if src_label:
        a = a.where(F.array_contains("_sl", src_label))
    if dst_label:
        b = b.where(F.array_contains("_dl", dst_label))
    return (
        relations.where(F.col("type") == kind).join(a, "src").join(b, "dst").select("src", "src_name", "dst", "dst_name")
    )


def find_nodes(nodes: DataFrame, label: str, names: Sequence[str]) -> DataFrame:
    return nodes.where(F.array_contains("labels", label) & F.col("name").isin(list(names)))
