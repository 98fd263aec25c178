"""Graph queries on graphs derived from orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import clustering as K
from lodestar.operators import graph as G
from lodestar.operators import models as ML
from lodestar.operators import neighbours as N
from lodestar.operators import spectral
from lodestar.operators import wordvectors as WV
from lodestar.plans.graphs import SUCCESSION_SQL, nation_runs, status_runs, succession
from lodestar.plans.queries_rows import hash_sql
from lodestar.plans.registry import query

_ROUNDS = 6


def _rank_rounds(rounds: int) -> str:
    steps = ["r0 AS (SELECT DISTINCT src AS node, 1.0::DOUBLE AS rank FROM e)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"r{i} AS (SELECT dst AS node, 0.15 + 0.85 * sum(rank / deg) AS rank FROM e JOIN d USING (src) JOIN r{i - 1} ON node = src GROUP BY dst)"
        )
    return ", ".join(steps)


@query(
    "g01_pagerank_iter",
    f"WITH e AS MATERIALIZED ({SUCCESSION_SQL}), d AS (SELECT src, count(*) AS deg FROM e GROUP BY src), {_rank_rounds(_ROUNDS)} SELECT node, round(rank, 7) AS rank FROM r{_ROUNDS}",
)
def _(t):
    return G.pagerank_iter(succession(t), _ROUNDS).withColumn("rank", F.round("rank", 7))


def _tol_sql(rounds: int) -> str:
    steps = ["n AS (SELECT src AS node FROM e UNION SELECT dst FROM e)", "r0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE AS rank, 1e9::DOUBLE AS delta FROM n)"]
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        # a round is frozen once the round before moved by no more than the tolerance
        steps.append(
            f"s{i} AS (SELECT n.node, 0.15 + 0.85 * coalesce(sum(rank / deg), 0) AS rank FROM n LEFT JOIN (SELECT dst, rank, deg FROM e JOIN d USING (src) JOIN {p} ON {p}.node = src) ON dst = n.node GROUP BY n.node), "
            f"m{i} AS (SELECT max(abs(s{i}.rank - {p}.rank)) AS moved FROM s{i} JOIN {p} USING (node)), "
            f"r{i} AS MATERIALIZED (SELECT node, CASE WHEN {p}.delta > 1e-4 THEN s{i}.rank ELSE {p}.rank END AS rank, CASE WHEN {p}.delta > 1e-4 THEN moved ELSE {p}.delta END AS delta FROM {p} JOIN s{i} USING (node), m{i})"
        )
    return ", ".join(steps)


@query(
    "g02_pagerank_tol",
    f"WITH e AS MATERIALIZED ({SUCCESSION_SQL}), d AS (SELECT src, count(*) AS deg FROM e GROUP BY src), {_tol_sql(18)} SELECT node, c_name AS name, round(rank, 6) AS rank FROM r18 JOIN customer ON node = c_custkey",
)
def _(t):
    names = t.customer.select(F.col("c_custkey").alias("node"), F.col("c_name").alias("name"))
    return G.pagerank_tol(succession(t), 1e-4, names=names).withColumn("rank", F.round("rank", 6))


def _markov_sql(rounds: int) -> str:
    steps = ["n AS (SELECT src AS node FROM e UNION SELECT dst FROM e)", "c AS (SELECT count(*) AS total FROM n)", "r0 AS (SELECT node, 1.0 / total AS rank FROM n, c)"]
    for i in range(1, rounds + 1):
        p = f"r{i - 1}"
        steps.append(
            f"l{i} AS (SELECT coalesce(sum(rank), 0) AS loose FROM {p} WHERE node NOT IN (SELECT src FROM e)), r{i} AS MATERIALIZED (SELECT n.node, 0.15 / max(total) + 0.85 * (max(loose) / max(total) + coalesce(sum(rank / deg), 0)) AS rank FROM n "
            f"CROSS JOIN c CROSS JOIN l{i} LEFT JOIN (SELECT dst, rank, deg FROM e JOIN d USING (src) JOIN {p} ON {p}.node = src) ON dst = n.node GROUP BY n.node)"
        )
    return ", ".join(steps)


_ONE_WAY_SQL = "SELECT DISTINCT o_custkey AS src, 1000000 + l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' UNION SELECT DISTINCT 1000000 + l_suppkey, o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'A' AND l_discount > 0.09"


def _one_way(t):
    """Customers point to suppliers of returned lines, suppliers back to customers of heavily discounted ones."""
    lines = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
    who, supplier = F.col("o_custkey"), F.col("l_suppkey") + 1000000
    out = lines.where("l_returnflag = 'R'").select(who.alias("src"), supplier.alias("dst"))
    back = lines.where("l_returnflag = 'A' AND l_discount > 0.09").select(supplier.alias("src"), who.alias("dst"))
    return out.unionByName(back).distinct()


@query(
    "g03_pagerank_markov",
    f"WITH e AS MATERIALIZED ({_ONE_WAY_SQL}), d AS (SELECT src, count(*) AS deg FROM e GROUP BY src), {_markov_sql(5)} SELECT node, round(rank, 9) AS rank FROM r5",
)
def _(t):
    return G.pagerank_markov(_one_way(t), iters=5).withColumn("rank", F.round("rank", 9))


@query(
    "g03_extreme_pages",
    f"WITH e AS MATERIALIZED ({SUCCESSION_SQL}), d AS (SELECT src, count(*) AS deg FROM e GROUP BY src), {_markov_sql(15)} SELECT arg_max(node, rank) AS highest, arg_min(node, rank) AS lowest FROM r15",
)
def _(t):
    return G.extreme_pages(G.pagerank_markov(succession(t), tol=1e-6))


@query(
    "g04_connected_components",
    "WITH b AS (SELECT o_orderkey AS k, o_orderstatus AS s, CASE WHEN lag(o_orderstatus) OVER w = o_orderstatus AND lag(o_orderkey) OVER w = o_orderkey - 1 THEN 0 ELSE 1 END AS fresh FROM orders WINDOW w AS (ORDER BY o_orderkey)), "
    "r AS (SELECT k, sum(fresh) OVER (ORDER BY k) AS run FROM b), z AS (SELECT run, min(k) AS component, count(*) AS n FROM r GROUP BY run) SELECT k AS node, component FROM r JOIN z USING (run) WHERE n > 1",
)
def _(t):
    return G.connected_components(status_runs(t))


_UND_SQL = "SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e"


@query(
    "g05_triangle_count",
    f"WITH e AS ({SUCCESSION_SQL}), u AS MATERIALIZED ({_UND_SQL}), t AS (SELECT x.a AS a, x.b AS b, y.b AS c FROM u x JOIN u y ON x.b = y.a JOIN u z ON z.a = x.a AND z.b = y.b), k AS (SELECT a AS node FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t), "
    "n AS (SELECT a AS node FROM u UNION SELECT b FROM u) SELECT node, count(k.node) AS triangles FROM n LEFT JOIN k USING (node) GROUP BY node",
)
def _(t):
    return G.triangle_count(succession(t))


@query(
    "g06_degrees",
    f"WITH e AS ({SUCCESSION_SQL}), x AS (SELECT src AS node, 1 AS o, 0 AS i FROM e UNION ALL SELECT dst, 0, 1 FROM e) SELECT node, CAST(sum(i) AS BIGINT) AS in_degree, CAST(sum(o) AS BIGINT) AS out_degree, count(*) AS degree FROM x GROUP BY node",
)
def _(t):
    return G.degrees(succession(t))


_INFLUENCE_SQL = (
    "SELECT o_custkey AS node, count(DISTINCT l_suppkey) AS influence FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' GROUP BY o_custkey"
)


def _influence(t):
    log = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("l_suppkey", "o_custkey", "l_returnflag")
    return G.influence(log, "l_suppkey", "o_custkey", "l_returnflag", "R")


@query(
    "g06_influence_by_degree",
    f"WITH e AS ({SUCCESSION_SQL}), d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node), f AS ({_INFLUENCE_SQL}) SELECT degree, round(avg(influence), 9) AS mean_influence, count(*) AS nodes "
    "FROM d JOIN f USING (node) GROUP BY degree",
)
def _(t):
    rows = G.degrees(succession(t)).join(_influence(t), "node")
    return G.influence_by(rows, "degree").withColumn("mean_influence", F.round("mean_influence", 9))


@query(
    "g06_rank_correlation",
    f"WITH e AS ({SUCCESSION_SQL}), d AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM e UNION ALL SELECT dst FROM e) GROUP BY node), f AS ({_INFLUENCE_SQL}), r AS (SELECT rank() OVER (ORDER BY degree) + (count(*) OVER (PARTITION BY degree) - 1) / 2.0 "
    "AS a, rank() OVER (ORDER BY influence) + (count(*) OVER (PARTITION BY influence) - 1) / 2.0 AS b FROM d JOIN f USING (node)) SELECT round(corr(a, b), 8) AS value FROM r",
)
def _(t):
    rows = G.degrees(succession(t)).join(_influence(t), "node")
    return G.rank_correlation(rows, "degree", "influence").withColumn("value", F.round("value", 8))


@query("g07_influence", _INFLUENCE_SQL)
def _(t):
    return _influence(t)


def _core_sql(rounds: int) -> str:
    steps = ["c0 AS MATERIALIZED (SELECT node, count(*) AS core FROM b GROUP BY node)"]
    for i in range(1, rounds + 1):
        p = f"c{i - 1}"
        steps.append(
            f"x{i} AS (SELECT b.node, least({p}.core, row_number() OVER (PARTITION BY b.node ORDER BY {p}.core DESC)) AS h FROM b JOIN {p} ON {p}.node = b.other), c{i} AS MATERIALIZED (SELECT node, max(h) AS core FROM x{i} GROUP BY node)"
        )
    return ", ".join(steps)


@query(
    "g08_core_numbers",
    f"WITH e AS ({SUCCESSION_SQL}), b AS MATERIALIZED (SELECT src AS node, dst AS other FROM e UNION ALL SELECT dst, src FROM e), {_core_sql(40)} SELECT node, core FROM c40",
)
def _(t):
    return G.core_numbers(succession(t))


@query("g09_cluster_graph")
def _(t):
    return K.cluster_graph(succession(t), 2, max_iter=10)


def _longest_run(t):
    """The orders of the longest runs of equal status, one of them."""
    runs = status_runs(t)
    component = G.connected_components(runs)
    sizes = component.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    chosen = sizes.agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("component"))
    kept = component.join(chosen, "component", "left_semi").select(F.col("node").alias("src"))
    return runs.join(kept, "src", "left_semi")


@query(
    "g09_laplacian_values",
    "WITH s AS (SELECT o_orderkey AS k, o_orderstatus AS g FROM orders), b AS (SELECT k, CASE WHEN lag(g) OVER w = g AND lag(k) OVER w = k - 1 THEN 0 ELSE 1 END AS fresh FROM s WINDOW w AS (ORDER BY k)), r AS (SELECT sum(fresh) OVER (ORDER BY k) AS run FROM b), "
    "n AS (SELECT max(c) AS n FROM (SELECT count(*) AS c FROM r GROUP BY run)) SELECT CAST(j + 1 AS INT) AS axis, round(2 - 2 * cos(pi() * j / n), 7) AS value FROM n, (SELECT unnest(range(0, 4)) AS j) WHERE j < n",
)
def _(t):
    values, _ = spectral.laplacian_eigenvectors(_longest_run(t), 4)
    rows = [(i + 1, round(v, 7) + 0.0) for i, v in enumerate(values)]
    return t.spark.createDataFrame(rows, "axis INT, value DOUBLE")


@query("g09_spectral_clusters")
def _(t):
    return K.spectral_clusters(succession(t), 2)[1]


@query(
    "g10_modularity",
    f"WITH e AS ({SUCCESSION_SQL}), u AS ({_UND_SQL}), k AS (SELECT c_custkey AS node, c_nationkey AS cluster FROM customer), p AS (SELECT x.cluster AS cs, y.cluster AS cd FROM u JOIN k x ON x.node = a JOIN k y ON y.node = b), m AS (SELECT count(*)::DOUBLE AS m FROM p), "
    "l AS (SELECT cs AS cluster, count(*) AS l FROM p WHERE cs = cd GROUP BY cs), d AS (SELECT cluster, count(*)::DOUBLE AS d FROM (SELECT cs AS cluster FROM p UNION ALL SELECT cd FROM p) GROUP BY cluster) "
    "SELECT round(sum(coalesce(l, 0) / m - (d / (2 * m)) ** 2), 9) AS modularity FROM d LEFT JOIN l USING (cluster), m",
)
def _(t):
    clusters = t.customer.select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("cluster"))
    return G.modularity(succession(t), clusters).withColumn("modularity", F.round("modularity", 9))


@query(
    "g10_modularity_random",
    f"WITH e AS ({SUCCESSION_SQL}), u AS ({_UND_SQL}), p AS (SELECT {hash_sql('a')} % 2 AS cs, {hash_sql('b')} % 2 AS cd FROM u), m AS (SELECT count(*)::DOUBLE AS m FROM p), l AS (SELECT cs AS cluster, count(*) AS l FROM p WHERE cs = cd GROUP BY cs), "
    "d AS (SELECT cluster, count(*)::DOUBLE AS d FROM (SELECT cs AS cluster FROM p UNION ALL SELECT cd FROM p) GROUP BY cluster) SELECT round(sum(coalesce(l, 0) / m - (d / (2 * m)) ** 2), 9) AS modularity FROM d LEFT JOIN l USING (cluster), m",
)
def _(t):
    edges = succession(t)
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return G.modularity(edges, G.random_labels(nodes)).withColumn("modularity", F.round("modularity", 9))


_HIST_SQL = (
    "who AS (SELECT o_orderkey AS k, c_nationkey AS g FROM orders JOIN customer ON o_custkey = c_custkey), b AS (SELECT k, g, CASE WHEN lag(g) OVER w = g AND lag(k) OVER w = k - 1 THEN 0 ELSE 1 END AS fresh FROM who WINDOW w AS (ORDER BY k)), "
    "r AS (SELECT k, g, sum(fresh) OVER (ORDER BY k) AS run FROM b), z AS (SELECT g, run, count(*) AS size FROM r GROUP BY g, run HAVING count(*) > 1), "
    "h AS (SELECT g AS graph, CAST(d AS INT) AS d, CAST(sum(CASE WHEN d = 0 THEN size ELSE 2 * (size - d) END) AS BIGINT) AS n FROM (SELECT g, size, unnest(range(0, size)) AS d FROM z) GROUP BY ALL)"
)


@query("g11_sp_histogram", f"WITH {_HIST_SQL} SELECT graph, d, n FROM h")
def _(t):
    return G.sp_histogram(nation_runs(t))


@query(
    "g11_sp_kernel",
    f"WITH {_HIST_SQL} SELECT x.graph AS row, y.graph AS col, CAST(sum(x.n * y.n) AS DOUBLE) AS value FROM h x JOIN h y USING (d) GROUP BY ALL",
)
def _(t):
    from lodestar.operators.scaling import materialise

    h = materialise(G.sp_histogram(nation_runs(t)))
    return G.sp_kernel(h, h)


def _walk_sql(steps: int) -> str:
    parts = ["w0 AS (SELECT start, walk, start AS spot, CAST(start AS VARCHAR) AS path FROM (SELECT DISTINCT src AS start FROM b), (SELECT unnest([1, 2, 3]) AS walk))"]
    for i in range(1, steps):
        parts.append(
            f"w{i} AS MATERIALIZED (SELECT start, walk, dst AS spot, path || ',' || dst AS path FROM w{i - 1} JOIN d ON d.src = spot JOIN k ON k.src = spot AND k.pick = {hash_sql(f'start, walk, {i}')} % deg)"
        )
    return ", ".join(parts)


@query(
    "g13_random_walks",
    f"WITH e AS ({SUCCESSION_SQL}), b AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e), k AS MATERIALIZED (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS pick FROM b), d AS (SELECT src, count(*) AS deg FROM b GROUP BY src), "
    f"{_walk_sql(10)} SELECT start, walk, path AS nodes FROM w9",
)
def _(t):
    both = succession(t)
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    walks = G.random_walks(both, 3, 10)
    return walks.select("start", "walk", F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",").alias("nodes"))


@query("g14_node_embeddings")
def _(t):
    both = succession(t)
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    walks = G.random_walks(both, 2, 6).select(F.transform("nodes", lambda n: n.cast("string")).alias("words"))
    vectors = ML.embed(walks, "words", size=16, min_count=1)
    return vectors.select("word", F.size(_array("vector")).alias("dim"))


_TALK_SQL = "p AS (SELECT row_number() OVER () AS r, string_split(lower(text), ' ') AS l FROM conversations), t AS (SELECT r, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i FROM p)"


@query(
    "g14_cooccurrence_weights",
    f"WITH {_TALK_SQL}, c AS (SELECT a.w AS word, b.w AS context, count(*) AS n FROM t a JOIN t b ON a.r = b.r AND a.i <> b.i AND abs(a.i - b.i) <= 3 GROUP BY ALL), s0 AS (SELECT word FROM c GROUP BY word HAVING sum(n) >= 30), "
    "k AS MATERIALIZED (SELECT * FROM c WHERE word IN (SELECT word FROM s0) AND context IN (SELECT word FROM s0)), s AS (SELECT word, sum(n) AS s FROM k GROUP BY word), "
    "f AS (SELECT k.word, k.context, ln(n * (SELECT sum(n) FROM k)::DOUBLE / (a.s::DOUBLE * b.s)) - ln(2) AS weight FROM k JOIN s a ON a.word = k.word JOIN s b ON b.word = k.context) SELECT word, context, round(weight, 7) AS weight FROM f WHERE weight > 0",
)
def _(t):
    talk = t.conversations.select(F.split(F.lower("text"), " ").alias("words"))
    return WV.shifted_weights(WV.cooccurrence(talk, "words", 3), 2.0, 30).select("word", "context", F.round("weight", 7).alias("weight"))


@query("g14_node_vectors")
def _(t):
    both = succession(t)
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    walks = G.random_walks(both, 2, 6).select(F.transform("nodes", lambda n: n.cast("string")).alias("words"))
    return WV.word_vectors(walks, "words", size=16).select("word", F.transform("vector", lambda x: F.round(x, 5)).alias("vector"))


def _array(column):
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(column)


@query(
    "g14_most_similar",
    "WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_inner_product(e, e))) AS e FROM v), g AS (SELECT list_transform(range(1, 65), lambda i: a.e[i] + c.e[i] - b.e[i]) AS g FROM u a, u b, u c WHERE a.vec_id = 0 AND c.vec_id = 2 "
    "AND b.vec_id = 1) SELECT vec_id, round(list_inner_product(e, g) / sqrt(list_inner_product(g, g)), 9) AS similarity FROM u, g WHERE vec_id NOT IN (0, 1, 2) ORDER BY similarity DESC, vec_id LIMIT 10",
)
def _(t):
    vectors = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return N.most_similar(vectors, [0, 2], [1], 10, "vec_id")


@query(
    "g15_graph_match",
    "SELECT o_orderkey AS src, 'Order ' || o_orderpriority AS src_name, 1000000000 + o_custkey AS dst, c_name AS dst_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def _(t):
    from lodestar.sources.readers import load_relations

    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.array(F.lit("Order")).alias("labels"), F.concat(F.lit("Order "), "o_orderpriority").alias("name"))
    people = t.customer.select(
        (F.col("c_custkey") + 1000000000).alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("Client"), F.lit("Builder"))).otherwise(F.array(F.lit("Client"))).alias("labels"), F.col("c_name").alias("name")
    )
    relations = load_relations(t.orders.select("o_orderkey", (F.col("o_custkey") + 1000000000).alias("c")), "o_orderkey", "c", "PLACED_BY")
    return G.graph_match(orders.unionByName(people), relations, "PLACED_BY", "Order", "Builder")


@query("g15_find_nodes", "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_name IN ('Customer#000000007', 'Customer#000000100')")
def _(t):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.array(F.lit("Person")).alias("labels"), F.col("c_name").alias("name"))
    return G.find_nodes(people, "Person", ["Customer#000000007", "Customer#000000100"]).select("id", "name")


