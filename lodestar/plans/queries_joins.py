"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import joins as J
from lodestar.plans.registry import query


@query("j01_inner_pairs", "SELECT o_custkey, l_partkey, count(*) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def _(t):
    left = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey")
    right = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_partkey")
    return J.join_tables(left, right, "key").groupBy("o_custkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j02_inner_tables",
    "SELECT n_name, c_mktsegment, o_orderpriority, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL",
)
def _(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("v"))
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderpriority")
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    wide = J.join_tables(J.join_tables(J.join_tables(lines, orders, "o_orderkey"), t.customer, "c_custkey"), nation, "c_nationkey")
    return wide.groupBy("n_name", "c_mktsegment", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 4).alias("revenue"))


_STAR_SQL = (
    "WITH m AS (SELECT o_orderkey AS id, o_totalprice AS v FROM orders), l AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS par, l_suppkey AS loc FROM lineitem WHERE l_quantity > 25), "
    "p AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS par, p_brand AS commune FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_discount > 0.02), "
    "a AS (SELECT s_suppkey AS loc, s_name AS street FROM supplier WHERE s_acctbal > 0), c AS (SELECT p_brand AS commune, count(*) AS pop FROM part GROUP BY p_brand HAVING count(*) > 70) "
    "SELECT coalesce(commune, 'none') AS commune, count(*) AS n, count(par) AS with_local, count(street) AS with_street, count(pop) AS with_pop, round(sum(v), 2) AS value FROM m LEFT JOIN l USING (id) "
    "LEFT JOIN p USING (id, par) LEFT JOIN a USING (loc) LEFT JOIN c USING (commune) GROUP BY ALL"
)


@query("j03_denormalise", _STAR_SQL)
def _(t):
    mutation = t.orders.select(F.col("o_orderkey").alias("idmutation"), F.col("o_totalprice").alias("valeurfonc"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("idmutation"), F.col("l_partkey").alias("iddispopar"), F.col("l_suppkey").alias("iddispoloc"), "l_quantity", "l_discount"
    )
    local = lines.where("l_quantity > 25").select("idmutation", "iddispopar", "iddispoloc").distinct()
    brand = t.part.select(F.col("p_partkey").alias("iddispopar"), F.col("p_brand").alias("commune"))
    parcelle = lines.where("l_discount > 0.02").join(brand, "iddispopar").select("idmutation", "iddispopar", "commune").distinct()
    adresse = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("iddispoloc"), F.col("s_name").alias("street"))
    commune = t.part.groupBy(F.col("p_brand").alias("commune")).agg(F.count(F.lit(1)).alias("pop")).where("pop > 70")
    wide = J.denormalise(mutation, local, parcelle, adresse, commune)
    return wide.groupBy(F.coalesce("commune", F.lit("none")).alias("commune")).agg(
        F.count(F.lit(1)).alias("n"), F.count("iddispopar").alias("with_local"), F.count("street").alias("with_street"),
        F.count("pop").alias("with_pop"), F.round(F.sum("valeurfonc"), 2).alias("value"),
    )


@query(
    "j04_merge_predictions",
    "SELECT doc_id, CAST(length(text) > 1000 AS INT) AS long_pred, coalesce(quality, -1) AS good_pred FROM documents LEFT JOIN labels USING (doc_id)",
)
def _(t):
    long = t.documents.select("doc_id", (F.length("text") > 1000).cast("int").alias("prediction"))
    good = t.labels.select("doc_id", F.col("quality").alias("prediction"))
    merged = J.merge_predictions(t.documents.select("doc_id"), {"long": long, "good": good}, "doc_id")
    return merged.withColumn("good_pred", F.coalesce("good_pred", F.lit(-1)))


@query(
    "j05_attach_counts",
    "SELECT l_orderkey, l_partkey, l_linenumber, lines, returned, accepted, bulk, cheap FROM lineitem JOIN (SELECT l_orderkey, count(*) AS lines, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS returned, "
    "count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS accepted, count(CASE WHEN l_quantity > 40 THEN 1 END) AS bulk, count(CASE WHEN l_extendedprice < 20000 THEN 1 END) AS cheap FROM lineitem GROUP BY "
    "l_orderkey) USING (l_orderkey)",
)
def _(t):
    tests = {
        "lines": F.lit(True), "returned": F.col("l_returnflag") == "R", "accepted": F.col("l_returnflag") == "A",
        "bulk": F.col("l_quantity") > 40, "cheap": F.col("l_extendedprice") < 20000,
    }
    return J.attach_counts(t.lineitem, "l_orderkey", tests).select("l_orderkey", "l_partkey", "l_linenumber", *tests)


@query("j06_enrich", "SELECT c_custkey, c_name, n_name, n_regionkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    dim = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return J.enrich(t.customer, dim, "c_nationkey", ["n_name", "n_regionkey"]).select("c_custkey", "c_name", "n_name", "n_regionkey")


_DAYS = "SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL"


@query(
    "j07_left_two_keys",
    f"WITH x AS ({_DAYS}) SELECT event_id, coalesce(n, 0) AS errors FROM events e LEFT JOIN x ON e.user_id = x.user_id AND CAST(e.ts AS DATE) = x.d",
)
def _(t):
    e = t.events.select("event_id", "event_type", "user_id", F.to_date("ts").alias("d"))
    errors = e.where("event_type = 'error'").groupBy("user_id", "d").agg(F.count(F.lit(1)).alias("n"))
    return J.join_tables(e, errors, ["user_id", "d"], "left").select("event_id", F.coalesce("n", F.lit(0)).alias("errors"))


@query(
    "j08_events_in_window",
    f"WITH x AS ({_DAYS}) SELECT event_id, CAST(coalesce((SELECT sum(n) FROM x WHERE x.user_id = e.user_id AND CAST(e.ts AS DATE) - x.d BETWEEN 0 AND 2), 0) AS BIGINT) AS n_events FROM events e",
)
def _(t):
    errors = t.events.where("event_type = 'error'").select("user_id", "ts")
    return J.events_in_window(t.events.select("event_id", "user_id", "ts"), errors, "user_id", "ts").select("event_id", "n_events")


@query(
    "j09_align",
    "WITH a AS (SELECT p_size AS k, count(*) AS n FROM part WHERE p_size < 40 GROUP BY p_size), b AS (SELECT CAST(l_quantity AS INT) AS k, count(*) AS m FROM lineitem WHERE l_quantity > 10 GROUP BY ALL) "
    "SELECT k, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM a FULL JOIN b USING (k)",
)
def _(t):
    a = t.part.where("p_size < 40").groupBy(F.col("p_size").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t.lineitem.where("l_quantity > 10").groupBy(F.col("l_quantity").cast("int").alias("k")).agg(F.count(F.lit(1)).alias("m"))
    return J.align(a, b, "k").na.fill(0)


@query(
    "j09_add_aligned",
    "WITH a AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL), b AS (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY ALL) "
    "SELECT user_id, CAST(a.n + b.n AS DOUBLE) AS n FROM a FULL JOIN b USING (user_id)",
)
def _(t):
    side = lambda kind: t.events.where(F.col("event_type") == kind).groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return J.add_aligned(side("error"), side("purchase"), "user_id", "n")


@query(
    "j10_group_max_self",
    "SELECT p_partkey, p_brand, p_size FROM part WHERE (p_brand, p_size) IN (SELECT p_brand, max(p_size) FROM part GROUP BY p_brand)",
)
def _(t):
    from lodestar.operators.rows import group_max_rows

    return group_max_rows(t.part, "p_brand", "p_size").select("p_partkey", "p_brand", "p_size")


@query("j11_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return J.anti(t.customer.select("c_custkey"), urgent, "c_custkey")


@query("j12_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(t):
    rich = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi(t.customer.select("c_custkey", "c_name"), rich, "c_custkey")
