"""Graphs and ratings derived from the given tables, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SUCCESSION_SQL = (
    "SELECT DISTINCT a.o_custkey AS src, b.o_custkey AS dst FROM orders a JOIN orders b "
    "ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey"
)
RUNS_SQL = (
    "SELECT a.o_orderkey AS src, b.o_orderkey AS dst FROM orders a JOIN orders b "
    "ON b.o_orderkey = a.o_orderkey + 1 AND b.o_orderstatus = a.o_orderstatus"
)
RATINGS_SQL = (
    "SELECT o_custkey AS \"user\", l_partkey AS item, avg(l_quantity) AS rating FROM orders JOIN lineitem "
    "ON o_orderkey = l_orderkey GROUP BY ALL"
)


def _next_order(t) -> DataFrame:
    a = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    b = a.select(
        (F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("next_cust"),
        F.col("o_orderstatus").alias("next_status"), F.col("o_orderkey").alias("next_order"),
    )
    return a.join(b, "o_orderkey")


def succession(t) -> DataFrame:
    """Customer of an order to the customer of the next order, by order key."""
    pairs = _next_order(t).where(F.col("o_custkey") != F.col("next_cust"))
    return pairs.select(F.col("o_custkey").alias("src"), F.col("next_cust").alias("dst")).distinct()


def status_runs(t) -> DataFrame:
    """Neighbouring orders of equal status: many chains of different length."""
    pairs = _next_order(t).where(F.col("o_orderstatus") == F.col("next_status"))
    return pairs.select(F.col("o_orderkey").alias("src"), F.col("next_order").alias("dst"))


def nation_runs(t) -> DataFrame:
    """Neighbouring orders of customers of one nation, the nation being the graph."""
    who = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    nxt = who.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("c_nationkey").alias("n2"))
    pairs = who.join(nxt, "o_orderkey").where(F.col("c_nationkey") == F.col("n2"))
    return pairs.select(
        F.col("c_nationkey").alias("graph"), F.col("o_orderkey").alias("src"), (F.col("o_orderkey") + 1).alias("dst")
    )


def ratings(t) -> DataFrame:
    """Customer, part and mean quantity, one row per pair."""
    pairs = t.orders.select("o_orderkey", "o_custkey").join(
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return pairs.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(
        F.avg("l_quantity").alias("rating")
    )
