"""Mixing sources to target weights by a hierarchical token budget.

Documents are leaves of a tree (by default domain, language, source). A budget of tokens goes down the tree by
weight. A node that cannot take its share (its documents, counted up to ``max_epochs`` times, are fewer) leaves the rest to
its siblings by their weights, and only when all of them are full does it go to the siblings of its ancestors. Giving
each node at most its capacity from the top does just that: among the children of a node the full ones are those with
the smallest capacity per weight, which one ordered running sum finds.

A leaf repeats its documents for as many whole epochs as its budget holds and takes a prefix of the next epoch, in
an order that is an MD5 of seed, epoch and id. The longest prefix within the rest of the budget is found without
sorting a leaf: tokens are summed per leaf and hash bucket, and only the bucket that holds the end is put in order.

The tree and the ends of the prefixes are tables with one row per leaf. They are broadcast only if they have at
most ``BROADCAST_LEAVES`` rows; texts are never shuffled in that case.

Defined results: a null level is the value ``unknown``; a value without a weight has weight 1, one with weight 0 or less
gets nothing; a document without words is never taken; rows that repeat an id in a leaf stand or fall together;
a budget above the capacity takes everything ``max_epochs`` times; an empty table gives no rows; columns of the
documents are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import store

BROADCAST_LEAVES = 65_536
BUCKET_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _weight(value: Column, weights: Mapping[str, float]) -> Column:
    out = F.lit(1.0)
    for name, number in weights.items():
        out = F.when(value == name, F.lit(float(number))).otherwise(out)
    return F.greatest(out, F.lit(0.0))


def share_out(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """``target`` for rows ``(parent..., name, weight, capacity, budget)``: the parent's budget by weight, none above
    its capacity, what is left over going to the others."""
    order = [F.col("capacity") / F.col("weight"), F.col(name)]
    by = Window.partitionBy(*parent)
    line = by.orderBy(*order)
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(0, Window.unboundedFollowing)
    open_rows = children.where((F.col("weight") > 0) & (F.col("capacity") > 0))
    level = (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    sized = open_rows.withColumn("level", level).withColumn("full", F.col("capacity") <= F.col("level") * F.col("weight"))
    # the level of the first child that is not full holds for all that are not
    first = F.min(F.when(~F.col("full"), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], "level"))).over(by)
    return sized.withColumn("open_level", first["level"]).withColumn(
        "target", F.when(F.col("full"), F.col("capacity")).otherwise(F.col("open_level") * F.col("weight"))
    )


def leaf_targets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: float, max_epochs: int
) -> DataFrame:
    """``levels..., tokens, target`` for leaves ``levels..., tokens``."""
    # a subtree of weight 0 has no capacity
    usable = F.lit(True)
    for level in levels:
        usable = usable & (_weight(F.col(level), weights.get(level, {})) > 0)
    caps = leaves.withColumn(
        "capacity", F.when(usable, F.col("tokens") * F.lit(float(max_epochs))).otherwise(F.lit(0.0))
    )
    total = caps.agg(F.sum("capacity")).first()[0] or 0.0
    given = None
    for depth, level in enumerate(levels):
        keys = list(levels[: depth + 1])
        nodes = caps.groupBy(*keys).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        if given is None:
            nodes = nodes.withColumn("_root", F.lit(0)).withColumn("budget", F.lit(min(float(budget), float(total))))
            parent = ["_root"]
        else:
            nodes, parent = nodes.join(given, keys[:-1]), keys[:-1]
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights.get(level, {})))
        shared = share_out(nodes, parent, level)
        given = shared.select(*keys, "tokens", "target") if depth == len(levels) - 1 else shared.select(
            *keys, F.col("target").alias("budget")
        )
    return given


def seeded_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    ident = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), ident))


def plan(
    docs: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, float]],
    share: float,
    max_epochs: int,
    seed: int,
) -> DataFrame:
    """One row per leaf: ``levels..., tokens, target, whole`` epochs and the last key and id of the prefix, for
    documents ``doc_id, levels..., tokens``; the budget is ``share`` of all tokens."""
    leaves = store(docs.groupBy(*levels).agg(F.sum("tokens").alias("tokens")))
    budget = (leaves.agg(F.sum("tokens")).first()[0] or 0) * share
    targets = leaf_targets(leaves, levels, weights, budget, max_epochs)
    whole = F.least(F.floor(F.col("target") / F.col("tokens")), F.lit(max_epochs)).cast("long")
    rest = F.when(F.col("whole") < max_epochs, F.floor(F.col("target") - F.col("whole") * F.col("tokens"))).otherwise(0)
    targets = store(targets.withColumn("whole", whole).withColumn("rest", rest.cast("long")))
    targets = limited(targets)
    keyed = docs.join(targets.select(*levels, "whole", "rest"), list(levels)).where("rest > 0").select(
        *levels, "doc_id", "tokens", "rest", seeded_key(seed, F.col("whole") + 1, F.col("doc_id")).alias("key")
    )
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    buckets = keyed.groupBy(*levels, "bucket").agg(F.sum("tokens").alias("sum"), F.max("rest").alias("rest"))
    line = Window.partitionBy(*levels).orderBy("bucket")
    ends = (
        buckets.withColumn("until", F.sum("sum").over(line))
        .withColumn("before", F.col("until") - F.col("sum"))
        .where((F.col("before") <= F.col("rest")) & (F.col("until") > F.col("rest")))
        .groupBy(*levels)
        .agg(F.min(F.struct("bucket", "before")).alias("end"))
        .select(*levels, F.col("end.bucket").alias("end_bucket"), F.col("end.before").alias("before"))
    )
    ends = limited(store(ends))
    within = Window.partitionBy(*levels).orderBy("key", "doc_id")
    last = (
        keyed.join(ends, list(levels))
        .where(F.col("bucket") == F.col("end_bucket"))
        .withColumn("sum", F.sum("tokens").over(within) + F.col("before"))
        .groupBy(*levels)
        .agg(F.max(F.when(F.col("sum") <= F.col("rest"), F.struct("key", F.coalesce("doc_id", F.lit(-1)).alias("id")))).alias("last"))
    )
    return store(
        targets.join(ends, list(levels), "left")
        .join(last, list(levels), "left")
        .select(*levels, "tokens", "target", "whole", "rest", "end_bucket", F.col("last.key").alias("last_key"), F.col("last.id").alias("last_id"))
    )


def limited(table: DataFrame) -> DataFrame:
    """A table with one row per leaf, broadcast if it is known to be small."""
    return F.broadcast(table) if table.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES else table


def copies(leaf: DataFrame, seed: int) -> Column:
    """How often a document with columns ``_id, _tokens`` is taken under its leaf's row of the plan."""
    key = seeded_key(seed, leaf["whole"] + 1, F.col("_id"))
    bucket = F.substring(key, 1, BUCKET_DIGITS)
    ident = F.coalesce(F.col("_id"), F.lit(-1))
    last = (key < leaf["last_key"]) | ((key == leaf["last_key"]) & (ident <= leaf["last_id"]))
    # no end bucket: the rest holds the whole epoch
    inside = F.when(leaf["end_bucket"].isNull() | (bucket < leaf["end_bucket"]), F.lit(True)).otherwise(
        (bucket == leaf["end_bucket"]) & F.coalesce(last, F.lit(False))
    )
    prefix = F.when((leaf["rest"] > 0) & inside, F.lit(1)).otherwise(F.lit(0))
    return F.when(F.col("_tokens") > 0, leaf["whole"] + prefix).otherwise(F.lit(0)).cast("int")


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, float]],
    share: float = 0.5,
    max_epochs: int = 2,
    seed: int = 11,
    epoch: str | None = None,
) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` that are taken, once per epoch; with ``epoch`` its number is added."""
    names = [f"_level{i}" for i in range(len(levels))]
    by_name = {n: weights.get(level, {}) for n, level in zip(names, levels)}
    values = [F.coalesce(c.cast("string"), F.lit("unknown")).alias(n) for n, c in zip(names, levels.values())]
    sized = docs.select(F.col("doc_id"), *values, count_words(F.col("text")).alias("tokens")).where("tokens > 0")
    leaf = limited(plan(store(sized), names, by_name, share, max_epochs, seed))
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), *values, F.col("doc_id").alias("_id"),
                        count_words(F.col("text")).alias("_tokens"))
    taken = (
        given.join(leaf, names)
        .withColumn("_copies", copies(leaf, seed))
        .where("_copies > 0")
        .withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    )
    out = [F.col("_doc")[c].alias(c) for c in docs.columns]
    return taken.select(*out, *([F.col("_epoch").alias(epoch)] if epoch else []))
