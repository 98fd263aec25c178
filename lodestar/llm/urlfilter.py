"""URL filter lists over time: every capture is judged by the list as it stood when it was fetched
(DataFrame functions only).

A list is a table of dated events ``pattern, verdict, day``; verdict ``block`` or ``allow`` sets the pattern,
``remove`` ends it. Events of a pattern become half-open validity intervals; each capture is joined as of its
fetch day with the intervals of its host suffixes and path prefixes, and the longest active pattern decides.

A pattern without ``/`` is a domain (it covers its subdomains); one with ``/`` is a host and a path prefix
that ends at a ``/`` or is the whole path.

The join key is the pattern and a bucket of days, so a pattern with a long history meets only the
intervals of the capture's own bucket. No side is gathered: a hot host is a skewed equi-join that adaptive
execution splits, and equal captures are counted before any shuffle.

Defined results: repeated rows each get their row; a null or unparsable URL and a null day match nothing and
are kept; events with a null pattern, verdict or day are ignored; several events of one pattern on one day
count as the strictest (block, then allow, then remove); an empty list keeps every capture; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DAYS = 64
_RANK = {"remove": 0, "allow": 1, "block": 2}
_EPOCH = "1970-01-01"


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty if there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def intervals(events: DataFrame) -> DataFrame:
    """``pattern, verdict, since, until`` (until is null while the entry stands)."""
    rank = F.coalesce(*[F.when(F.col("verdict") == v, F.lit(r)) for v, r in _RANK.items()])
    daily = (
        events.select("pattern", rank.alias("rank"), F.col("day").cast("date").alias("since"))
        .dropna()
        .groupBy("pattern", "since")
        .agg(F.max("rank").alias("rank"))
    )
    follow = Window.partitionBy("pattern").orderBy("since")
    names = F.element_at(F.array(*[F.lit(v) for v in _RANK]), F.col("rank") + 1)
    return (
        daily.withColumn("until", F.lead("since").over(follow))
        .where(F.col("rank") > 0)
        .select("pattern", names.alias("verdict"), "since", "until")
    )


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit(_EPOCH).cast("date")) / days).cast("int")


def _suffixes(host: Column, most: int) -> Column:
    labels = F.split(host, r"\.")
    size = F.size(labels)
    first = F.greatest(F.lit(1), size - most + 1)
    return F.transform(F.sequence(first, size), lambda i: F.array_join(F.slice(labels, i, size), "."))


def _prefixes(host: Column, path: Column, most: int) -> Column:
    """``host/``, ``host/a/`` ... up to ``most`` slashes, and the whole path where it is not deeper."""
    parts = F.slice(F.split(path, "/", most + 2), 1, most + 1)
    n = F.size(parts) - 1
    steps = F.when(
        n >= 1,
        F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(host, F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    whole = F.when((slashes >= 1) & (slashes <= most), F.array(F.concat(host, path))).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_distinct(F.concat(steps, whole))


def evaluate(captures: DataFrame, list_events: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """``page_id, url, fetched_on, host, n_active, pattern, decision`` for captures ``page_id, url, fetched_on``."""
    active = intervals(list_events)
    bounds = active.agg(
        F.max(F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))).alias("labels"),
        F.max(F.length("pattern") - F.length(F.replace("pattern", F.lit("/"), F.lit("")))).alias("slashes"),
    ).first()
    labels, slashes = bounds["labels"] or 1, bounds["slashes"] or 0
    span = captures.agg(F.max(F.col("fetched_on").cast("date")).alias("last")).first()["last"]
    counted = (
        captures.select("page_id", "url", F.col("fetched_on").cast("date").alias("fetched_on"))
        .groupBy("page_id", "url", "fetched_on")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("host", host_of(F.col("url")))
    )
    keys = F.when(
        F.col("host") != "",
        F.concat(_suffixes(F.col("host"), labels), _prefixes(F.col("host"), path_of(F.col("url")), slashes)),
    )
    asked = counted.withColumn("key", F.explode_outer(keys)).withColumn(
        "bucket", _bucket(F.col("fetched_on"), bucket_days)
    )
    end = F.least(F.coalesce(F.date_sub("until", 1), F.lit(span).cast("date")), F.lit(span).cast("date"))
    listed = (
        active.where(F.col("since") <= F.lit(span).cast("date"))
        .withColumn("l_bucket", F.explode(F.sequence(_bucket(F.col("since"), bucket_days), _bucket(end, bucket_days))))
        .withColumnRenamed("pattern", "l_pattern")
    )
    valid = (
        (F.col("key") == F.col("l_pattern"))
        & (F.col("bucket") == F.col("l_bucket"))
        & (F.col("since") <= F.col("fetched_on"))
        & (F.col("until").isNull() | (F.col("fetched_on") < F.col("until")))
    )
    judged = (
        asked.join(listed, valid, "left")
        .groupBy("page_id", "url", "fetched_on", "host", "copies")
        .agg(
            F.count("l_pattern").alias("n_active"),
            F.max(F.when(F.col("l_pattern").isNotNull(), F.struct(F.length("l_pattern"), "l_pattern", "verdict"))).alias("best"),
        )
    )
    decision = F.when(F.col("best.verdict") == "block", F.lit("block")).otherwise(F.lit("keep"))
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(
        "page_id", "url", "fetched_on", "host", "n_active", F.col("best.l_pattern").alias("pattern"), decision.alias("decision")
    )
