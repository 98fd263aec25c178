"""Aggregations and metrics."""

from __future__ import annotations

import string
from statistics import NormalDist

from pyspark.sql import functions as F

from lodestar.operators import aggregates as A
from lodestar.operators import metrics as M
from lodestar.plans.queries_rows import hash_sql
from lodestar.plans.registry import query

STOP = ("the", "and", "of", "to", "in", "a", "is", "that", "for", "it", "as", "on", "with", "by", "at", "are", "an", "be", "de", "der", "die", "das")
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
_PUNCT_SQL = "'" + string.punctuation.replace("'", "''") + "'"
PLAIN_SQL = f"translate(text, {_PUNCT_SQL}, '')"
WORDS_SQL = "SELECT unnest(string_split_regex({}, '[ \\t\\n\\f\\r\\x0B]+')) AS word FROM {}"


def words_sql(expr: str = "text", table: str = "documents") -> str:
    return f"SELECT word FROM ({WORDS_SQL.format(expr, table)}) WHERE word <> ''"


@query("a01_line_count", "SELECT count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) FROM documents)")
def _(t):
    return A.line_count(t.documents.select(F.explode(F.split("text", "\n")).alias("value")))


@query("a02_word_count", f"SELECT word, count(*) AS n FROM ({words_sql()}) GROUP BY word")
def _(t):
    return A.word_count(t.documents, "text")


@query(
    "a03_word_count_long_top",
    f"SELECT word, count(*) AS n FROM (SELECT unnest(string_split({PLAIN_SQL}, ' ')) AS word FROM documents) WHERE length(word) > 3 "
    "GROUP BY word ORDER BY n DESC, word LIMIT 10",
)
def _(t):
    return A.word_count(t.documents, "text", mode="space", punct=False, min_len=4, top=10)


@query(
    "a04_word_count_initials",
    f"SELECT word, count(*) AS n FROM ({words_sql(PLAIN_SQL)}) WHERE word[1] IN ('a', 'b', 'c', 'd') AND word NOT IN {STOP_SQL} GROUP BY word",
)
def _(t):
    return A.word_count_initials(t.documents, "text", STOP)


@query(
    "a05_bigram_count",
    "WITH l AS (SELECT unnest(string_split(text, chr(10))) AS text FROM documents), "
    f"w AS (SELECT regexp_split_to_array(trim(regexp_replace({PLAIN_SQL}, '[ \\t\\n\\f\\r\\x0B]+', ' ', 'g')), ' ') AS ws FROM l), "
    "p AS (SELECT ws[i] AS a, ws[i + 1] AS b FROM (SELECT ws, unnest(range(1, len(ws))) AS i FROM w)) "
    f"SELECT a || ' ' || b AS bigram, count(*) AS n FROM p WHERE a[1] IN ('a', 'b', 'c', 'd') AND a NOT IN {STOP_SQL} GROUP BY ALL",
)
def _(t):
    return A.bigram_count(t.documents, "text", STOP)


@query(
    "a06_mean_word_length",
    f"SELECT word[1] AS letter, round(avg(length(word)), 9) AS mean_length FROM ({words_sql()}) WHERE regexp_matches(word[1], '^[A-Z]$') GROUP BY ALL",
)
def _(t):
    return A.mean_word_length(t.documents, "text").withColumn("mean_length", F.round("mean_length", 9))


@query("a07_max_by_key", "SELECT year(o_orderdate)::INT AS year, max(o_totalprice) AS max_value FROM orders GROUP BY 1")
def _(t):
    return A.max_by_key(t.orders.select(F.year("o_orderdate").alias("year"), "o_totalprice"), "year", "o_totalprice")


@query("a08_link_count", "SELECT l_suppkey AS src, count(*) AS links FROM lineitem GROUP BY l_suppkey")
def _(t):
    return A.link_count(t.lineitem.select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst")))


@query(
    "a09_weighted_degree",
    "WITH e AS (SELECT 'S' || l_suppkey AS src, 'P' || l_partkey AS dst, l_discount * 10 AS w FROM lineitem WHERE l_discount * 10 >= 0.6) "
    "SELECT node, round(sum(w), 6) AS weight FROM (SELECT src AS node, w FROM e UNION ALL SELECT dst, w FROM e) GROUP BY node HAVING sum(w) > 1",
)
def _(t):
    edges = t.lineitem.select(
        F.concat(F.lit("S"), "l_suppkey").alias("src"), F.concat(F.lit("P"), "l_partkey").alias("dst"), (F.col("l_discount") * 10).alias("w")
    )
    return A.weighted_degree(edges).withColumn("weight", F.round("weight", 6))


@query(
    "a10_inverted_index",
    "WITH w AS (SELECT DISTINCT doc_id, unnest(string_split_regex(text, '[ \\t\\n\\f\\r\\x0B]+')) AS word FROM documents), "
    f"k AS (SELECT CAST(ceil(count(DISTINCT doc_id) / 10000) AS BIGINT) AS parts FROM documents) SELECT word, CAST({hash_sql('doc_id')} % parts AS INT) AS part, "
    "string_agg(doc_id, ',' ORDER BY doc_id) AS docs FROM w, k WHERE word <> '' GROUP BY ALL",
)
def _(t):
    return A.inverted_index(t.documents, "doc_id", "text")


@query(
    "a10_inverted_index_names",
    "WITH w AS (SELECT DISTINCT 'page' || conv_id || '.txt' AS name, unnest(string_split_regex(text, '[ \\t\\n\\f\\r\\x0B]+')) AS word FROM conversations), "
    f"k AS (SELECT CAST(ceil(count(DISTINCT conv_id) / 100) AS BIGINT) AS parts FROM conversations) SELECT word, CAST({hash_sql('name')} % parts AS INT) AS part, "
    "string_agg(name, ',' ORDER BY name) AS docs FROM w, k WHERE word <> '' GROUP BY ALL",
)
def _(t):
    files = t.conversations.select(F.format_string("page%d.txt", "conv_id").alias("name"), "text")
    return A.inverted_index(files, "name", "text", chunk=100)


@query(
    "a11_pair_count",
    "SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS n FROM (SELECT x.p_brand AS a, y.p_brand AS b FROM lineitem JOIN part x ON "
    "l_partkey = x.p_partkey JOIN part y ON y.p_partkey = l_suppkey) GROUP BY ALL",
)
def _(t):
    own = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("x"))
    other = t.part.select(F.col("p_partkey").alias("l_suppkey"), F.col("p_brand").alias("y"))
    pairs = t.lineitem.select("l_partkey", "l_suppkey").join(own, "l_partkey").join(other, "l_suppkey")
    return A.pair_count(pairs, "x", "y")


@query(
    "a11_basket_pairs",
    "WITH i AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT x.l_suppkey AS a, y.l_suppkey AS b, count(*) AS n "
    "FROM i x JOIN i y ON x.l_orderkey = y.l_orderkey AND x.l_suppkey < y.l_suppkey GROUP BY ALL",
)
def _(t):
    return A.pair_count(A.basket_pairs(t.lineitem, "l_orderkey", "l_suppkey"), "a", "b")


@query(
    "a16_column_product",
    "SELECT round(exp(sum(ln(1 + l_discount / 1000))), 6) AS product FROM lineitem",
)
def _(t):
    growth = t.lineitem.select((F.lit(1) + F.col("l_discount").cast("double") / 1000).alias("v"))
    return A.column_product(growth, "v").select(F.round("product", 6).alias("product"))


@query(
    "a12_group_agg",
    "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum, round(avg(l_quantity), 6) AS mean, max(l_quantity) AS max, "
    "min(l_quantity) AS min, count(l_quantity) AS count, count(*) AS size FROM lineitem GROUP BY ALL",
)
def _(t):
    out = A.group_agg(t.lineitem, ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.withColumns({"sum": F.round("sum", 2), "mean": F.round("mean", 6)})


@query(
    "a12_pivot_totals",
    "SELECT coalesce(l_returnflag, 'All') AS flag, coalesce(l_linestatus, 'All') AS status, round(sum(l_quantity), 2) AS qty FROM lineitem "
    "GROUP BY CUBE (l_returnflag, l_linestatus)",
)
def _(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty")).select(
        F.coalesce("l_returnflag", F.lit("All")).alias("flag"), F.coalesce("l_linestatus", F.lit("All")).alias("status"), "qty"
    )


@query(
    "a13_group_by_expr",
    "SELECT CAST(l_quantity < 18 AS INT) AS small, round(avg(l_extendedprice), 4) AS mean, count(*) AS size FROM lineitem GROUP BY ALL",
)
def _(t):
    out = A.group_by_expr(t.lineitem, (F.col("l_quantity") < 18).cast("int"), "l_extendedprice", "small")
    return out.withColumn("mean", F.round("mean", 4))


@query("a14_value_counts", "SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def _(t):
    return A.value_counts(t.events, "event_type")


@query("a15_count_by", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL")
def _(t):
    return A.count_by(t.part, "p_brand", "p_type")


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "a16_numeric_summary",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(var_pop({c}), 4) AS variance, round(stddev_pop({c}), 6) AS std, "
        f"min({c}) AS min, max({c}) AS max, round(sum({c}), 2) AS sum, round(median({c}), 6) AS median FROM lineitem"
        for c in _NUMBERS
    ),
)
def _(t):
    out = A.numeric_summary(t.lineitem, _NUMBERS)
    digits = {"mean": 6, "variance": 4, "std": 6, "sum": 2, "median": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query(
    "a17_describe_table",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(count(*) - count({c}) AS BIGINT) AS nulls, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, "
        f"round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3 FROM orders"
        for c in ("o_orderkey", "o_custkey", "o_totalprice")
    ),
)
def _(t):
    out = A.describe_table(t.orders)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q1", "median", "q3")})


@query("a17_table_shape", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def _(t):
    return A.table_shape(t.lineitem)


@query(
    "a18_histogram",
    "SELECT least(CAST(floor((o_totalprice - lo) / ((hi - lo) / 50)) AS INT), 49) AS bin, count(*) AS n FROM orders, (SELECT min(o_totalprice) AS lo, "
    "max(o_totalprice) AS hi FROM orders) GROUP BY ALL",
)
def _(t):
    return A.histogram(t.orders, "o_totalprice", 50)


@query(
    "a19_threshold_report",
    "SELECT CAST(t AS DOUBLE) AS threshold, count(CASE WHEN o_totalprice < t THEN 1 END) AS kept, count(CASE WHEN o_totalprice >= t THEN 1 END) AS removed, "
    "round(count(CASE WHEN o_totalprice >= t THEN 1 END) / nullif(count(CASE WHEN o_totalprice < t THEN 1 END), 0) * 100, 6) AS removed_pct "
    "FROM orders, (SELECT unnest([400000, 300000, 200000, 100000]) AS t) GROUP BY t",
)
def _(t):
    out = A.threshold_report(t.orders, "o_totalprice", [400000, 300000, 200000, 100000])
    return out.withColumn("removed_pct", F.round("removed_pct", 6))


@query(
    "a19_box_statistics",
    "SELECT o_orderpriority, count(*) AS n, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 4) AS q1, "
    "round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(quantile_cont(o_totalprice, 0.75), 4) AS q3, max(o_totalprice) AS max FROM orders "
    "GROUP BY o_orderpriority",
)
def _(t):
    out = A.box_statistics(t.orders, "o_totalprice", ["o_orderpriority"])
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query(
    "a20_bbox",
    "SELECT min(embedding[1]) AS min_lon, max(embedding[1]) AS max_lon, min(embedding[2]) AS min_lat, max(embedding[2]) AS max_lat FROM embeddings",
)
def _(t):
    return A.bbox(t.embeddings.select(F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y")), "x", "y")


@query(
    "a21_argmax_rows",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey = (SELECT l_orderkey FROM lineitem ORDER BY "
    "l_extendedprice DESC, l_orderkey LIMIT 1)",
)
def _(t):
    return A.argmax_rows(t.lineitem, "l_extendedprice", "l_orderkey").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")


def _corr_sql(function: str, table: str, columns, digits: int) -> str:
    cells = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round({function}({a}, {b}), {digits}) AS value FROM {table}" for a, b in cells)


@query("a22_corr_matrix", _corr_sql("corr", "lineitem", _NUMBERS, 7))
def _(t):
    return A.corr_matrix(t.lineitem, _NUMBERS).withColumn("value", F.round("value", 7))


@query("a22_covariance_matrix", _corr_sql("covar_samp", "lineitem", _NUMBERS, 4))
def _(t):
    return A.corr_matrix(t.lineitem, _NUMBERS, "covariance").withColumn("value", F.round("value", 4))


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount")
)


@query(
    "a22_spearman",
    f"WITH r AS (SELECT {_RANKS} FROM lineitem) " + _corr_sql("corr", "r", ("l_quantity", "l_extendedprice", "l_discount"), 7),
)
def _(t):
    return A.corr_matrix(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], "spearman").withColumn("value", F.round("value", 7))


_DIMS = (2, 4, 8, 16, 32, 64)


@query(
    "a23_distance_concentration",
    " UNION ALL ".join(
        f"SELECT {d} AS d, round(min(n), 6) AS min_norm, round(max(n), 6) AS max_norm, round(min(n) / max(n), 6) AS ratio, round(min(n) / sqrt({d}), 6) AS min_scaled, "
        f"round(max(n) / sqrt({d}), 6) AS max_scaled FROM (SELECT sqrt(list_inner_product(embedding[1:{d}]::DOUBLE[], embedding[1:{d}]::DOUBLE[])) AS n FROM embeddings)"
        for d in _DIMS
    ),
)
def _(t):
    out = A.distance_concentration(t.embeddings, "embedding", _DIMS)
    return out.select("d", *[F.round(c, 6).alias(c) for c in out.columns if c != "d"])


@query(
    "a24_entropy",
    "SELECT lang, CAST(sum(n) AS BIGINT) AS n, round(-sum(n / s * log2(n / s)), 8) + 0.0 AS entropy FROM (SELECT lang, quality, count(*) AS n, sum(count(*)) OVER (PARTITION BY "
    "lang) AS s FROM documents JOIN labels USING (doc_id) GROUP BY lang, quality) GROUP BY lang",
)
def _(t):
    out = M.class_entropy(t.documents.join(t.labels, "doc_id"), "quality", ["lang"])
    return out.withColumn("entropy", F.round("entropy", 8) + 0.0)


@query(
    "a24_class_probabilities",
    "SELECT source, count(*) AS n, round(count(*) / (SELECT count(*) FROM documents), 9) AS probability FROM documents GROUP BY source",
)
def _(t):
    return M.class_probabilities(t.documents, "source").withColumn("probability", F.round("probability", 9))


def _h(a: str, b: str) -> str:
    def term(x, s):
        return f"CASE WHEN {x} > 0 THEN -({x} / ({s})) * log2({x} / ({s})) ELSE 0 END"

    return f"({term(a, f'{a} + {b}')} + {term(b, f'{a} + {b}')})"


@query(
    "a24_information_gain",
    "WITH c AS (SELECT n_chars AS threshold, sum(CASE WHEN quality = 0 THEN 1.0::DOUBLE ELSE 0 END) AS c0, sum(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0 END) AS c1 FROM documents "
    "JOIN labels USING (doc_id) GROUP BY n_chars), r AS (SELECT threshold, sum(c0) OVER w AS a0, sum(c1) OVER w AS a1, sum(c0) OVER () AS t0, sum(c1) OVER () AS t1 FROM c WINDOW w AS "
    "(ORDER BY threshold)), s AS (SELECT *, t0 - a0 AS b0, t1 - a1 AS b1 FROM r) "
    f"SELECT threshold, round({_h('t0', 't1')} - (a0 + a1) / (t0 + t1) * {_h('a0', 'a1')} - (b0 + b1) / (t0 + t1) * {_h('b0', 'b1')}, 7) + 0.0 AS gain FROM s WHERE b0 + b1 > 0",
)
def _(t):
    out = M.information_gain(t.documents.join(t.labels, "doc_id"), "n_chars", "quality", [0, 1])
    return out.withColumn("gain", F.round("gain", 7) + 0.0)


def _predictions(t):
    """Price of an order line and the price predicted from its part."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_type")
    return t.lineitem.join(part, "l_partkey").select(
        "l_returnflag", "p_type", F.col("l_extendedprice").alias("y"), (F.col("p_retailprice") * F.col("l_quantity")).alias("yhat")
    )


_PRED_SQL = "(SELECT l_returnflag, p_type, l_extendedprice AS y, p_retailprice * l_quantity AS yhat FROM lineitem JOIN part ON l_partkey = p_partkey)"
_ERRORS_SQL = (
    "count(*) AS n, round(avg(abs(yhat - y)), 4) AS mae, round(stddev_samp(abs(yhat - y)), 4) AS mae_std, round(avg(100 * abs((yhat - y) / nullif(y, 0))), 4) AS mape, "
    "round(stddev_samp(100 * abs((yhat - y) / nullif(y, 0))), 4) AS mape_std, round(avg((yhat - y) ** 2), 0) AS mse, round(stddev_samp((yhat - y) ** 2), 0) AS mse_std, "
    "round(sqrt(avg((yhat - y) ** 2)), 4) AS rmse, round(sqrt(stddev_samp((yhat - y) ** 2)), 4) AS rmse_std, round(sqrt(avg((ln(1 + yhat) - ln(1 + y)) ** 2)), 6) AS rmsle"
)
_ERROR_DIGITS = {"mae": 4, "mae_std": 4, "mape": 4, "mape_std": 4, "mse": 0, "mse_std": 0, "rmse": 4, "rmse_std": 4, "rmsle": 6}


def _rounded(df):
    return df.withColumns({c: F.round(c, d) for c, d in _ERROR_DIGITS.items()})


@query("a25_regression_errors", f"SELECT l_returnflag, {_ERRORS_SQL} FROM {_PRED_SQL} GROUP BY l_returnflag")
def _(t):
    return _rounded(M.regression_errors(_predictions(t), "y", "yhat", ["l_returnflag"]))


@query(
    "a26_multilabel_f1",
    "WITH r AS (SELECT doc_id, quality, toxic, lang, contains(text, 'the') AS p1, contains(text, 'der') AS p2 FROM documents JOIN labels USING (doc_id)), s AS (SELECT CAST(quality "
    "AS INT) AS l1, CAST(toxic AS INT) AS l2, CAST(p1 AS INT) AS p1, CAST(p2 AS INT) AS p2 FROM r) SELECT round(avg(2.0 * (l1 * p1 + l2 * p2) / nullif(l1 + l2 + p1 + p2, 0)), 9) AS f1 FROM s",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id")
    pick = lambda test, name: F.when(test, F.lit(name))
    labels = F.array_compact(F.array(pick(F.col("quality") == 1, "quality"), pick(F.col("toxic") == 1, "toxic")))
    predicted = F.array_compact(F.array(pick(F.col("text").contains("the"), "quality"), pick(F.col("text").contains("der"), "toxic")))
    out = M.multilabel_f1(rows.select(labels.alias("l"), predicted.alias("p")), "l", "p")
    return out.withColumn("f1", F.round("f1", 9))


_CLASS_SQL = "(SELECT l_linestatus AS label, CASE WHEN l_returnflag = 'N' THEN 'O' ELSE 'F' END AS predicted FROM lineitem)"


def _classes(t):
    return t.lineitem.select(F.col("l_linestatus").alias("label"), F.when(F.col("l_returnflag") == "N", "O").otherwise("F").alias("predicted"))


@query(
    "a27_confusion",
    f"SELECT label, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 9) AS share FROM {_CLASS_SQL} GROUP BY label, predicted",
)
def _(t):
    return M.confusion(_classes(t), "label", "predicted").withColumn("share", F.round("share", 9))


@query(
    "a27_classification_report",
    f"WITH c AS (SELECT * FROM {_CLASS_SQL}), k AS (SELECT label AS class FROM c UNION SELECT predicted FROM c), s AS (SELECT class, (SELECT count(*) FROM c WHERE label = class) AS support, "
    "(SELECT count(*) FROM c WHERE predicted = class) AS called, (SELECT count(*) FROM c WHERE label = class AND predicted = class) AS hits FROM k) "
    "SELECT class, round(hits / nullif(called, 0), 9) AS precision, round(hits / nullif(support, 0), 9) AS recall, round(2 * hits / (called + support), 9) AS f1, support, "
    "round((SELECT avg(CAST(label = predicted AS INT)) FROM c), 9) AS accuracy FROM s",
)
def _(t):
    out = M.classification_report(_classes(t), "label", "predicted")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "accuracy")})


_SCORES_SQL = "(SELECT quality AS label, n_chars AS score FROM documents JOIN labels USING (doc_id))"


@query(
    "a28_roc_curve",
    f"WITH g AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS p, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS n FROM {_SCORES_SQL} GROUP BY score) SELECT score, "
    "round(sum(n) OVER w / sum(n) OVER (), 9) AS fpr, round(sum(p) OVER w / sum(p) OVER (), 9) AS tpr FROM g WINDOW w AS (ORDER BY score DESC)",
)
def _(t):
    out = M.roc_curve(t.documents.join(t.labels, "doc_id"), "quality", "n_chars")
    return out.select("score", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "a28_auc",
    f"WITH g AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END)::DOUBLE AS n FROM {_SCORES_SQL} GROUP BY score), r AS "
    "(SELECT p, n, sum(n) OVER w AS cn, sum(p) OVER w AS cp, sum(n) OVER () AS tn, sum(p) OVER () AS tp FROM g WINDOW w AS (ORDER BY score DESC)) SELECT round(sum(n * (cp + cp - p) / 2) / "
    "max(tp * tn), 9) AS auc, round(sum(p * (cp / (cp + cn) + CASE WHEN cp + cn - p - n > 0 THEN (cp - p) / (cp + cn - p - n) ELSE cp / (cp + cn) END) / 2) / max(tp), 9) AS pr_auc FROM r",
)
def _(t):
    out = M.area_under_curves(t.documents.join(t.labels, "doc_id"), "quality", "n_chars")
    return out.select(F.round("auc", 9).alias("auc"), F.round("pr_auc", 9).alias("pr_auc"))


@query(
    "a29_weighted_metrics",
    f"WITH g AS (SELECT p_type, {_ERRORS_SQL} FROM {_PRED_SQL} GROUP BY p_type) SELECT round(sum(mae * n) / sum(n), 3) AS mae, round(sum(mape * n) / sum(n), 3) AS mape FROM g",
)
def _(t):
    groups = _rounded(M.regression_errors(_predictions(t), "y", "yhat", ["p_type"]))
    out = A.weighted_metrics(groups, ["mae", "mape"])
    return out.select(F.round("mae", 3).alias("mae"), F.round("mape", 3).alias("mape"))


@query(
    "a30_errors_by_band",
    f"SELECT CASE WHEN abs(yhat - y) <= 10000 THEN 'small' WHEN abs(yhat - y) > 50000 THEN 'large' ELSE 'middle' END AS band, {_ERRORS_SQL} FROM {_PRED_SQL} GROUP BY band",
)
def _(t):
    return _rounded(M.errors_by_band(_predictions(t), "y", "yhat", 10000, 50000))


@query(
    "a31_normal_fit",
    "SELECT round(avg(o_totalprice), 4) AS mu, round(stddev_pop(o_totalprice), 4) AS sigma, round(avg(ln(1 + o_totalprice)), 7) AS log_mu, "
    "round(stddev_pop(ln(1 + o_totalprice)), 7) AS log_sigma FROM orders",
)
def _(t):
    rows = t.orders.select("o_totalprice", F.log1p("o_totalprice").alias("lp"))
    a, b = A.normal_fit(rows, "o_totalprice").first(), A.normal_fit(rows, "lp").first()
    values = {"mu": (a[0], 4), "sigma": (a[1], 4), "log_mu": (b[0], 7), "log_sigma": (b[1], 7)}
    return t.spark.range(1).select(*[F.round(F.lit(v), d).alias(k) for k, (v, d) in values.items()])


_POINTS = 20
_MARKS = [(i + 0.5) / _POINTS for i in range(_POINTS)]


@query(
    "a31_qq_points",
    " UNION ALL ".join(
        f"SELECT {p}::DOUBLE AS p, round({NormalDist().inv_cdf(p)!r}::DOUBLE, 9) AS normal, round(quantile_cont(o_totalprice, {p}), 2) AS sample FROM orders" for p in _MARKS
    ),
)
def _(t):
    out = A.qq_points(t.orders, "o_totalprice", _POINTS)
    return out.select("p", F.round("normal", 9).alias("normal"), F.round("sample", 2).alias("sample"))


@query(
    "a32_missing_ratio",
    "SELECT * FROM (SELECT 'quality' AS \"column\", round(100.0 * avg(CASE WHEN quality IS NULL THEN 1 ELSE 0 END), 9) AS missing_pct FROM documents LEFT JOIN labels USING (doc_id) UNION ALL SELECT 'toxic', "
    "round(100.0 * avg(CASE WHEN toxic IS NULL THEN 1 ELSE 0 END), 9) FROM documents LEFT JOIN labels USING (doc_id)) WHERE missing_pct > 0",
)
def _(t):
    return A.missing_ratio(t.documents.join(t.labels, "doc_id", "left")).withColumn("missing_pct", F.round("missing_pct", 9))
