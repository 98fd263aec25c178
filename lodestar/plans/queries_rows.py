"""Group-wise selection, ordering, reshaping, sets, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import reshape as V
from lodestar.operators import rows as W
from lodestar.plans.graphs import RATINGS_SQL, ratings
from lodestar.plans.registry import query


@query(
    "w01_group_max_rows",
    "SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE (c_nationkey, c_acctbal) IN (SELECT c_nationkey, max(c_acctbal) FROM customer GROUP BY c_nationkey)",
)
def _(t):
    return W.group_max_rows(t.customer, "c_nationkey", "c_acctbal").select("c_custkey", "c_nationkey", "c_acctbal")


@query(
    "w02_dedup_first",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def _(t):
    return W.dedup_first(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


_DAILY = "SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL"


@query(
    "w03_days_since_threshold",
    f"WITH x AS ({_DAILY}), f AS (SELECT user_id, min(d) AS f FROM x WHERE n >= 4 GROUP BY user_id) SELECT user_id, n, CAST(d - f AS INT) AS day FROM x JOIN f USING (user_id) WHERE d >= f",
)
def _(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return W.days_since_threshold(daily, "user_id", "d", "n", 4).select("user_id", "n", "day")


@query(
    "w04_split_per_user",
    f"SELECT \"user\", item, CASE WHEN row_number() OVER (PARTITION BY \"user\" ORDER BY item) <= 10 THEN 'test' ELSE 'base' END AS part FROM ({RATINGS_SQL})",
)
def _(t):
    return W.split_per_user(ratings(t), "user", ["item"]).select("user", "item", "part")


@query("w05_kfold_blocks", "SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderdate, o_orderkey) AS INT) AS fold FROM orders")
def _(t):
    return W.kfold_blocks(t.orders.select("o_orderkey", "o_orderdate"), 7, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "fold")


@query(
    "w06_surrogate_key",
    "SELECT p_name, p_brand, row_number() OVER (ORDER BY p_name, p_brand) AS id FROM (SELECT DISTINCT p_name, p_brand FROM part)",
)
def _(t):
    return W.surrogate_key(t.part, ["p_name", "p_brand"])


@query(
    "l01_sort",
    "SELECT o_custkey, n, row_number() OVER (ORDER BY n DESC, o_custkey) AS place FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)",
)
def _(t):
    from lodestar.operators.scaling import with_row_number

    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return with_row_number(counts, [F.desc("n"), F.asc("o_custkey")], "place").orderBy("place")


@query("l02_limit_tail", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def _(t):
    return W.tail_rows(t.orders, ["o_orderdate", "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


@query(
    "l03_top_groups",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY l_suppkey ORDER BY max(l_extendedprice) DESC, l_suppkey LIMIT 15)",
)
def _(t):
    return W.top_groups(t.lineitem, "l_suppkey", "l_extendedprice", 15).select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")


@query("l04_extreme_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY abs(o_totalprice - 250000) DESC, o_orderkey LIMIT 25")
def _(t):
    return W.extreme_rows(t.orders, [F.desc(F.abs(F.col("o_totalprice") - 250000)), F.asc("o_orderkey")], 25).select("o_orderkey", "o_totalprice")


@query(
    "v01_melt",
    "SELECT o_orderkey, variable, value FROM (SELECT o_orderkey, unnest(['o_custkey', 'o_totalprice']) AS variable, unnest([CAST(o_custkey AS DOUBLE), o_totalprice]) AS value FROM orders)",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("double").alias("o_custkey"), "o_totalprice")
    return V.melt(rows, ["o_orderkey"])


_FLAGS = ("A", "N", "R")


def _pivot_sql(agg: str, digits: int) -> str:
    cells = ", ".join(f"round({agg}(CASE WHEN l_returnflag = '{f}' THEN l_quantity END), {digits}) AS \"{f}\"" for f in _FLAGS)
    return f"SELECT l_suppkey, {cells} FROM lineitem GROUP BY l_suppkey"


@query("v02_pivot_mean", _pivot_sql("avg", 6))
def _(t):
    out = V.pivot_table(t.lineitem, "l_suppkey", "l_returnflag", "l_quantity")
    return out.select("l_suppkey", *[F.round(f, 6).alias(f) for f in _FLAGS])


@query("v02_pivot_max", _pivot_sql("max", 2))
def _(t):
    return V.pivot_table(t.lineitem, "l_suppkey", "l_returnflag", "l_quantity", "max", _FLAGS)


@query(
    "v02_pivot_unique",
    "SELECT c_nationkey, " + ", ".join(f"count(CASE WHEN c_mktsegment = '{s}' THEN 1 END) AS \"{s}\"" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))
    + " FROM customer GROUP BY c_nationkey",
)
def _(t):
    cells = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return V.pivot_unique(cells, "c_nationkey", "c_mktsegment", "n", ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]).na.fill(0)


@query(
    "v03_pivot_two_ids",
    "SELECT user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, "
    + ", ".join(
        f"round({agg}(CASE WHEN event_type = '{e}' THEN value END), 4) AS {e}_{name}"
        for agg, name in (("max", "high"), ("min", "low")) for e in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY ALL",
)
def _(t):
    rows = t.events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type", "value")
    ids = ["user_id", "day"]
    parts = {name: V.pivot_table(rows, ids, "event_type", "value", agg) for name, agg in (("high", "max"), ("low", "min"))}
    high, low = (part.select(*ids, *[F.round(c, 4).alias(f"{c}_{name}") for c in part.columns if c not in ids]) for name, part in parts.items())
    return high.join(low, ids)


@query(
    "v04_unstack_stack",
    "SELECT l_suppkey, l_returnflag AS flag, max(l_quantity) AS value FROM lineitem GROUP BY ALL",
)
def _(t):
    wide = V.pivot_table(t.lineitem, "l_suppkey", "l_returnflag", "l_quantity", "max")
    return V.stack(wide, ["l_suppkey"], "flag", "value")


@query(
    "v05_transpose",
    "SELECT key, " + ", ".join(f"max(CASE WHEN r = '{r}' THEN v END) AS \"{r}\"" for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))
    + " FROM (SELECT r_name AS r, unnest(['nations', 'names']) AS key, unnest([count(*), CAST(sum(length(n_name)) AS BIGINT)]) AS v FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY r_name) GROUP BY key",
)
def _(t):
    rows = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey")).groupBy("r_name").agg(
        F.count(F.lit(1)).alias("nations"), F.sum(F.length("n_name")).alias("names")
    )
    return V.transpose(rows, "r_name")


@query(
    "v06_split_sex_age",
    "SELECT c_nationkey, sex, age, n FROM (SELECT c_nationkey, unnest(['m', 'm', 'f', 'f']) AS sex, unnest(['0-4', '15-24', '65+', '25-34']) AS age, unnest([count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END), "
    "count(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 END), count(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 END), count(*)]) AS n FROM customer GROUP BY c_nationkey)",
)
def _(t):
    segment = lambda s: F.count_if(F.col("c_mktsegment") == s)
    wide = t.customer.groupBy("c_nationkey").agg(
        segment("BUILDING").alias("m04"), segment("MACHINERY").alias("m1524"), segment("HOUSEHOLD").alias("f65"), F.count(F.lit(1)).alias("f2534"),
        segment("FURNITURE").alias("mu"),
    )
    return V.split_sex_age(V.melt(wide, ["c_nationkey"], value="n")).drop("variable")


@query(
    "v07_day_columns_to_date",
    "SELECT event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, count(*) AS n FROM events GROUP BY ALL",
)
def _(t):
    rows = t.events.select("event_type", F.year("ts").alias("year"), F.month("ts").alias("month"), F.concat(F.lit("d"), F.dayofmonth("ts")).alias("day"))
    wide = rows.groupBy("event_type", "year", "month").pivot("day", [f"d{i}" for i in range(1, 32)]).agg(F.count(F.lit(1)))
    out = V.day_columns_to_date(wide, ["event_type", "year", "month"], value="n")
    return out.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@query(
    "v08_normalise",
    "SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, k.id, k.l_returnflag, k.l_linestatus FROM lineitem l JOIN (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS id FROM (SELECT DISTINCT "
    "l_returnflag, l_linestatus FROM lineitem)) k USING (l_returnflag, l_linestatus)",
)
def _(t):
    entities, facts = V.normalise(t.lineitem, ["l_returnflag", "l_linestatus"])
    return facts.join(entities, "id").select("l_orderkey", "l_linenumber", "l_suppkey", "id", "l_returnflag", "l_linestatus")


@query(
    "v09_dummies",
    "SELECT event_id, " + ", ".join(f"CAST(event_type = '{e}' AS INT) AS e_{e}" for e in ("click", "error", "purchase", "signup", "view"))
    + " FROM events",
)
def _(t):
    train = t.events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    levels = V.dummy_levels(train, ["event_type"])
    return V.dummies(t.events.select("event_id", "event_type"), levels, {"event_type": "e"})


@query("v10_ordinal_encode", "SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part")
def _(t):
    return V.ordinal_encode(t.part.select("p_partkey", "p_name"), "p_name", "code").select("p_partkey", "code")


@query("v10_ordinal_decode", "SELECT p_partkey, p_name FROM part")
def _(t):
    from lodestar.operators.rows import surrogate_key

    encoded = V.ordinal_encode(t.part.select("p_partkey", "p_name"), "p_name", "code").drop("p_name")
    codes = surrogate_key(t.part, ["p_name"], "n").select("p_name", (F.col("n") - 1).alias("code"))
    return V.ordinal_decode(encoded, codes, "code", "p_name").select("p_partkey", "p_name")


@query(
    "u01_union_with_origin",
    "SELECT origin, CAST(name AS VARCHAR) AS name, round(acctbal, 2) AS acctbal, segment FROM (SELECT 'customer' AS origin, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer "
    "UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier)",
)
def _(t):
    c = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return W.union_with_origin({"customer": c, "supplier": s}).withColumn("acctbal", F.round("acctbal", 2))


_WORDS = "SELECT unnest(string_split_regex({}, '[ \\t\\n\\f\\r\\x0B]+')) FROM {}"


@query(
    "u02_common_words",
    f"SELECT word FROM ({_WORDS.format('text', 'documents')} INTERSECT {_WORDS.format('text', 'benchmark')}) AS x(word) WHERE word <> ''",
)
def _(t):
    return W.common_words(t.documents, t.benchmark, "text")


@query("u03_distinct", "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_partkey").distinct()


@query("u04_except", "SELECT p_partkey FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 49")
def _(t):
    from lodestar.operators.joins import anti

    used = t.lineitem.where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return anti(t.part.select("p_partkey"), used, "p_partkey")


HASH = "CAST('0x' || substr(md5(concat_ws(':', {}, {})), 1, 8) AS UBIGINT)"


def hash_sql(keys: str, seed: int | str = 42) -> str:
    return HASH.format(keys, seed)


def fraction_sql(keys: str, seed: int | str = 42) -> str:
    return f"({hash_sql(keys, seed)} / 4294967296::DOUBLE)"


@query("u05_sample_hash", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {fraction_sql('o_orderkey')} < 0.2")
def _(t):
    return W.sample_hash(t.orders, ["o_orderkey"], 0.2).select("o_orderkey", "o_totalprice")


@query("u05_sample_n", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {hash_sql('o_orderkey')}, o_orderkey LIMIT 1000")
def _(t):
    return W.sample_n(t.orders, ["o_orderkey"], 1000).select("o_orderkey", "o_totalprice")


@query("u06_split_weights", f"SELECT CASE WHEN {fraction_sql('o_orderkey')} < 0.8 THEN 'train' ELSE 'test' END AS part, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    train, test = W.split_weights(t.orders, ["o_orderkey"], [0.8, 0.2])
    return W.union_with_origin({"train": train, "test": test}, "part").groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query(
    "u06_stratified_split",
    "SELECT lang, CAST(round(count(*) * 0.8) AS BIGINT) AS train, count(*) - CAST(round(count(*) * 0.8) AS BIGINT) AS test FROM documents GROUP BY lang",
)
def _(t):
    marked = W.stratified_split(t.documents.select("doc_id", "lang"), "lang", ["doc_id"])
    return marked.groupBy("lang").agg(F.count_if(F.col("part") == "train").alias("train"), F.count_if(F.col("part") == "test").alias("test"))


@query(
    "u06_shuffle_splits",
    f"SELECT CAST(split AS INT) AS split, CASE WHEN {fraction_sql('o_orderkey, split')} < 0.5 THEN 'train' ELSE 'test' END AS part, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders, (SELECT unnest(range(0, 8)) AS split) GROUP BY ALL",
)
def _(t):
    halves = W.shuffle_splits(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    return halves.groupBy("split", "part").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))


@query(
    "u07_bootstrap",
    f"WITH n AS (SELECT count(*) AS n FROM customer), k AS (SELECT c_mktsegment, row_number() OVER (ORDER BY c_custkey) AS pos FROM customer), p AS (SELECT CAST((({hash_sql('i')} % 2147483648)::HUGEINT * 4294967296 + {hash_sql('i', 43)}) % n + 1 AS BIGINT) AS pos "
    "FROM (SELECT n, unnest(range(1, n + 1)) AS i FROM n)), a AS (SELECT c_mktsegment, count(*) AS after FROM p JOIN k USING (pos) GROUP BY ALL) "
    "SELECT c_mktsegment, before, after FROM (SELECT c_mktsegment, count(*) AS before FROM customer GROUP BY ALL) LEFT JOIN a USING (c_mktsegment)",
)
def _(t):
    drawn = W.bootstrap(t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"])
    before = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("before"))
    return before.join(drawn.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("after")), "c_mktsegment", "left")
