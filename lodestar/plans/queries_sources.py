"""Sources and sinks, by writing given tables to the scratch folder and reading them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.operators.scaling import checkpoint_folder
from lodestar.plans.registry import Tables, query
from lodestar.sources import readers, sinks

_FLAT = "translate(text, chr(9) || chr(10) || chr(13), '   ')"


def _folder(t: Tables) -> str:
    return f"{checkpoint_folder(t.spark)}/round-trip-{uuid.uuid4().hex}"


@query(
    "s01_read_lines",
    "SELECT line AS value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) "
    "GROUP BY line",
)
def _(t):
    path = _folder(t)
    t.documents.select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return readers.read_lines(t.spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s02_read_posts",
    f"SELECT CAST(doc_id AS VARCHAR) AS id, trim(split_part(text, chr(10), 1)) AS title, trim({_FLAT}) AS body, lang AS tags "
    "FROM documents",
)
def _(t):
    path = _folder(t)
    rows = t.documents.select(
        F.concat_ws(
            "\t",
            F.col("doc_id").cast("string"),
            F.trim(F.split("text", "\n")[0]),
            F.trim(F.translate("text", "\t\n\r", "   ")),
            "lang",
        )
    )
    rows.write.text(path)
    return readers.read_posts(t.spark, path)


@query(
    "s03_read_json_view",
    "SELECT c_mktsegment AS segment, count(*) AS n FROM customer WHERE c_acctbal < 1000 GROUP BY c_mktsegment",
)
def _(t):
    path = _folder(t)
    t.customer.select("c_mktsegment", F.col("c_acctbal").cast("string")).write.json(path)
    readers.read_json_view(t.spark, path, "lodestar_accounts")
    return t.spark.sql(
        "SELECT c_mktsegment AS segment, count(*) AS n FROM lodestar_accounts "
        "WHERE CAST(c_acctbal AS DOUBLE) < 1000 GROUP BY c_mktsegment"
    )


@query(
    "s04_parquet_overwrite",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY ALL",
)
def _(t):
    path = _folder(t)
    sinks.write_table(t.lineitem.where("l_quantity > 10").select("l_returnflag"), path)
    sinks.write_table(t.lineitem, path)
    table = readers.read_table(t.spark, path, ["l_returnflag", "l_linestatus", "l_quantity"])
    return table.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "s05_read_csv_typed",
    "SELECT o_orderpriority, strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month, count(*) AS n, "
    "round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL",
)
def _(t):
    path = _folder(t)
    source = t.orders.select("o_orderpriority", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"), "o_totalprice")
    sinks.write_csv(source, path)
    typed = readers.read_csv_typed(t.spark, path, {"o_totalprice": "double"}, {"o_orderdate": "dd/MM/yyyy"})
    return typed.groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "s06_read_delim",
    "SELECT c_nationkey, count(*) AS n, count(CASE WHEN c_mktsegment <> 'BUILDING' THEN 1 END) AS known, "
    "round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_nationkey",
)
def _(t):
    path = _folder(t)
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    sinks.write_csv(
        t.customer.select("c_nationkey", segment.alias("c_mktsegment"), "c_acctbal"), path, nullValue="-", compression="gzip"
    )
    table = readers.read_delim(t.spark, path, "c_nationkey INT, c_mktsegment STRING, c_acctbal DOUBLE", na="-")
    return table.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.count("c_mktsegment").alias("known"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(
    "s07_read_years",
    "SELECT year(o_orderdate) AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL",
)
def _(t):
    path = _folder(t)
    years = [r[0] for r in t.orders.select(F.year("o_orderdate")).distinct().collect()]
    base = t.orders.withColumn("o_year", F.year("o_orderdate"))
    for year in years:
        part = base.where(F.col("o_year") == year).select("o_orderkey", "o_orderstatus", "o_year")
        sinks.write_csv(part, f"{path}/{year}", sep="\t" if year == min(years) else ",")
    table = readers.read_years(
        t.spark, lambda y: f"{path}/{y}", years, "o_orderkey BIGINT, o_orderstatus STRING, o_year INT", {min(years): "\t"}
    )
    return table.groupBy(F.col("o_year").cast("bigint").alias("year"), "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_SALES_SQL = (
    "SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 10 AND o_orderstatus = 'F' GROUP BY n_name"
)


@query("s08_read_sql", _SALES_SQL)
def _(t):
    for name in ("orders", "customer", "nation"):
        getattr(t, name).createOrReplaceTempView(name)
    return readers.read_sql(t.spark, None, _SALES_SQL)


@query(
    "s09_cached",
    "SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 6) AS price FROM part GROUP BY p_brand",
)
def _(t):
    path = _folder(t)

    def build():
        return t.part.groupBy("p_brand").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 6).alias("price")
        )

    sinks.cached(t.spark, path, build)
    return sinks.cached(t.spark, path, lambda: build().limit(0))


@query("s10_write_csv", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    path = _folder(t)
    sinks.write_csv(t.nation, path)
    return readers.read_delim(t.spark, path, "n_nationkey INT, n_name STRING, n_regionkey INT")


def _write_edges(t) -> str:
    path = _folder(t)
    pairs = t.lineitem.select(F.concat_ws(" ", "l_suppkey", "l_partkey"))
    header = t.region.limit(1).select(F.lit("# supplier part"))
    header.unionAll(pairs).write.text(path)
    return path


@query(
    "s11_read_edges",
    "WITH e AS (SELECT DISTINCT least(l_suppkey, l_partkey) AS src, greatest(l_suppkey, l_partkey) AS dst FROM lineitem) "
    "SELECT (SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e)) AS nodes, (SELECT count(*) FROM e) AS edges",
)
def _(t):
    return readers.graph_size(readers.read_edges(t.spark, _write_edges(t), " ", directed=False))


@query(
    "s12_canonical_edges",
    "SELECT DISTINCT least(a.o_custkey, b.o_custkey) AS src, greatest(a.o_custkey, b.o_custkey) AS dst FROM orders a "
    "JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey",
)
def _(t):
    from lodestar.plans.graphs import succession

    return readers.canonical_edges(succession(t))


@query(
    "s13_read_labelled_dirs",
    "SELECT CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars "
    "FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
)
def _(t):
    path = _folder(t)
    rows = t.documents.join(t.labels, "doc_id").select("quality", F.translate("text", "\n\r", "  ").alias("value"))
    for folder, test in (("pos", F.col("quality") == 1), ("neg", F.col("quality") != 1)):
        rows.where(test).select("value").write.text(f"{path}/{folder}")
    docs = readers.read_labelled_dirs(t.spark, path, whole_files=False)
    return docs.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query(
    "s14_merge_nodes",
    "SELECT coalesce(s_name, c_name) AS name, CASE WHEN s_name IS NULL THEN 'Client' WHEN c_name IS NULL THEN 'Company' "
    "ELSE 'Client,Company' END AS labels, coalesce(s_nationkey, c_nationkey) AS nation FROM (SELECT DISTINCT "
    "replace(c_name, 'Customer', 'Node') AS c_name, c_nationkey FROM customer) FULL JOIN (SELECT "
    "replace(s_name, 'Supplier', 'Node') AS s_name, s_nationkey FROM supplier) ON c_name = s_name",
)
def _(t):
    clients = t.customer.select(
        F.replace("c_name", F.lit("Customer"), F.lit("Node")).alias("name"), F.col("c_nationkey").alias("nation"),
        F.array(F.lit("Client")).alias("labels"),
    )
    companies = t.supplier.select(
        F.replace("s_name", F.lit("Supplier"), F.lit("Node")).alias("name"), F.col("s_nationkey").alias("nation"),
        F.array(F.lit("Company")).alias("labels"),
    )
    merged = readers.merge_nodes(clients, companies, "name")
    return merged.withColumn("labels", F.array_join("labels", ","))


@query(
    "s14_load_relations",
    "SELECT o_custkey AS src, 'ORDERED' AS type, o_orderkey AS dst FROM orders",
)
def _(t):
    return readers.load_relations(t.orders, "o_custkey", "o_orderkey", "ORDERED")


@query(
    "s15_read_ratings",
    "SELECT CAST(count(DISTINCT o_custkey) AS BIGINT) AS users, CAST(count(DISTINCT l_partkey) AS BIGINT) AS items, "
    "count(*) AS ratings FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
)
def _(t):
    path = _folder(t)
    rows = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "l_partkey", "l_quantity", F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    )
    sinks.write_csv(rows, path, sep="\t", header=False)
    ratings = readers.read_ratings(t.spark, path)
    users = ratings.select("user").distinct().agg(F.count(F.lit(1)).alias("users"))
    items = ratings.select("item").distinct().agg(F.count(F.lit(1)).alias("items"))
    total = ratings.agg(F.count(F.lit(1)).alias("ratings"))
    return t.spark.range(1).select(
        *[F.lit(f.first()[0]).cast("bigint").alias(f.columns[0]) for f in (users, items, total)]
    )


def _int_case(column: str) -> str:
    steps = " ".join(
        f"WHEN min({column}) > -{2 ** (b - 1)} AND max({column}) < {2 ** (b - 1) - 1} THEN '{kind}'"
        for kind, b in (("tinyint", 8), ("smallint", 16), ("int", 32))
    )
    return f"SELECT '{column}' AS name, CASE {steps} ELSE 'bigint' END AS kind FROM lineitem"


@query(
    "s16_narrow_types",
    " UNION ALL ".join(
        [_int_case(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
        + [f"SELECT '{c}', 'float'" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    ),
)
def _(t):
    narrow = readers.narrow_types(t.lineitem)
    kinds = [(f.name, f.dataType.simpleString()) for f in narrow.schema if f.dataType.typeName() not in ("string", "timestamp_ntz")]
    return t.spark.createDataFrame(kinds, "name STRING, kind STRING")
