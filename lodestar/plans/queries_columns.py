"""Projection, filter, cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import columns as C
from lodestar.operators.tablefunctions import flag_columns
from lodestar.plans.registry import query


@query("p01_project_rename", "SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderstatus AS status FROM orders")
def _(t):
    out = t.orders.drop("o_orderpriority").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_totalprice": "price", "o_orderstatus": "status"}
    )
    return out.select("order_id", "price", "status")


@query("p02_sql_cast_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 1000")
def _(t):
    t.customer.select("c_custkey", F.col("c_acctbal").cast("string").alias("balance")).createOrReplaceTempView("lodestar_text_balance")
    return t.spark.sql(
        "SELECT c_custkey, CAST(balance AS DOUBLE) AS c_acctbal FROM lodestar_text_balance WHERE CAST(balance AS DOUBLE) < 1000"
    )


@query(
    "p03_count_lines_containing",
    "SELECT count(*) AS total, count(CASE WHEN contains(line, 'the') THEN 1 END) AS n_the, "
    "count(CASE WHEN contains(line, 'and') THEN 1 END) AS n_and FROM (SELECT unnest(string_split(text, chr(10))) AS line "
    "FROM documents)",
)
def _(t):
    return C.count_lines_containing(t.documents.select(F.explode(F.split("text", "\n")).alias("value")), ["the", "and"])


@query(
    "p04_drop_null_rows",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def _(t):
    return t.documents.join(t.labels, "doc_id", "left").na.drop(subset=["quality", "toxic"]).select("doc_id", "quality")


@query(
    "p05_filter_extremes",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 10 AND l_extendedprice < 50000 "
    "AND l_quantity > 0 AND l_quantity <= 10 AND l_discount <= 0.05",
)
def _(t):
    bounds = {
        "l_extendedprice": (10, 50000, False, False),
        "l_quantity": (0, 10, False, True),
        "l_discount": (None, 0.05, False, True),
    }
    return C.filter_bounds(t.lineitem, bounds).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "p06_masks",
    "SELECT p_partkey, p_size, p_type FROM part WHERE p_size > 10 AND p_size < 30 AND p_type IN ('ECONOMY', 'PROMO') "
    "AND p_brand NOT IN ('Brand#1', 'Brand#2')",
)
def _(t):
    return t.part.where(
        (F.col("p_size") > 10) & (F.col("p_size") < 30) & F.col("p_type").isin("ECONOMY", "PROMO")
        & ~F.col("p_brand").isin("Brand#1", "Brand#2")
    ).select("p_partkey", "p_size", "p_type")


@query(
    "p07_filter_time",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' "
    "AND month(ts) IN (1, 2) AND hour(ts) >= 8 AND hour(ts) < 20",
)
def _(t):
    return C.filter_time(t.events, "ts", "2024-01-05", "2024-01-20", [1, 2], (8, 20)).select("event_id", "user_id")


@query(
    "p08_recode",
    "SELECT l_returnflag_label, l_linestatus_label, count(*) AS n FROM (SELECT CASE l_returnflag WHEN 'A' THEN 'accepted' "
    "WHEN 'R' THEN 'returned' ELSE l_returnflag END AS l_returnflag_label, CASE WHEN l_linestatus = 'O' THEN NULL WHEN "
    "l_linestatus = 'F' THEN 'final' ELSE l_linestatus END AS l_linestatus_label FROM lineitem) GROUP BY ALL",
)
def _(t):
    return (
        t.lineitem.select(
            C.recode("l_returnflag", {"A": "accepted", "R": "returned"}).alias("l_returnflag_label"),
            C.recode("l_linestatus", {"F": "final"}, nulls=["O"]).alias("l_linestatus_label"),
        )
        .groupBy("l_returnflag_label", "l_linestatus_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "p08_recode_join",
    "SELECT n_name AS c_nationkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name",
)
def _(t):
    codes = t.nation.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    rows = t.customer.select(F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return C.recode_join(rows, "c_nationkey", codes).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p09_score_labels",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 200.0 WHEN '2-HIGH' THEN 50.0 WHEN '3-MEDIUM' THEN 10.0 "
    "ELSE 0.0 END::DOUBLE AS score FROM orders",
)
def _(t):
    scores = {"1-URGENT": 200, "2-HIGH": 50, "3-MEDIUM": 10}
    return t.orders.select("o_orderkey", C.score_labels("o_orderpriority", scores, 0).alias("score"))


@query(
    "p10_collapse_levels",
    "SELECT level, count(*) AS n, sum(score)::DOUBLE AS score FROM (SELECT CASE WHEN quality IS NULL THEN '(Inconnu)' WHEN lang IN "
    "('en', 'de') THEN 'germanic' WHEN lang IN ('fr') THEN 'romance' ELSE 'Other' END AS level, CASE WHEN quality IS NULL "
    "THEN 0 WHEN lang IN ('en', 'de') THEN 100 WHEN lang IN ('fr') THEN -100 ELSE 0 END AS score FROM documents LEFT JOIN "
    "labels USING (doc_id)) GROUP BY level",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select(F.when(F.col("quality").isNotNull(), F.col("lang")).alias("lang"))
    level = C.collapse_levels("lang", {"germanic": ["en", "de"], "romance": ["fr"]})
    scores = {"(Inconnu)": 0, "Other": 0, "germanic": 100, "romance": -100}
    return (
        rows.select(level.alias("level"))
        .withColumn("score", C.score_labels("level", scores))
        .groupBy("level")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score"))
    )


@query(
    "p11_impute_mean",
    "SELECT doc_id, round(coalesce(quality, (SELECT avg(quality) FROM labels)), 9) AS quality, coalesce(kind, 'missing') AS kind "
    "FROM (SELECT doc_id, quality, CASE WHEN lang IN ('en', 'fr') THEN lang END AS kind FROM documents LEFT JOIN labels USING (doc_id))",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select(
        F.col("doc_id"), F.col("quality").cast("double").alias("quality"), F.when(F.col("lang").isin("en", "fr"), F.col("lang")).alias("kind")
    )
    fitted = C.impute_values(rows.drop("doc_id"), "mean")
    return C.impute(rows, fitted=fitted).withColumn("quality", F.round("quality", 9))


@query(
    "p11_impute_median",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(price, (SELECT median(l_extendedprice) FROM lineitem WHERE l_quantity >= 10)) "
    "AS price FROM (SELECT *, CASE WHEN l_quantity >= 10 THEN l_extendedprice END AS price FROM lineitem)",
)
def _(t):
    rows = t.lineitem.withColumn("price", F.when(F.col("l_quantity") >= 10, F.col("l_extendedprice")))
    fitted = C.impute_values(rows.select("price"), "median")
    return C.impute(rows, fitted=fitted).select("l_orderkey", "l_linenumber", "l_partkey", "price")


@query(
    "p12_missing_indicator",
    "SELECT doc_id, coalesce(quality, 0)::DOUBLE AS quality, CASE WHEN quality IS NULL THEN 1 ELSE 0 END AS quality_missing FROM documents "
    "LEFT JOIN labels USING (doc_id)",
)
def _(t):
    rows = t.documents.join(t.labels, "doc_id", "left").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return C.impute(rows, add_indicator=True, fitted={"quality": 0.0})


@query(
    "p13_arithmetic",
    "SELECT o_orderkey, round(o_totalprice / (SELECT avg(o_totalprice) FROM orders), 6) AS price_ratio, "
    "round(ln(o_totalprice + 1), 6) AS log_price, round(exp(ln(o_totalprice + 1)) - 1, 2) AS back, "
    "round(o_totalprice / 1e5, 9) AS scaled FROM orders",
)
def _(t):
    rows = C.ratio_to(
        t.orders.withColumn("price", F.col("o_totalprice")), ["price"], t.orders.agg(F.avg("o_totalprice").alias("price"))
    )
    return rows.select(
        "o_orderkey", F.round("price_ratio", 6).alias("price_ratio"), F.round(F.log1p("price"), 6).alias("log_price"),
        F.round(F.expm1(F.log1p("price")), 2).alias("back"), F.round(F.col("price") / 1e5, 9).alias("scaled"),
    )


@query("p14_annotate", "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS size FROM part")
def _(t):
    return t.part.select("p_partkey", C.annotate("p_size", 25).alias("size"))


@query(
    "p15_string_functions",
    "SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, length(p_name) AS len, "
    "CAST(starts_with(p_name, 'red') AS INT) AS is_red, CAST(contains(p_name, 'ring') AS INT) AS has_ring, "
    "split_part(p_name, ' ', 1) AS colour, split_part(p_name, ' ', 2) AS thing, replace(p_brand, '#', '_') AS brand FROM part",
)
def _(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.length("p_name").cast("bigint").alias("len"),
        F.col("p_name").startswith("red").cast("int").alias("is_red"), F.col("p_name").contains("ring").cast("int").alias("has_ring"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("colour"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("thing"),
        F.replace("p_brand", F.lit("#"), F.lit("_")).alias("brand"),
    )


@query(
    "p16_split_at",
    "SELECT event_id, substr(hm, 1, length(hm) - 2) AS hr, right(hm, 2) AS mn, left(event_type, 1) AS head, substr(event_type, 2) AS rest "
    "FROM (SELECT event_id, event_type, CAST(hour(ts) * 100 + minute(ts) + 100 AS VARCHAR) AS hm FROM events)",
)
def _(t):
    rows = t.events.withColumn("hm", (F.hour("ts") * 100 + F.minute("ts") + 100).cast("string"))
    hour, minute = C.split_at("hm", -2)
    head, rest = C.split_at("event_type", 1)
    return rows.select("event_id", hour.alias("hr"), minute.alias("mn"), head.alias("head"), rest.alias("rest"))


@query(
    "p17_timestamp_from_parts",
    "SELECT o_orderkey, strftime(make_timestamp(2000 + year(o_orderdate) % 100, month(o_orderdate), day(o_orderdate), "
    "CAST(o_orderkey % 24 AS BIGINT), CAST(o_orderkey % 60 AS BIGINT), 0.0), '%Y-%m-%d %H:%M:%S') AS stamp FROM orders",
)
def _(t):
    key = F.col("o_orderkey")
    hour = F.when(key % 24 == 0, F.lit("")).otherwise((key % 24).cast("string"))
    stamp = C.timestamp_from_parts(
        F.date_format("o_orderdate", "yy"), F.date_format("o_orderdate", "MM"), F.date_format("o_orderdate", "dd"), hour,
        (key % 60).cast("string"),
    )
    return t.orders.select("o_orderkey", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamp"))


@query(
    "p18_parse_date",
    "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day FROM orders",
)
def _(t):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    rows = t.orders.select("o_orderkey", text.alias("d"))
    return rows.select("o_orderkey", F.date_format(C.parse_date("d", ["dd/MM/yyyy", "yyyy-MM-dd"]), "yyyy-MM-dd").alias("day"))


@query(
    "p19_calendar_features",
    "SELECT o_orderkey, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, "
    "CAST(isodow(d) - 1 AS INT) AS weekday, CAST(week(d) AS INT) AS week, CAST(date_diff('day', DATE '1970-01-01', d) AS INT) AS n_days, "
    "CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS isweekend, CAST(quarter(d) AS INT) AS quarter, "
    "CAST(date_diff('day', DATE '2013-01-01', d) AS INT) AS days_from_origin FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)",
)
def _(t):
    return C.calendar_features(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


_HOLIDAYS = "SELECT CAST(ts AS DATE) AS h FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 60"


@query(
    "p20_holiday_features",
    f"WITH h AS ({_HOLIDAYS}), e AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events), f AS (SELECT event_id, d, "
    "(d IN (SELECT h FROM h)) AS a0, (d + 1 IN (SELECT CAST(h AS TIMESTAMP) FROM h)) AS n1, (d + 2 IN (SELECT CAST(h AS TIMESTAMP) FROM h)) AS n2, "
    "(d - 1 IN (SELECT CAST(h AS TIMESTAMP) FROM h)) AS l1, (d - 2 IN (SELECT CAST(h AS TIMESTAMP) FROM h)) AS l2 FROM e) "
    "SELECT event_id, CAST(a0 AS INT) AS \"isHoliday\", CAST(a0 OR n1 OR n2 AS INT) AS \"isHoliday_in_next_days\", "
    "CAST(a0 OR l1 OR l2 AS INT) AS \"isHoliday_in_last_days\", CAST(a0 OR n1 OR n2 OR l1 OR l2 AS INT) AS \"isHoliday_within_days\" FROM f",
)
def _(t):
    holidays = (
        t.events.where(F.col("event_type") == "error").groupBy(F.to_date("ts").alias("holiday"))
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 60).select("holiday")
    )
    return C.holiday_features(t.events.select("event_id", "ts"), "ts", holidays, 2).drop("ts")


@query(
    "p21_add_weeks",
    "SELECT l_orderkey, l_partkey, l_linenumber, strftime(CAST(l_shipdate AS DATE) + CAST(7 * (l_linenumber - 1) AS INT), '%Y-%m-%d') "
    "AS day FROM lineitem",
)
def _(t):
    day = C.add_weeks(F.to_date("l_shipdate"), "l_linenumber")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query(
    "p22_haversine",
    "WITH p AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 90 AS a1, CAST(embedding[2] AS DOUBLE) * 180 AS o1, "
    "CAST(embedding[3] AS DOUBLE) * 90 AS a2, CAST(embedding[4] AS DOUBLE) * 180 AS o2 "
    "FROM embeddings), h AS (SELECT vec_id, sin((radians(a2) - radians(a1)) / 2) ** 2 + cos(radians(a1)) * cos(radians(a2)) * "
    "sin((radians(o2) - radians(o1)) / 2) ** 2 AS a FROM p) SELECT vec_id, round(6373.0 * 2 * atan2(sqrt(a), sqrt(1 - a)), 4) AS km FROM h",
)
def _(t):
    e = [F.col("embedding")[i].cast("double") for i in range(4)]
    km = C.haversine_km(e[0] * 90.0, e[1] * 180.0, e[2] * 90.0, e[3] * 180.0)
    return t.embeddings.select("vec_id", F.round(km, 4).alias("km"))


@query(
    "p23_rate_columns",
    "SELECT c_nationkey, count(*) AS \"Population\", round(count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END) / count(*) * 100, 6) AS "
    "\"Taux de BUILDING\", round(count(CASE WHEN c_acctbal < 0 THEN 1 END) / count(*) * 100, 6) AS \"Taux de debt\" FROM customer "
    "GROUP BY c_nationkey",
)
def _(t):
    counts = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("Population"), F.count_if(F.col("c_mktsegment") == "BUILDING").alias("Nb BUILDING"),
        F.count_if(F.col("c_acctbal") < 0).alias("Nb debt"),
    )
    rates = C.rate_columns(counts)
    return rates.select(
        "c_nationkey", "Population", *[F.round(f"`{c}`", 6).alias(c) for c in rates.columns if c.startswith("Taux de ")]
    )


@query(
    "p24_per_million",
    "SELECT n_name, round(count(o_orderkey) / (nullif(count(DISTINCT c_custkey), 0) / 1000000.0), 4) AS rate FROM nation LEFT JOIN customer "
    "ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_name",
)
def _(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    by_nation = (
        t.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_nationkey")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("orders"), F.count(F.lit(1)).alias("people"))
    )
    rows = t.nation.join(by_nation, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.select("n_name", F.round(C.per_million(F.coalesce("orders", F.lit(0)), "people"), 4).alias("rate"))


@query(
    "p25_zscore",
    "SELECT l_orderkey, l_partkey, l_linenumber, round((l_quantity - m) / s, 6) AS l_quantity_z, round((ln(l_extendedprice) - lm) / ls, 6) AS "
    "log_price_z FROM lineitem, (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s, avg(ln(l_extendedprice)) AS lm, "
    "stddev_pop(ln(l_extendedprice)) AS ls FROM lineitem)",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.log("l_extendedprice").alias("log_price"))
    z = C.zscore(rows, ["l_quantity", "log_price"])
    return z.select(
        "l_orderkey", "l_partkey", "l_linenumber", F.round("l_quantity_z", 6).alias("l_quantity_z"), F.round("log_price_z", 6).alias("log_price_z")
    )


@query(
    "p26_profile_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS kind, count(DISTINCT {c}) AS distinct_values, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM customer"
        for c, k in (
            ("c_custkey", "numeric"), ("c_name", "categorical"), ("c_nationkey", "numeric"), ("c_acctbal", "numeric"), ("c_mktsegment", "categorical"),
        )
    ),
)
def _(t):
    return C.profile_columns(t.customer)


_RECORD = (
    "SELECT 15 AS lead, year(o_orderdate) AS y, CAST(round(o_totalprice / 1000) AS INT) AS temp, CAST(o_orderkey % 10 AS INT) AS q, "
    "o_orderkey % 7 = 0 AS lost FROM orders"
)


@query(
    "p27_parse_weather",
    f"SELECT CAST(y AS INT) AS year, CASE WHEN odd THEN -temp ELSE temp END AS temp, count(*) AS n FROM (SELECT *, q % 2 = 1 AS odd FROM ({_RECORD})) "
    "WHERE NOT lost AND q IN (0, 1, 4, 5, 9) GROUP BY ALL",
)
def _(t):
    key = F.col("o_orderkey")
    temp = F.lpad(F.round(F.col("o_totalprice") / 1000).cast("int").cast("string"), 4, "0")
    sign = F.when(key % 2 == 1, F.lit("-")).otherwise(F.lit("+"))
    reading = F.when(key % 7 == 0, F.lit("+9999")).otherwise(F.concat(sign, temp))
    line = F.concat(
        F.lit("0" * 15), F.year("o_orderdate").cast("string"), F.lit("x" * 68), reading, (key % 10).cast("string"), F.lit("zz")
    )
    records = t.orders.select(line.alias("value"))
    return C.parse_weather(records).groupBy("year", "temp").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f02_flag_columns",
    "SELECT o_orderkey, tags, CAST(list_contains(string_split(tags, ','), '1-URGENT') AS INT) AS \"1-URGENT\", CAST(list_contains(string_split(tags, ','), 'F') AS INT) AS \"F\", CAST(list_contains(string_split(tags, ','), 'O') AS INT) AS \"O\", "
    "CAST(CAST(list_contains(string_split(tags, ','), '1-URGENT') AS INT) AS VARCHAR) || CAST(CAST(list_contains(string_split(tags, ','), 'F') AS INT) AS VARCHAR) || CAST(CAST(list_contains(string_split(tags, ','), 'O') AS INT) AS VARCHAR) AS code "
    "FROM (SELECT o_orderkey, o_orderpriority || ',' || o_orderstatus AS tags FROM orders)",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.concat_ws(",", "o_orderpriority", "o_orderstatus").alias("tags"))
    return flag_columns(rows, "tags", ["1-URGENT", "F", "O"])
