"""Time series and composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import timeseries as TS
from lodestar.operators.reshape import column_values
from lodestar.plans import accident_codes as codes
from lodestar.plans import jobs
from lodestar.plans.registry import query


@query(
    "ts01_resample_daily",
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, round(avg(value), 6) AS mean, max(value) AS max, round(stddev_samp(value), 6) AS std FROM events GROUP BY ALL",
)
def _(t):
    out = TS.resample(t.events, "ts", "day", {"mean": F.avg("value"), "max": F.max("value"), "std": F.stddev_samp("value")})
    return out.select(F.date_format("period", "yyyy-MM-dd").alias("day"), F.round("mean", 6).alias("mean"), "max", F.round("std", 6).alias("std"))


@query(
    "ts01_resample_gaps",
    "WITH p AS (SELECT user_id, ts, value FROM events WHERE event_type = 'purchase'), d AS (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM p), "
    "(SELECT date_trunc('hour', max(ts)) FROM p), INTERVAL 1 HOUR)) AS h) SELECT strftime(h, '%Y-%m-%d %H') AS hour, count(value) AS n, round(coalesce(max(value), -1), 4) AS max FROM d LEFT JOIN p ON date_trunc('hour', ts) = h "
    "GROUP BY ALL",
)
def _(t):
    rows = t.events.where(F.col("event_type") == "purchase")
    out = TS.resample(rows, "ts", "hour", {"n": F.count("value"), "max": F.max("value")}, fill_gaps=True)
    return out.select(
        F.date_format("period", "yyyy-MM-dd HH").alias("hour"), F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("max", F.lit(-1.0)), 4).alias("max")
    )


@query(
    "ts02_date_range",
    "WITH r AS (SELECT unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT max(ts) FROM events), INTERVAL 3 HOUR)) AS h) SELECT strftime(h, '%Y-%m-%d %H:%M') AS slot, count(event_id) AS n FROM r "
    "LEFT JOIN events ON time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '2024-01-01') = h GROUP BY ALL",
)
def _(t):
    b = t.events.agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("lo"),
        F.floor((F.unix_seconds(F.max("ts").cast("timestamp")) - F.unix_seconds(F.date_trunc("day", F.min("ts")).cast("timestamp"))) / 10800).alias("n"),
    ).first()
    slots = TS.date_range(t.spark, b["lo"], int(b["n"]) + 1, "3 hours", "slot")
    counts = t.events.groupBy(F.window("ts", "3 hours")["start"].cast("timestamp_ntz").alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    out = slots.join(counts, "slot", "left")
    return out.select(F.date_format("slot", "yyyy-MM-dd HH:mm").alias("slot"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "ts03_seasonality",
    "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY ALL",
)
def _(t):
    return TS.seasonality(t.orders, "o_orderdate", "o_totalprice").withColumn("mean", F.round("mean", 4))


def _cases(t):
    """Errors per nation of the user (user id as customer key) in one column per day, running over the month."""
    named = t.events.join(t.customer, F.col("user_id") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    daily = named.select(
        F.col("c_mktsegment").alias("Province"), F.when(F.col("n_name") == "NATION_1", "US").otherwise(F.col("n_name")).alias("Country"),
        F.lit(0.0).alias("Lat"), F.lit(0.0).alias("Long"), F.date_format("ts", "M/d/yy").alias("day"),
    )
    # the days are those of the events
    return daily.groupBy("Province", "Country", "Lat", "Long").pivot("day", column_values(daily, "day")).agg(F.count(F.lit(1)))


_PANEL_SQL = (
    "WITH c AS (SELECT CASE WHEN n_name = 'NATION_1' THEN 'USA' ELSE n_name END AS \"Country\", 'A' || n_nationkey AS alpha3, n_regionkey AS region, n_nationkey AS k FROM nation), "
    "pop AS (SELECT c_nationkey AS k, CAST(count(*) AS DOUBLE) * 1000 AS total_pop, count(CASE WHEN c_acctbal > 5000 THEN 1 END) * 1000.0 AS pop_65up FROM customer GROUP BY c_nationkey), "
    "d AS (SELECT c_nationkey AS k, CAST(ts AS DATE) AS date, count(*) AS value FROM events JOIN customer ON user_id = c_custkey GROUP BY ALL), "
    "g AS (SELECT k, date, sum(coalesce(value, 0)) AS value FROM (SELECT DISTINCT k FROM d) CROSS JOIN (SELECT DISTINCT date FROM d) LEFT JOIN d USING (k, date) GROUP BY ALL), "
    "f AS (SELECT k, min(date) AS first FROM g WHERE value >= {threshold} GROUP BY k) "
    "SELECT alpha3, \"Country\", CAST(region AS VARCHAR) AS region, strftime(date, '%Y-%m-%d') AS date, CAST(value AS DOUBLE) AS value, CAST(date - first AS INT) AS day, round(value / (total_pop / 1000000), 6) AS rate_1M_pop, "
    "round(value / (nullif(pop_65up, 0) / 1000000), 6) AS rate_1M_pop_65up FROM g JOIN f USING (k) JOIN c USING (k) JOIN pop USING (k) WHERE date >= first"
)


def _panel(t, threshold, top=None):
    countries = t.nation.select(
        F.when(F.col("n_name") == "NATION_1", "United States of America").otherwise(F.col("n_name")).alias("Country"),
        F.concat(F.lit("A"), "n_nationkey").alias("alpha3"), F.col("n_regionkey").cast("string").alias("region"), F.lit("x").alias("subregion"),
    )
    people = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("all"), F.count_if(F.col("c_acctbal") > 5000).alias("old")
    )
    series = people.select(
        F.concat(F.lit("A"), "c_nationkey").alias("alpha3"),
        F.explode(
            F.array(
                F.struct(F.lit("SP.POP.65UP.TO").alias("series"), (F.col("old") * 1000).cast("string").alias("value")),
                F.struct(F.lit("SP.POP.0014.TO").alias("series"), ((F.col("all") - F.col("old")) * 1000).cast("string").alias("value")),
                F.struct(F.lit("SP.POP.1564.TO").alias("series"), F.lit("..").alias("value")),
            )
        ).alias("s"),
    ).select("alpha3", "s.*")
    cases = _cases(t).na.fill(0)
    panel = jobs.epidemic_panel(cases, countries, series, threshold=threshold, top=top)
    return panel.select(
        "alpha3", "Country", "region", F.date_format("date", "yyyy-MM-dd").alias("date"), "value", "day", F.round("rate_1M_pop", 6).alias("rate_1M_pop"),
        F.round("rate_1M_pop_65up", 6).alias("rate_1M_pop_65up"),
    )


@query("ts04_epidemic_panel", _PANEL_SQL.format(threshold=10))
def _(t):
    return _panel(t, 10)


@query(
    "ts04_epidemic_top",
    "WITH p AS (" + _PANEL_SQL.format(threshold=5) + ") SELECT * FROM p WHERE \"Country\" IN (SELECT \"Country\" FROM p GROUP BY \"Country\" ORDER BY max(value) DESC, \"Country\" LIMIT 10)",
)
def _(t):
    return _panel(t, 5, 10)


@query(
    "ts05_population_totals",
    "SELECT 'A' || c_nationkey AS alpha3, CAST(count(*) * 1000 AS DOUBLE) AS total_pop, CAST(count(CASE WHEN c_acctbal > 5000 THEN 1 END) * 1000 AS DOUBLE) AS pop_65up FROM customer GROUP BY c_nationkey",
)
def _(t):
    rows = t.customer.select(
        F.concat(F.lit("A"), "c_nationkey").alias("alpha3"),
        F.when(F.col("c_acctbal") > 5000, "SP.POP.65UP.TO").otherwise("SP.POP.1564.TO").alias("series"),
    ).groupBy("alpha3", "series").agg((F.count(F.lit(1)) * 1000).cast("string").alias("value"))
    gaps = t.nation.select(F.concat(F.lit("A"), "n_nationkey").alias("alpha3"), F.lit("SP.POP.0014.TO").alias("series"), F.lit("..").alias("value"))
    out = jobs.population_totals(rows.unionByName(gaps))
    return out.select("alpha3", "total_pop", F.coalesce("pop_65up", F.lit(0.0)).alias("pop_65up"))


def _accidents(t):
    """Accident tables made from orders (accidents), customers (places), lines (vehicles and users)."""
    o = t.orders
    code = lambda c, n: F.pmod(F.col(c), F.lit(n)).cast("string")
    car = o.select(
        F.col("o_orderkey").alias("Num_Acc"), F.pmod(F.year("o_orderdate"), F.lit(100)).alias("an"), F.month("o_orderdate").alias("mois"), F.dayofmonth("o_orderdate").alias("jour"),
        F.concat(F.when(F.col("o_custkey") % 24 == 0, "").otherwise(code("o_custkey", 24)), F.lpad(code("o_orderkey", 60), 2, "0")).alias("hrmn"),
        code("o_custkey", 6).alias("lum"), code("o_custkey", 3).alias("agg"), code("o_orderkey", 10).alias("int"), code("o_custkey", 10).alias("atm"), code("o_orderkey", 8).alias("col"),
        F.col("o_totalprice").alias("lat"), F.col("o_totalprice").alias("long"), code("o_custkey", 95).alias("dep"),
    )
    lieux = o.select(F.col("o_orderkey").alias("Num_Acc"), F.col("o_orderpriority").alias("catr"), F.col("o_orderstatus").alias("nbv"))
    keys = t.lineitem.select(F.col("l_orderkey").alias("Num_Acc"), F.col("l_linenumber").alias("num_veh"), "l_partkey", "l_suppkey")
    two = lambda c, n: F.lpad(code(c, n), 2, "0")
    veh = keys.groupBy("Num_Acc", "num_veh").agg(F.min("l_suppkey").alias("s"), F.min("l_partkey").alias("p")).select(
        "Num_Acc", "num_veh", two("s", 42).alias("catv"), code("p", 10).alias("choc"), two("p", 26).alias("manv"), two("s", 17).alias("obs")
    )
    usa = keys.select("Num_Acc", "num_veh", code("l_partkey", 5).alias("grav"), code("l_suppkey", 33).alias("secu"))
    return car, lieux, veh, usa


@query(
    "ts06_accident_features",
    "WITH c AS (SELECT o_orderkey AS id, o_custkey % 6 AS lum, o_custkey % 3 AS agg, o_orderkey % 10 AS crossing, o_custkey % 10 AS atm, o_orderkey % 8 AS col, 2000 + year(o_orderdate) % 100 AS y, o_orderpriority AS catr FROM orders), "
    "s AS (SELECT id, catr, CASE agg WHEN 1 THEN -100 WHEN 2 THEN 100 END AS ca, CASE lum WHEN 1 THEN 100 WHEN 2 THEN 50 WHEN 3 THEN 0 WHEN 4 THEN 5 WHEN 5 THEN 20 END AS cl, "
    "CASE WHEN crossing = 0 THEN 0 WHEN crossing = 1 THEN -100 ELSE 100 END AS ci, CASE atm WHEN 1 THEN 100 WHEN 2 THEN 10 WHEN 3 THEN -90 WHEN 4 THEN -100 WHEN 5 THEN -10 WHEN 6 THEN -50 WHEN 7 THEN 50 WHEN 8 THEN 8 ELSE 0 END AS cw, "
    "CASE WHEN col = 0 THEN 0 WHEN col = 7 THEN 100 ELSE -100 END AS cc FROM c WHERE y = 2000), "
    "u AS (SELECT l_orderkey AS id, l_linenumber, CASE l_partkey % 5 WHEN 1 THEN 0 WHEN 2 THEN 200 WHEN 3 THEN 50 WHEN 4 THEN 10 END AS grav, CAST(l_suppkey % 33 AS VARCHAR) AS secu FROM lineitem) "
    "SELECT catr, coalesce(CASE left(secu, 1) WHEN '0' THEN NULL WHEN '1' THEN 'Ceinture' WHEN '2' THEN 'Casque' WHEN '3' THEN 'Dispositif enfants' WHEN '4' THEN 'Equipement réfléchissant' WHEN '9' THEN 'Autre' ELSE left(secu, 1) END, '?') AS equipment, count(*) AS n, CAST(sum(ca) AS DOUBLE) AS agglomeration, CAST(sum(cl) AS DOUBLE) AS light, CAST(sum(ci) AS DOUBLE) AS crossing, CAST(sum(cw) AS DOUBLE) AS weather, CAST(sum(cc) AS DOUBLE) AS collision, "
    "CAST(sum(grav) AS DOUBLE) AS severity, count(CASE WHEN length(secu) > 1 AND substr(secu, 2) <> '0' THEN 1 END) AS used FROM u JOIN s USING (id) GROUP BY ALL",
)
def _(t):
    features = jobs.accident_features(*_accidents(t), year=2000)
    return features.groupBy("catr", F.coalesce("secup", F.lit("?")).alias("equipment")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Code_Agglomeration").alias("agglomeration"), F.sum("Code_Lumiere").alias("light"), F.sum("Code_Intersection").alias("crossing"),
        F.sum("Code_Atmosphere").alias("weather"), F.sum("Code_Collision").alias("collision"), F.sum("grav_num").alias("severity"), F.count("secuu").alias("used"),
    )


def _labels_sql(column: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE {column} WHEN '0' THEN NULL WHEN '00' THEN NULL {cases} ELSE {column} END"


@query(
    "ts06_vehicle_labels",
    "WITH v AS (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS s, min(l_partkey) AS p FROM lineitem GROUP BY ALL), c AS (SELECT lpad(CAST(s % 42 AS VARCHAR), 2, '0') AS catv, CAST(p % 10 AS VARCHAR) AS choc, lpad(CAST(p % 26 AS VARCHAR), 2, '0') AS manv FROM v) "
    f"SELECT {_labels_sql('catv', codes.VEHICLES['catv'])} AS vehic_category, coalesce({_labels_sql('choc', codes.VEHICLES['choc'])}, '(Other)') AS vehic_choc, coalesce({_labels_sql('manv', codes.VEHICLES['manv'])}, '(Other)') AS vehic_manoeuvre, count(*) AS n FROM c GROUP BY ALL",
)
def _(t):
    vehicles = jobs.accident_vehicles(_accidents(t)[2])
    return vehicles.groupBy("vehic_category", "vehic_choc", "vehic_manoeuvre").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p08_obstacles",
    f"SELECT {_labels_sql('obs', codes.VEHICLES['obs'])} AS obs, count(*) AS n FROM (SELECT lpad(CAST(min(l_suppkey) % 17 AS VARCHAR), 2, '0') AS obs FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY ALL",
)
def _(t):
    rows = jobs.recode_columns(_accidents(t)[2].select("obs"), codes.VEHICLES)
    return rows.groupBy("obs").agg(F.count(F.lit(1)).alias("n"))


def _sales(t):
    """Sales tables made from orders, order lines, parts and customers."""
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    mutation = o.select(
        F.col("o_orderkey").alias("idmutation"), F.col("o_orderdate").alias("datemut"), F.col("o_totalprice").alias("valeurfonc"), (F.col("c_custkey") % 12000).alias("sterr"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 1000).alias("geolong"), (F.col("c_acctbal") / 500 + 30).alias("geolat"),
    )
    lines = t.lineitem.select(F.col("l_orderkey").alias("idmutation"), F.col("l_partkey").alias("iddispopar"), F.col("l_suppkey").alias("iddispoloc"), "l_quantity", "l_linenumber")
    local = lines.groupBy("idmutation", "iddispopar", "iddispoloc").agg(F.max("l_linenumber").cast("double").alias("nbpprinc"), (F.max("l_quantity") * 12).alias("sbati"))
    parcelle = lines.select("idmutation", "iddispopar").distinct().join(
        t.part.select(F.col("p_partkey").alias("iddispopar"), F.col("p_brand").alias("commune"), F.col("p_size").cast("string").alias("departement")), "iddispopar"
    )
    adresse = t.supplier.select(F.col("s_suppkey").alias("iddispoloc"), F.col("s_name").alias("communelabel"))
    communes = t.part.groupBy(F.col("p_brand").alias("commune"), F.col("p_size").cast("string").alias("departement")).agg(F.count(F.lit(1)).alias("Population"))
    places = t.part.groupBy(F.col("p_brand").alias("commune")).agg((F.avg("p_size")).cast("string").alias("latitude"), (F.avg("p_retailprice") / 100).cast("string").alias("longitude"))
    return mutation, local, parcelle, adresse, communes, places


_SALES = (
    "WITH m AS (SELECT o_orderkey AS id, o_orderdate AS d, o_totalprice AS v, c_custkey % 12000 AS st, CASE WHEN c_acctbal > 0 THEN c_acctbal / 1000 END AS lon, c_acctbal / 500 + 30 AS lat FROM orders JOIN customer ON o_custkey = c_custkey), "
    "l AS (SELECT l_orderkey AS id, l_partkey AS par, l_suppkey AS loc, max(l_linenumber) AS rooms, max(l_quantity) * 12 AS built FROM lineitem GROUP BY ALL), p AS (SELECT p_partkey AS par, p_brand AS commune, CAST(p_size AS VARCHAR) AS dep FROM part), "
    "cs AS (SELECT p_brand AS commune, CAST(p_size AS VARCHAR) AS dep, count(*) AS pop FROM part GROUP BY ALL), big AS (SELECT dep, commune FROM (SELECT *, row_number() OVER (PARTITION BY dep ORDER BY pop DESC, commune) AS rn FROM cs) WHERE rn = 1), "
    "pl AS (SELECT p_brand AS commune, avg(p_size) AS blat, avg(p_retailprice) / 100 AS blon FROM part GROUP BY ALL), "
    "j AS (SELECT m.*, l.loc, rooms, built, p.commune, p.dep, blat, blon FROM m JOIN l USING (id) JOIN p USING (par) LEFT JOIN big ON big.dep = p.dep LEFT JOIN pl ON pl.commune = big.commune WHERE p.dep <= '4' AND lon IS NOT NULL AND lat IS NOT NULL "
    "AND v > 10 AND v < 1000000 AND st < 10000 AND rooms > 0 AND rooms <= 10 AND built <= 500), "
    "h AS (SELECT *, sin(radians(blat - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(blat)) * sin(radians(blon - lon) / 2) ** 2 AS a FROM j) "
    "SELECT dep AS departement, CAST(quarter(d) AS INT) AS quarter, count(*) AS n, CAST(sum(date_diff('day', DATE '2013-01-01', CAST(d AS DATE))) AS BIGINT) AS days, round(avg(6373.0 * 2 * atan2(sqrt(a), sqrt(1 - a))), 2) AS dist FROM h GROUP BY ALL"
)


@query("ts07_house_sales", _SALES)
def _(t):
    mutation, local, parcelle, adresse, communes, places = _sales(t)
    # text order of departments, as in the source data: '4' keeps '1', '10' .. '39' and '4'
    sales = jobs.house_sales(mutation, local, parcelle, adresse).where(F.col("departement") <= "4")
    prepared = jobs.prepare_sales(sales, jobs.big_cities(communes, places))
    return prepared.groupBy("departement", "quarter").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_days").alias("days"), F.round(F.avg("department_city_dist"), 2).alias("dist")
    )


@query(
    "ts08_hr_queries",
    "SELECT 'highest' AS query, '' AS name, CAST(max(o_totalprice) AS DOUBLE) AS value FROM orders UNION ALL SELECT * FROM (SELECT 'best_paid', CAST(o_orderkey AS VARCHAR), CAST(o_totalprice AS DOUBLE) FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) "
    "UNION ALL SELECT 'jobs', n_name, CAST(count(s_suppkey) AS DOUBLE) FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY n_name",
)
def _(t):
    t.orders.select(F.col("o_orderkey").alias("employee_num"), F.col("o_totalprice").alias("salary")).createOrReplaceTempView("lodestar_salaries")
    t.nation.select(F.col("n_nationkey").alias("desk_id"), F.col("n_name").alias("job_name")).createOrReplaceTempView("lodestar_jobs")
    t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("desk_id")).createOrReplaceTempView("lodestar_history")
    out = jobs.hr_queries(t.spark, "lodestar_salaries", "lodestar_jobs", "lodestar_history")
    shape = lambda df, q, name, value: df.select(F.lit(q).alias("query"), name.alias("name"), F.col(value).cast("double").alias("value"))
    return (
        shape(out["highest"], "highest", F.lit(""), "salary")
        .unionByName(shape(out["best_paid"], "best_paid", F.col("employee_num").cast("string"), "salary"))
        .unionByName(shape(out["jobs"], "jobs", F.col("job_name"), "n"))
    )


@query(
    "ts09_departure_features",
    "WITH h AS (SELECT CAST(ts AS DATE) AS d FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) >= 60), x AS (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL), "
    "e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events) SELECT event_id, CAST(isodow(d) - 1 AS INT) AS weekday, CAST(week(d) AS INT) AS week, CAST(EXISTS (SELECT 1 FROM h WHERE abs(date_diff('day', h.d, e.d)) <= 2) AS INT) AS near, "
    "CAST(coalesce((SELECT sum(n) FROM x WHERE x.user_id = e.user_id AND e.d - x.d BETWEEN 0 AND 2), 0) AS BIGINT) AS events FROM e",
)
def _(t):
    errors = t.events.where("event_type = 'error'")
    holidays = errors.groupBy(F.to_date("ts").alias("holiday")).agg(F.count(F.lit(1)).alias("n")).where("n >= 60").select("holiday")
    out = jobs.departure_features(t.events.select("event_id", "user_id", "ts"), holidays, errors.select("user_id", "ts"), "ts", "user_id")
    return out.select("event_id", "weekday", "week", F.col("isHoliday_within_days").alias("near"), F.col("event_in_next_days").alias("events"))
