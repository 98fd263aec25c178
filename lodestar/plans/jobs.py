"""Composite jobs: epidemic panel, accident features, house sales, staff queries, departures, post features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.columns import (
    calendar_features,
    collapse_levels,
    filter_extremes,
    haversine_km,
    holiday_features,
    per_million,
    recode,
    recode_join,
    score_labels,
    split_at,
    timestamp_from_parts,
)
from lodestar.functions.text import clean_text, html_to_text, tag_array, tag_flags, tokenize, weighted_text
from lodestar.operators.joins import denormalise, events_in_window
from lodestar.operators.reshape import melt
from lodestar.operators.rows import days_since_threshold, dedup_first, top_groups
from lodestar.plans import accident_codes as codes

# Country names of the code table and of the case table that need another spelling.
COUNTRY_NAMES = {
    "Bolivia (Plurinational State of)": "Bolivia",
    "Brunei Darussalam": "Brunei",
    "Congo, Democratic Republic of the": "Congo",
    "Iran (Islamic Republic of)": "Iran",
    "Korea, Republic of": "Korea, South",
    "Moldova, Republic of": "Moldova",
    "Russian Federation": "Russia",
    "Taiwan, Province of China": "Taiwan",
    "Tanzania, United Republic of": "Tanzania",
    "United Kingdom of Great Britain and Northern Ireland": "United Kingdom",
    "United States of America": "USA",
    "Venezuela (Bolivarian Republic of)": "Venezuela",
    "Syrian Arab Republic": "Syria",
    "Lao People's Democratic Republic": "Laos",
}
CASE_COUNTRY_NAMES = {"Cote d'Ivoire": "Côte d'Ivoire", "Taiwan*": "Taiwan", "US": "USA", "Vietnam": "Viet Nam"}
# Population series by age band.
AGE_SERIES = ("SP.POP.0014.TO", "SP.POP.1564.TO", "SP.POP.65UP.TO")
OLD_SERIES = "SP.POP.65UP.TO"


# --- epidemic panel --------------------------------------------------------------------------------


def population_totals(pop: DataFrame) -> DataFrame:
    """Total and 65+ population per country from rows ``alpha3, series, value`` (text, '..' is missing)."""
    number = F.col("value").try_cast("double")
    rows = pop.where(F.col("alpha3").isNotNull() & (F.col("value") != ".."))
    return rows.groupBy("alpha3").agg(
        F.sum(F.when(F.col("series").isin(list(AGE_SERIES)), number)).alias("total_pop"),
        F.sum(F.when(F.col("series") == OLD_SERIES, number)).alias("pop_65up"),
    )


def panel_rates(daily: DataFrame, key: str, threshold: float = 10) -> DataFrame:
    """Days since the threshold and rates per million for ``key, date, value, total_pop, pop_65up``."""
    days = days_since_threshold(daily, key, "date", "value", threshold)
    return days.withColumns(
        {
            "rate_1M_pop": per_million("value", "total_pop"),
            "rate_1M_pop_65up": per_million("value", "pop_65up"),
        }
    )


def epidemic_panel(
    cases: DataFrame, countries: DataFrame, population: DataFrame, date_format: str = "M/d/yy", threshold: float = 10,
    top: int | None = None,
) -> DataFrame:
    """Daily cases per country from a wide table: recode, enrich, unpivot, sum, align on the threshold day.

    ``cases``: Province, Country, Lat, Long and one column per day. ``countries``: Country, alpha3,
    region, subregion. ``population``: alpha3, series, value.
    """
    ids = ["Province", "Country", "Lat", "Long"]
    codes = countries.withColumn("Country", recode("Country", COUNTRY_NAMES, nulls=()))
    named = cases.withColumn("Country", recode("Country", CASE_COUNTRY_NAMES, nulls=()))
    long = melt(named, ids, var="day_name", value="value")
    daily = long.groupBy("Country", "day_name").agg(F.sum(F.col("value").try_cast("double")).alias("value"))
    panel = (
        daily.join(codes.select("Country", "alpha3", "region", "subregion"), "Country")
        .where(F.col("alpha3").isNotNull())
        .join(population_totals(population), "alpha3")
        .where(F.col("total_pop").isNotNull() & F.col("pop_65up").isNotNull())
        .withColumn("date", F.to_date("day_name", date_format))
        .drop("day_name")
    )
    out = panel_rates(panel, "alpha3", threshold)
    return top_groups(out, "Country", "value", top) if top else out


# --- accidents -------------------------------------------------------------------------------------


def accident_characteristics(car: DataFrame) -> DataFrame:
    """Typed, labelled accident rows: timestamp from parts, code lists, positions in degrees."""
    hour, minute = split_at("hrmn", -2)
    return car.select(
        "Num_Acc",
        timestamp_from_parts(F.col("an"), F.col("mois"), F.col("jour"), hour, minute).alias("date"),
        *[recode(c, table).alias(c) for c, table in codes.CHARACTERISTICS.items() if c in car.columns],
        (F.col("lat") / 1e5).alias("lat"),
        (F.col("long") / 1e5).alias("long"),
        "dep",
    )


def accident_scores(characteristics: DataFrame, year: int | None = 2017) -> DataFrame:
    """Labels with their scores and the year, under the final column names."""
    crossing = collapse_levels(
        "int",
        {"Hors Intersection": ["Hors intersection"], "Avec Intersection": [v for k, v in codes.CROSSING.items() if k != "1"]},
    )
    collision = collapse_levels(
        "col", {"Sans collision": ["Sans collision"], "Avec collision": [v for k, v in codes.COLLISION.items() if k != "7"]}
    )
    weather = F.coalesce("atm", F.lit("(Inconnu)"))
    out = characteristics.select(
        "Num_Acc",
        F.col("lum").alias("Lumiere"),
        F.col("agg").alias("Agglomeration"),
        F.col("int").alias("Intersection"),
        weather.alias("Atmosphere"),
        F.col("col").alias("Collision"),
        score_labels("agg", codes.BUILT_UP_SCORE).alias("Code_Agglomeration"),
        score_labels("lum", codes.LIGHT_SCORE).alias("Code_Lumiere"),
        score_labels(crossing, codes.CROSSING_SCORE).alias("Code_Intersection"),
        score_labels(weather, codes.WEATHER_SCORE).alias("Code_Atmosphere"),
        score_labels(collision, codes.COLLISION_SCORE).alias("Code_Collision"),
        F.year("date").alias("Annee"),
    )
    return out if year is None else out.where(F.col("Annee") == year)


def recode_columns(df: DataFrame, tables: dict[str, dict[str, str]]) -> DataFrame:
    """Labels for every column that has a code list."""
    return df.withColumns({c: recode(c, table, codes.UNKNOWN) for c, table in tables.items() if c in df.columns})


def accident_users(usa: DataFrame) -> DataFrame:
    """Users with labels, the safety code split into equipment and use, and the severity score."""
    equipment, used = split_at("secu", 1)
    rows = usa.withColumns({"secup": equipment, "secuu": used}).drop("secu")
    return recode_columns(rows, codes.USERS).withColumn("grav_num", score_labels("grav", codes.SEVERITY_SCORE))


def accident_vehicles(veh: DataFrame, category_codes: DataFrame | None = None) -> DataFrame:
    """Vehicles with labels; ``category_codes(code, label)`` names categories in place of the published list."""
    rows = veh if category_codes is None else recode_join(veh, "catv", category_codes)
    tables = codes.VEHICLES if category_codes is None else {c: v for c, v in codes.VEHICLES.items() if c != "catv"}
    other = F.lit("(Other)")
    return recode_columns(rows, tables).select(
        "Num_Acc", "num_veh", F.col("catv").alias("vehic_category"), F.coalesce("choc", other).alias("vehic_choc"),
        F.coalesce("manv", other).alias("vehic_manoeuvre"),
    )


def accident_features(
    car: DataFrame, lieux: DataFrame, veh: DataFrame, usa: DataFrame, year: int | None = 2017,
    category_codes: DataFrame | None = None,
) -> DataFrame:
    """One row per user of an accident with vehicle, place, scores and severity."""
    scores = accident_scores(accident_characteristics(car), year)
    places = recode_columns(lieux.select("Num_Acc", "catr", "nbv"), codes.PLACES)
    return (
        accident_users(usa)
        .join(accident_vehicles(veh, category_codes), ["Num_Acc", "num_veh"])
        .join(scores, "Num_Acc")
        .join(places, "Num_Acc")
    )


# --- house sales -----------------------------------------------------------------------------------


def big_cities(communes: DataFrame, places: DataFrame) -> DataFrame:
    """Position of the most populous commune per department (smallest code on ties): one row each."""
    sized = communes.select("departement", "commune", (-F.col("Population")).alias("_size"))
    first = dedup_first(sized, ["departement"], ["_size", "commune"])
    number = lambda c: F.when(F.col(c) != "NaN", F.col(c)).cast("double")
    spots = dedup_first(places.select("commune", "latitude", "longitude"), ["commune"], ["latitude", "longitude"])
    return first.join(spots, "commune", "left").select(
        "departement", number("latitude").alias("DepBigCity_lat"), number("longitude").alias("DepBigCity_long")
    )


def house_sales(
    mutation: DataFrame, local: DataFrame, parcelle: DataFrame, adresse: DataFrame, communes: DataFrame | None = None,
    departement: str = "All", year: int | None = None,
) -> DataFrame:
    """Joined sales with a known department and position, the day number and the quarter."""
    out = denormalise(mutation, local, parcelle, adresse, communes)
    if departement == "Metropole":
        out = out.where(F.col("departement") <= "96")
    elif departement != "All":
        out = out.where(F.col("departement") == departement)
    out = out.where((F.col("departement") != "None") & F.col("geolong").isNotNull() & F.col("geolat").isNotNull())
    if year is not None:
        out = out.where(F.year("datemut") == year)
    return out.withColumns(
        {"n_days": F.datediff("datemut", F.lit("2013-01-01").cast("date")), "quarter": F.quarter("datemut")}
    )


def prepare_sales(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Ordinary sales with the distance to the big city of the department; missing text is ``missing``."""
    near = filter_extremes(df).join(cities, "departement", "left")
    distance = haversine_km(F.col("geolat"), F.col("geolong"), F.col("DepBigCity_lat"), F.col("DepBigCity_long"))
    out = near.withColumn("department_city_dist", distance).drop("DepBigCity_lat", "DepBigCity_long")
    text = [f.name for f in out.schema if f.dataType.simpleString() == "string"]
    return out.fillna("missing", subset=text) if text else out


# --- staff queries ---------------------------------------------------------------------------------


def hr_queries(spark: SparkSession, salaries: str, jobs: str, history: str) -> dict[str, DataFrame]:
    """SQL over registered views: highest salary, its row, and jobs with their history."""
    return {
        "highest": spark.sql(f"SELECT max(salary) AS salary FROM {salaries}"),
        "best_paid": spark.sql(f"SELECT * FROM {salaries} ORDER BY salary DESC, employee_num LIMIT 1"),
        "jobs": spark.sql(
            f"SELECT j.job_name, count(h.desk_id) AS n FROM {jobs} j LEFT JOIN {history} h ON j.desk_id = h.desk_id "
            "GROUP BY j.job_name"
        ),
    }


# --- departures ------------------------------------------------------------------------------------


def departure_features(df: DataFrame, holidays: DataFrame, events: DataFrame, date: str, place: str) -> DataFrame:
    """Calendar, holiday and event features of departures; ``events`` has the same place and date columns."""
    out = calendar_features(df, date)
    out = holiday_features(out, date, holidays, 2)
    return events_in_window(out, events, place, date, (0, 1, 2), "event_in_next_days")


# --- posts -----------------------------------------------------------------------------------------


def post_features(
    posts: DataFrame, title: str, body: str, title_weight: int = 3, tags: str | None = None, names: Sequence[str] = ()
) -> DataFrame:
    """One plan from raw posts to cleaned tokens and tag columns."""
    text: Column = clean_text(weighted_text(html_to_text(title), html_to_text(body), title_weight))
    out = posts.withColumn("text_all", text).withColumn("words", tokenize("text_all", "words"))
    if tags:
        out = out.withColumns(tag_flags(tag_array(tags), names))
    return out.drop(title, body)
