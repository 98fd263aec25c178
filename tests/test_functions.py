import math
import pytest
from pyspark.sql import functions as F

from lodestar.functions import columns as C
from lodestar.functions import text as X
from lodestar.operators import textmining as TM
from lodestar.plans import jobs


def one(spark, value, build):
    df = spark.createDataFrame([(value,)], "x STRING")
    return df.select(build("x").alias("y")).first()["y"]


@pytest.mark.parametrize(
    "html,text",
    [
        ("<p>a &amp; b</p>", "a & b"),
        ("x<!-- <b>no</b> -->y", "xy"),
        ("<script>if (a<b) {}</script>z", "z"),
        ("&eacute;t&#233; &#xE9; &nbsp;|&unknown; &amp;lt;", "été é  |&unknown; &lt;"),
        ("", ""),
        (None, None),
    ],
)
def test_html_to_text(spark, html, text):
    assert one(spark, html, X.html_to_text) == text


def test_strip_tags_modes(spark):
    html = "a <code>x</code> b <code>y</code> c"
    got = {m: one(spark, html, lambda c, m=m: X.strip_tags(c, m)) for m in ("tags", "greedy", "lazy", "tag", "keep")}
    assert got == {
        "tags": "a  x  b  y  c", "greedy": "a   c", "lazy": "a   b   c", "tag": "a   b   c", "keep": "a x b y c",
    }


def test_clean_text(spark):
    assert one(spark, "It's 3 (OK), isn't it? We've!", X.clean_text) == "it 's ( ok ) , is n't it ? we 've !"


def test_tokenize_modes(spark):
    value = " a  b\tc "
    assert one(spark, value, lambda c: X.tokenize(c, "space")) == ["", "a", "", "b\tc", ""]
    assert one(spark, value, lambda c: X.tokenize(c, "words")) == ["a", "b", "c"]
    assert one(spark, "A  B ", lambda c: X.tokenize(c, "lower")) == ["a", "", "b"]


def test_ngrams_short_input(spark):
    assert one(spark, "a b c", lambda c: X.ngrams(F.split(c, " "), 2)) == ["a b", "b c"]
    assert one(spark, "a b c", lambda c: X.ngrams(F.split(c, " "), 3)) == ["a b c"]
    assert one(spark, "a", lambda c: X.ngrams(F.split(c, " "), 2)) == []


def test_weighted_text_skips_null(spark):
    df = spark.createDataFrame([("T", "B"), (None, "B"), ("T", None)], "t STRING, b STRING")
    assert [r[0] for r in df.select(X.weighted_text("t", "b", 2)).collect()] == ["t t b", "b", "t t"]


def test_tag_codes(spark):
    tags = ["javascript", "css", "jquery", "html"]
    df = spark.createDataFrame([("css,html",), ("other",)], "tags STRING").withColumn("tags", X.tag_array("tags"))
    out = df.withColumns(X.tag_flags("tags", tags)).withColumn("back", X.decode_tags("code", tags)).collect()
    assert [r["code"] for r in out] == ["0101", "0000"]
    assert [r["back"] for r in out] == [["css", "html"], []]


# Words and their stems from the published description of the Porter stemmer.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
    "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi",
    "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc", "digitizer": "digit",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "airliner": "airlin", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt", "communism": "commun", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
}


def test_stems(spark):
    words = list(STEMS)
    out = spark.createDataFrame([(words,), (None,)], "w ARRAY<STRING>").select(TM.stem("w").alias("s")).collect()
    assert dict(zip(words, out[0]["s"])) == STEMS
    assert out[1]["s"] is None


def test_vocabulary_and_counts(spark, rows):
    df = spark.createDataFrame([(0, "A B B"), (1, "B"), (2, "A A")], "doc INT, text STRING").withColumn("t", F.split("text", " "))
    vocab = {r["word"]: r["index"] for r in TM.vocabulary(df, "doc", "t").collect()}
    assert vocab == {"A": 0, "B": 1}
    counts = [[0, 0] for _ in range(3)]
    for r in TM.doc_term(df, "doc", "t").collect():
        counts[r["doc"]][vocab[r["word"]]] = r["n"]
    assert counts == [[1, 2], [0, 1], [2, 0]]
    seq = TM.to_sequences(df, "doc", "t", TM.vocabulary(df, "doc", "t"))
    assert rows(seq) == [(0, [1, 2, 2]), (1, [2, 0, 0]), (2, [1, 1, 0])]


def test_words_of_odd_rows(spark, rows):
    """Documents of several rows, null documents, null and empty token arrays, null tokens."""
    data = [(3, ["b", "a", "b"]), (1, ["c", None, "a"]), (3, ["a", "d"]), (None, ["e", "b"]), (2, None), (4, [])]
    df = spark.createDataFrame(data, "doc LONG, t ARRAY<STRING>")
    assert rows(TM.doc_term(df, "doc", "t").where("doc = 3")) == [(3, "a", 2), (3, "b", 2), (3, "d", 1)]
    assert TM.doc_term(df, "doc", "t").where("word IS NULL").count() == 0
    vocab = {r["word"]: r["index"] for r in TM.vocabulary(df, "doc", "t").collect()}
    assert [w for w, _ in sorted(vocab.items(), key=lambda w: w[1])][:5] == ["e", "b", "c", None, "a"] and vocab["d"] == 5
    seq = TM.to_sequences(df.where("doc < 4"), "doc", "t", TM.vocabulary(df, "doc", "t")).collect()
    # both rows of document 3, by position: a b, a d, b
    assert {r["doc"]: r["ids"] for r in seq} == {1: [3, 5, 0, 0, 0], 2: [0] * 5, 3: [2, 5, 5, 6, 2]}


def test_words_of_single_rows_are_counted_without_a_shuffle(spark):
    df = spark.createDataFrame([(i, ["a", "b", f"w{i}"]) for i in range(50)], "doc LONG, t ARRAY<STRING>")
    assert "Exchange" not in TM.doc_term(df, "doc", "t")._jdf.queryExecution().executedPlan().toString()


def test_tfidf_of_frequent_and_rare_words(spark, monkeypatch):
    monkeypatch.setattr(TM, "OFTEN", 4)
    df = spark.createDataFrame([(i, ["a", "a", f"w{i // 5}", f"w{i % 4}"]) for i in range(40)], "doc LONG, t ARRAY<STRING>")
    texts = {r["doc"]: r["t"] for r in df.collect()}
    df_of = lambda w: sum(w in t for t in texts.values())
    want = {(d, w): t.count(w) / 4 * (math.log(40 / df_of(w)) + 1) for d, t in texts.items() for w in t}
    assert {(r["doc"], r["word"]): r["tfidf"] for r in TM.tfidf(df, "doc", "t").collect()} == pytest.approx(want)


def test_graph_of_words(spark, rows):
    df = spark.createDataFrame([(0, "a b a c"), (1, "x x"), (2, "a b c a")], "doc INT, text STRING").withColumn("t", F.split("text", " "))
    edges = TM.graph_of_words(df, "doc", "t", 3)
    assert rows(edges.where("doc = 0").select("src", "dst")) == [("a", "b"), ("a", "c"), ("b", "a"), ("b", "c")]
    assert edges.where("doc = 1").count() == 0
    assert rows(TM.directed_triangles(edges).where("doc = 2").select("n1", "n2", "n3")) == [("a", "b", "c"), ("b", "c", "a"), ("c", "a", "b")]


def test_graph_features_against_brute_force_in_one_shuffle(spark, monkeypatch):
    import random
    from collections import Counter

    monkeypatch.setattr(TM, "_TRIANGLE_PAIRS", 5)
    draw = random.Random(3)
    edges = sorted({(d, *draw.sample("abcdefgh", 2)) for d in (1, 2, 3) for _ in range(12 * d)}) + [(None, "a", "b"), (None, "b", "c"), (None, "c", "a"), (4, "x", "y"), (4, "x", "y")]
    want = Counter()
    for doc in {e[0] for e in edges}:
        own = [e[1:] for e in edges if e[0] == doc]
        want.update({(doc, w): 1 for e in own for w in e})
        want.update((doc, " ".join(e)) for e in own)
        if doc is not None:  # documents without a key have no triangles
            want.update((doc, f"{a} {b} {c}") for a, b in set(own) for x, c in set(own) if x == b and (c, a) in own)
    df = spark.createDataFrame(edges, "doc INT, src STRING, dst STRING")
    found = TM.graph_features(df)
    assert {(r["doc"], r["feature"]): r["n"] for r in found.collect()} == want
    assert {(r["doc"], f"{r['n1']} {r['n2']} {r['n3']}") for r in TM.directed_triangles(df).collect()} == {k for k in want if k[1].count(" ") == 2}
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_recode_nulls_and_unknown(spark):
    df = spark.createDataFrame([("1",), ("0",), ("",), ("7",), (None,)], "c STRING")
    assert [r[0] for r in df.select(C.recode("c", {"1": "one"})).collect()] == ["one", None, None, "7", None]


def test_collapse_and_score(spark):
    df = spark.createDataFrame([("Place",), ("Hors intersection",), (None,), ("?",)], "c STRING")
    level = C.collapse_levels("c", {"Avec": ["Place"], "Hors": ["Hors intersection"]})
    assert [r[0] for r in df.select(level).collect()] == ["Avec", "Hors", "(Inconnu)", "Other"]


def test_split_at_short_text(spark):
    df = spark.createDataFrame([("1230",), ("5",), ("945",), ("",)], "h STRING")
    a, b = C.split_at("h", -2)
    assert [tuple(r) for r in df.select(a, b).collect()] == [("12", "30"), ("", "5"), ("9", "45"), ("", "")]


def test_timestamp_from_parts(spark):
    df = spark.createDataFrame([(5, 1, 2, "", "7")], "y INT, m INT, d INT, h STRING, mi STRING")
    stamp = C.timestamp_from_parts(*[F.col(c) for c in ("y", "m", "d", "h", "mi")])
    assert str(df.select(stamp).first()[0]) == "2005-01-02 00:07:00"


def test_holidays_closed_windows(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2011-07-01', DATE '2011-07-08')) AS d")
    holidays = spark.sql("SELECT DATE '2011-07-04' AS holiday")
    out = {r["d"].day: tuple(r)[1:] for r in C.holiday_features(days, "d", holidays, 2).collect()}
    assert out[1] == (0, 0, 0, 0) and out[2] == (0, 1, 0, 1) and out[4] == (1, 1, 1, 1) and out[6] == (0, 0, 1, 1) and out[7] == (0, 0, 0, 0)


def test_weather_records(spark, rows):
    line = lambda year, temp, q: "0" * 15 + year + "x" * 68 + temp + q + "zz"
    data = [line("1950", "+0022", "1"), line("1950", "-0011", "1"), line("1949", "+9999", "1"), line("1949", "+0111", "2"), line("1949", "+0078", "9")]
    df = spark.createDataFrame([(d,) for d in data], "value STRING")
    assert rows(C.parse_weather(df)) == [(1949, 78), (1950, -11), (1950, 22)]


def test_small_planets(spark, tmp_path):
    from lodestar.sources.readers import read_json_view

    path = tmp_path / "planets.json"
    planets = {"Mercury": 2440, "Venus": 6052, "Earth": 6378, "Mars": 3397, "Jupiter": 71492, "Saturn": 60268, "Uranus": 25559, "Neptune": 24766, "Pluto": 1150}
    path.write_text("\n".join(f'{{"name":"{n}","radius":"{r}"}}' for n, r in planets.items()))
    read_json_view(spark, str(path), "test_planets")
    found = spark.sql("SELECT name FROM test_planets WHERE CAST(radius AS INT) < 10000").collect()
    assert {r["name"] for r in found} == {"Mercury", "Venus", "Earth", "Mars", "Pluto"}


def test_impute_all_null_column(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, None, None), (None, "b", 3.0)], "e DOUBLE, s STRING, v DOUBLE")
    out = C.impute(df, add_indicator=True).orderBy("v").collect()
    assert [r["v"] for r in out] == [1.0, 2.0, 3.0] and {r["e"] for r in out} == {None}
    assert sum(r["s_missing"] for r in out) == 1


def test_rate_of_empty_population(spark):
    df = spark.createDataFrame([(10.0, 200), (5.0, 0)], "`Nb X` DOUBLE, Population BIGINT")
    assert [r["Taux de X"] for r in C.rate_columns(df).collect()] == [5.0, None]


def test_panel_drops_countries_below_threshold(spark):
    cases = spark.createDataFrame([("", "US", 0.0, 0.0, "3", "12"), ("", "Fr", 0.0, 0.0, "1", "2")], "Province STRING, Country STRING, Lat DOUBLE, Long DOUBLE, `1/1/20` STRING, `1/2/20` STRING")
    countries = spark.createDataFrame([("United States of America", "USA", "A", "B"), ("Fr", "FRA", "E", "W")], "Country STRING, alpha3 STRING, region STRING, subregion STRING")
    pop = spark.createDataFrame(
        [("USA", "SP.POP.0014.TO", "1000000"), ("USA", "SP.POP.65UP.TO", "1000000"), ("USA", "SP.POP.1564.TO", ".."), ("FRA", "SP.POP.65UP.TO", "5")],
        "alpha3 STRING, series STRING, value STRING",
    )
    out = jobs.epidemic_panel(cases, countries, pop).collect()
    assert [(r["Country"], r["day"], r["value"], r["rate_1M_pop"], r["rate_1M_pop_65up"]) for r in out] == [("USA", 0, 12.0, 6.0, 12.0)]


def test_accident_codes(spark):
    car = spark.createDataFrame([(1, 17, 2, 3, "5", "1", "2", "0", "9", "7", 4885000.0, 235000.0, "750")], "Num_Acc INT, an INT, mois INT, jour INT, hrmn STRING, lum STRING, agg STRING, int STRING, atm STRING, col STRING, lat DOUBLE, long DOUBLE, dep STRING")
    r = jobs.accident_scores(jobs.accident_characteristics(car)).first()
    assert (r["Lumiere"], r["Code_Agglomeration"], r["Intersection"], r["Code_Intersection"], r["Code_Atmosphere"], r["Code_Collision"], r["Annee"]) == ("Plein jour", 100.0, None, 0.0, 0.0, 100.0, 2017)


def test_big_city_ties_take_the_smallest_code(spark, rows):
    communes = spark.createDataFrame([("a2", "01", 10), ("a1", "01", 10), ("b1", "2A", 3)], "commune STRING, departement STRING, Population BIGINT")
    places = spark.createDataFrame([("a1", "45.5", "4.5"), ("a2", "1", "1"), ("b1", "NaN", "9.0")], "commune STRING, latitude STRING, longitude STRING")
    assert rows(jobs.big_cities(communes, places)) == [("01", 45.5, 4.5), ("2A", None, 9.0)]


def test_vehicle_labels(spark):
    from lodestar.plans import jobs

    rows = [(1, "A01", "07", "1", "02"), (2, "A01", "00", "0", "00"), (3, "B01", "98", None, ""), (4, "B01", "30", "9", "24")]
    veh = spark.createDataFrame(rows, "Num_Acc INT, num_veh STRING, catv STRING, choc STRING, manv STRING")
    got = {r["Num_Acc"]: (r["vehic_category"], r["vehic_choc"], r["vehic_manoeuvre"]) for r in jobs.accident_vehicles(veh).collect()}
    assert got[1] == ("VL seul", "Avant", "Même sens, même file")
    assert got[2] == (None, "(Other)", "(Other)")
    assert got[3] == ("98", "(Other)", "(Other)")
    assert got[4] == ("Scooter < 50 cm3", "Chocs multiples (tonneaux)", "En stationnement (avec occupants)")


def test_stems_and_the_chain_of_bigrams(spark):
    from lodestar.operators import textmining as TM

    rows = [(1, ["running", "the", "cats", None, "running"]), (2, []), (3, None), (4, ["ponies"])]
    df = spark.createDataFrame(rows, "id INT, t ARRAY<STRING>")
    got = {r["id"]: r["s"] for r in df.select("id", TM.stem("t").alias("s")).collect()}
    assert got == {1: ["run", "the", "cat", None, "run"], 2: [], 3: None, 4: ["poni"]}
    docs = spark.createDataFrame([(1, "The cats running and ponies"), (2, "cat")], "id INT, text STRING")
    out = TM.tfidf_stages("text", "f", 1 << 18, ["the", "and"], 2, stems=True).fit(docs).transform(docs)
    assert {r["id"]: r["_grams"] for r in out.collect()} == {1: ["cat run", "run poni"], 2: []}
    # ln((2 + 1) / (1 + 1)) per bigram that one of two documents has
    norm = out.where("id = 1").select(TM.vector_norm("f")).first()[0]
    assert abs(norm - math.sqrt(2) * math.log(1.5)) < 1e-9


def test_columns_found_when_the_call_is_analysed(spark):
    from lodestar.operators.tablefunctions import flag_columns

    df = spark.createDataFrame([(1, "css,html"), (2, None), (3, "css"), (4, "other,")], "id INT, tags STRING")
    out = flag_columns(df, "tags", ["html", "css"])
    assert out.columns == ["id", "tags", "html", "css", "code"]
    assert sorted((r["id"], r["html"], r["css"], r["code"]) for r in out.collect()) == [(1, 1, 1, "11"), (2, 0, 0, "00"), (3, 0, 1, "01"), (4, 0, 0, "00")]
    assert flag_columns(df, "tags", ["js"]).columns == ["id", "tags", "js", "code"]
    assert flag_columns(df.where("id > 9"), "tags", ["js"]).count() == 0
    for column, names in (("nothing", ["a"]), ("tags", ["id"]), ("tags", ["a", "a"])):
        with pytest.raises(Exception, match="no column|there twice"):
            flag_columns(df, column, names).collect()
