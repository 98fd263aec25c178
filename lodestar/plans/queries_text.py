"""Text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import text as X
from lodestar.operators import textmining as TM
from lodestar.plans.queries_aggregates import PLAIN_SQL, STOP, STOP_SQL
from lodestar.plans.queries_rows import fraction_sql
from lodestar.plans.registry import query

_WS = "[ \\t\\n\\f\\r\\x0B]+"
# one row per token with its 0-based position among the non-empty tokens of the lower-case plain text
TOKENS_SQL = (
    f"SELECT doc_id AS doc, trim(regexp_replace(lower({PLAIN_SQL}), '{_WS}', ' ', 'g')) AS s FROM documents"
)
POS_SQL = (
    f"SELECT doc, w AS word, i - 1 AS pos, n AS size FROM (SELECT doc, unnest(l) AS w, unnest(range(1, len(l) + 1)) AS i, len(l) AS n FROM (SELECT doc, string_split(s, ' ') AS l FROM ({TOKENS_SQL}) WHERE s <> ''))"
)


def plain_tokens(t):
    """Documents with their lower-case tokens, punctuation stripped."""
    return t.documents.select("doc_id", X.tokenize(F.lower(X.strip_punct("text"))).alias("tokens"))


def _strip_sql(inner: str) -> str:
    out = f"regexp_replace({inner}, '(?s)<!--.*?-->', '', 'g')"
    out = f"regexp_replace({out}, '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g')"
    out = f"regexp_replace({out}, '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g')"
    return f"regexp_replace({out}, '(?s)<[^>]*>', '', 'g')"


def _entities_sql(inner: str) -> str:
    for name, char in (("nbsp", "chr(160)"), ("copy", "'©'"), ("middot", "'·'"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("amp", "'&'")):
        inner = f"replace({inner}, '&{name};', {char})"
    return inner


@query("t01_html_to_text", f"SELECT page_id, {_entities_sql(_strip_sql('html'))} AS txt FROM pages")
def _(t):
    return X.HtmlTextExtractor(inputCol="html", outputCol="txt").transform(t.pages).select("page_id", "txt")


@query(
    "t02_strip_tags",
    "SELECT page_id, length(regexp_replace(html, '<[^>]*>', ' ', 'g')) AS tags, length(regexp_replace(html, '<[^>]*>(.*)</[^>]*>', ' ', 'g')) AS greedy, "
    "length(regexp_replace(html, '<[^>]*>(.*?)</[^>]*>', ' ', 'g')) AS lazy, md5(regexp_replace(html, '<a[^>]*>(.*?)</a>', ' ', 'g')) AS tag, "
    "md5(regexp_replace(html, '<a[^>]*>(.*?)</a>', '\\1', 'g')) AS keep FROM pages",
)
def _(t):
    size = lambda mode: F.length(X.strip_tags("html", mode)).cast("bigint").alias(mode)
    return t.pages.select(
        "page_id", size("tags"), size("greedy"), size("lazy"), F.md5(X.strip_tags("html", "tag", "a")).alias("tag"), F.md5(X.strip_tags("html", "keep", "a")).alias("keep")
    )


def _clean_sql(inner: str) -> str:
    out = f"lower(regexp_replace({inner}, '[^ \\t\\n\\f\\r\\x0Ba-zA-Z(),!?'']', ' ', 'g'))"
    for ending in X.CONTRACTIONS:
        e = ending.replace("'", "''")
        out = f"replace({out}, '{e}', ' {e}')"
    for mark in (",", "!", "(", ")"):
        out = f"replace({out}, '{mark}', ' {mark} ')"
    out = f"replace({out}, '?', ' ?')"
    return f"trim(regexp_replace({out}, '[ \\t\\n\\f\\r\\x0B]{{2,}}', ' ', 'g'))"


@query("t03_clean_text", f"SELECT doc_id, {_clean_sql('text')} AS txt FROM documents")
def _(t):
    return t.documents.select("doc_id", X.clean_text("text").alias("txt"))


@query("t04_strip_punct", f"SELECT doc_id, {PLAIN_SQL} AS txt, length(translate({PLAIN_SQL}, '0123456789', '')) AS without_digits FROM documents")
def _(t):
    return t.documents.select(
        "doc_id", X.strip_punct("text").alias("txt"), F.length(X.strip_punct("text", digits=True)).cast("bigint").alias("without_digits")
    )


@query(
    "t05_weighted_text",
    "SELECT doc_id, " + ", ".join(
        "trim(lower(" + " || ' ' || ".join(["split_part(text, chr(10), 1)"] * k + ["text"]) + f")) AS k{k}" for k in (0, 1, 3)
    ) + " FROM documents",
)
def _(t):
    rows = t.documents.withColumn("title", F.split("text", "\n")[0])
    return rows.select("doc_id", *[X.weighted_text("title", "text", k).alias(f"k{k}") for k in (0, 1, 3)])


@query(
    "t06_tokenize",
    f"SELECT doc_id, len(string_split(text, ' ')) AS space, len(list_filter(string_split_regex(text, '{_WS}'), lambda w: w <> '')) AS words, "
    "len(string_split_regex(regexp_replace(lower(text), '[ \\t\\n\\f\\r\\x0B]+$', ''), '[ \\t\\n\\f\\r\\x0B]')) AS lower FROM documents",
)
def _(t):
    size = lambda mode: F.size(X.tokenize("text", mode)).cast("bigint").alias(mode)
    return t.documents.select("doc_id", size("space"), size("words"), size("lower"))


@query(
    "t07_remove_stopwords",
    f"SELECT doc AS doc_id, string_agg(word, ' ' ORDER BY pos) AS txt FROM ({POS_SQL}) WHERE word NOT IN {STOP_SQL} GROUP BY doc",
)
def _(t):
    kept = plain_tokens(t).select("doc_id", F.array_join(X.remove_stopwords("tokens", STOP), " ").alias("txt"))
    return kept.where("txt <> ''")


@query("t08_stem")
def _(t):
    return plain_tokens(t).select("doc_id", F.array_join(TM.stem("tokens"), " ").alias("stems"))


@query("t09_stemmed_bigrams")
def _(t):
    """Stop words out, stems, bigrams, hashed TF-IDF of the plain words: one pipeline."""
    words = t.documents.select("doc_id", F.lower(X.strip_punct("text")).alias("text"))
    model = TM.tfidf_stages("text", "features", 1 << 18, sorted(STOP), 2, stems=True).fit(words)
    out = model.transform(words)
    return out.select("doc_id", F.size("_grams").cast("long").alias("n_bigrams"), F.round(TM.vector_norm("features"), 6).alias("norm"))


@query(
    "t09_ngrams",
    f"SELECT a.word || ' ' || b.word AS gram, count(*) AS n FROM ({POS_SQL}) a JOIN ({POS_SQL}) b ON a.doc = b.doc AND b.pos = a.pos + 1 GROUP BY ALL",
)
def _(t):
    grams = X.unnest(plain_tokens(t), X.ngrams("tokens", 2), "gram")
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t10_vocabulary",
    f"SELECT word, row_number() OVER (ORDER BY doc, pos) - 1 AS index FROM (SELECT word, min(doc) AS doc, arg_min(pos, doc * 100000 + pos) AS pos FROM ({POS_SQL}) GROUP BY word)",
)
def _(t):
    return TM.vocabulary(plain_tokens(t), "doc_id", "tokens")


@query("t10_doc_term", f"SELECT doc, word, count(*) AS n FROM ({POS_SQL}) GROUP BY ALL")
def _(t):
    return TM.doc_term(plain_tokens(t), "doc_id", "tokens")


_VOCAB_SQL = f"SELECT word, row_number() OVER (ORDER BY doc, pos) AS id FROM (SELECT word, min(doc) AS doc, arg_min(pos, doc * 100000 + pos) AS pos FROM ({POS_SQL}) GROUP BY word)"


@query(
    "t11_to_sequences",
    f"WITH p AS ({POS_SQL}), v AS ({_VOCAB_SQL}), m AS (SELECT max(size) AS longest FROM p) SELECT doc_id AS doc, longest AS length, md5(rtrim(coalesce(s, '') || repeat(' 0', CAST(longest - coalesce(k, 0) AS INT)))) AS ids "
    "FROM documents CROSS JOIN m LEFT JOIN (SELECT doc, string_agg(' ' || id, '' ORDER BY pos) AS s, count(*) AS k FROM p JOIN v USING (word) GROUP BY doc) ON doc = doc_id",
)
def _(t):
    tokens = plain_tokens(t)
    out = TM.to_sequences(tokens, "doc_id", "tokens", TM.vocabulary(tokens, "doc_id", "tokens"))
    text = F.concat(F.lit(" "), F.array_join(F.col("ids").cast("array<string>"), " "))
    return out.select("doc", F.size("ids").cast("bigint").alias("length"), F.md5(text).alias("ids"))


@query(
    "t12_tfidf_top",
    f"WITH p AS ({POS_SQL}), c AS (SELECT doc, word, count(*) AS n, max(size) AS size FROM p GROUP BY ALL), d AS (SELECT word, count(*) AS df FROM c GROUP BY word), "
    "w AS (SELECT doc, word, round(n / size * (ln((SELECT count(*) FROM documents) / df) + 1), 9) AS tfidf FROM c JOIN d USING (word)) "
    "SELECT doc, word, tfidf, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY tfidf DESC, word) AS rank FROM w) WHERE rank <= 4",
)
def _(t):
    return TM.tfidf_top(plain_tokens(t), "doc_id", "tokens", 4, digits=9)


@query("t13_tfidf_hashed")
def _(t):
    from pyspark.ml.functions import vector_to_array

    from lodestar.operators.rows import split_weights

    train, test = split_weights(t.documents, ["doc_id"], [0.8, 0.2])
    both = TM.tfidf_hashed(train, test, "text", 1000)
    rows = [part.select(F.lit(name).alias("part"), "doc_id", vector_to_array("features").alias("v")) for name, part in zip(("train", "test"), both)]
    return rows[0].unionByName(rows[1]).select("part", "doc_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), 6).alias("norm2"))


_TAGS = ("en", "fr", "de", "es")


@query(
    "t14_tag_flags",
    "SELECT doc_id, " + ", ".join(f"CAST(lang = '{n}' OR source = '{n}' AS INT) AS {n}" for n in _TAGS) + ", concat(" + ", ".join(f"CAST(lang = '{n}' OR source = '{n}' AS INT)" for n in _TAGS) + ") AS code FROM documents",
)
def _(t):
    rows = t.documents.select("doc_id", X.tag_array(F.concat_ws(",", "lang", "source")).alias("tags"))
    return rows.withColumns(X.tag_flags("tags", _TAGS)).drop("tags")


@query(
    "t15_decode_tags",
    "SELECT doc_id, lang AS tags, concat_ws(',', lang, CASE WHEN n_chars > 1000 THEN 'long' END) AS predicted FROM documents",
)
def _(t):
    flags = {f"{n}_pred": (F.col("lang") == n).cast("int") for n in _TAGS}
    rows = t.documents.withColumns({**flags, "long_pred": (F.col("n_chars") > 1000).cast("int")})
    code = F.concat(*[F.col(f"{n}_pred").cast("string") for n in _TAGS])
    return rows.select(
        "doc_id", F.array_join(X.decode_tags(code, _TAGS), ",").alias("tags"), F.array_join(X.collect_predictions([*_TAGS, "long"]), ",").alias("predicted")
    )


@query("t16_label_map", "SELECT conv_id, turn, CAST(role = 'user' AS INT) AS label FROM conversations WHERE text IS NOT NULL")
def _(t):
    return t.conversations.where(F.col("text").isNotNull()).select("conv_id", "turn", X.label_map("role", "user").alias("label"))


@query(
    "t17_matrix_density",
    f"WITH c AS (SELECT DISTINCT doc, word FROM ({POS_SQL})), n AS (SELECT (SELECT count(*) FROM c) AS cells, (SELECT count(DISTINCT doc) FROM c) AS rows, (SELECT count(DISTINCT word) FROM c) AS cols) "
    "SELECT cells, rows, cols, round(100.0 * cells / (rows * cols), 9) AS filled_pct FROM n",
)
def _(t):
    out = TM.matrix_density(TM.doc_term(plain_tokens(t), "doc_id", "tokens"), "doc", "word", "n")
    return out.withColumn("filled_pct", F.round("filled_pct", 9))


_GOW_SQL = f"SELECT DISTINCT a.doc, a.word AS src, b.word AS dst FROM ({POS_SQL}) a JOIN ({POS_SQL}) b ON a.doc = b.doc AND b.pos - a.pos IN (1, 2) WHERE a.word <> b.word"


@query(
    "t18_graph_of_words",
    f"WITH e AS ({_GOW_SQL}) SELECT doc, (SELECT count(*) FROM (SELECT src FROM e x WHERE x.doc = e.doc UNION SELECT dst FROM e x WHERE x.doc = e.doc)) AS nodes, count(*) AS edges FROM e GROUP BY doc",
)
def _(t):
    return TM.graph_of_words_size(TM.graph_of_words(plain_tokens(t), "doc_id", "tokens"))


@query(
    "t19_graph_features",
    f"WITH e AS ({_GOW_SQL}), f AS (SELECT doc, src AS feature FROM e UNION SELECT doc, dst FROM e UNION ALL SELECT doc, src || ' ' || dst FROM e UNION ALL SELECT a.doc, a.src || ' ' || b.src || ' ' || c.src FROM e a "
    "JOIN e b ON a.doc = b.doc AND a.dst = b.src JOIN e c ON b.doc = c.doc AND b.dst = c.src AND c.dst = a.src) SELECT doc, count(*) AS features, count(CASE WHEN contains(feature, ' ') THEN 1 END) AS links, "
    "CAST(sum(length(feature)) AS BIGINT) AS chars FROM f GROUP BY doc",
)
def _(t):
    features = TM.graph_features(TM.graph_of_words(plain_tokens(t), "doc_id", "tokens"))
    return features.groupBy("doc").agg(
        F.count(F.lit(1)).alias("features"), F.count_if(F.col("feature").contains(" ")).alias("links"), F.sum(F.length("feature")).alias("chars")
    )


@query(
    "t20_attach_vectors",
    f"SELECT word, length(word) <= 4 AS known, round(CASE WHEN length(word) <= 4 THEN length(word) ELSE {fraction_sql('word, 16')} * 0.5 - 0.25 END, 9) AS last FROM (SELECT DISTINCT word FROM ({POS_SQL}))",
)
def _(t):
    words = X.unnest(plain_tokens(t), "tokens", "word").distinct()
    known = words.where(F.length("word") <= 4).select("word", F.array(*[F.length("word").cast("double")] * 16).alias("vector"))
    return TM.attach_vectors(words, known, 16).select("word", "known", F.round(F.col("vector")[15], 9).alias("last"))


@query(
    "t21_post_features",
    f"SELECT page_id, {_clean_sql('lower(split_part(' + _entities_sql(_strip_sql('html')) + ', chr(10), 1) || chr(32) || ' + _entities_sql(_strip_sql('html')) + ')')} AS text_all FROM pages",
)
def _(t):
    from lodestar.plans.jobs import post_features

    posts = t.pages.select("page_id", F.split(X.html_to_text("html"), "\n")[0].alias("title"), F.col("html").alias("body"))
    return post_features(posts, "title", "body", 1).select("page_id", "text_all")
