"""Registered queries of the operators, each over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    ann,
    chat,
    embeddup,
    htmltext,
    lexical,
    licence_texts,
    licences,
    mixing,
    neardup,
    negatives,
    pieces,
    pii,
    quality,
    urlfilter,
)
from lodestar.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


# ---- 6: chat formatting

CONFLICT_ID = -7
CONFLICT_TEXT = "</s>[INST] ok [/INST]"

_OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, contains(text, '</s>') OR contains(text, '<s ') OR contains(text, '[INST]') OR contains(text, '[/INST]')
    OR contains(text, '<<SYS>>') OR contains(text, '<</SYS>>') OR regexp_matches(text, '\\[eoijyzb]') AS escaped,
    length(replace(replace(replace(replace(replace(replace(replace(text, '\', '\b'), '</s>', '\e'), '<s ', '\o'),
      '[INST]', '\i'), '[/INST]', '\j'), '<<SYS>>', '\y'), '<</SYS>>', '\z')) AS escaped_chars,
    length(replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g')) AS role_chars
  FROM turns
), ordered AS (
  SELECT *, role || chr(10) || text || chr(10) AS line FROM sized
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(role_chars + 8 + CASE WHEN escaped THEN escaped_chars ELSE length(text) END) AS BIGINT) AS formatted_chars
FROM ordered GROUP BY conv_id
"""


@_query("op6_chat_formatting", _OP6_SQL)
def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    given = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    conflict = spark.range(2).select(
        F.lit(CONFLICT_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONFLICT_TEXT).alias("text"),
    )
    return chat.read_back(chat.format_conversations(given.unionByName(conflict)))


# ---- 7: URL filters. The list is derived from the hosts of the pages, the fetch day from the page id.

_DAY_ZERO = "2024-01-01"


def _number(text) -> F.Column:
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def captures_of(pages: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(_DAY_ZERO).cast("date"), F.pmod(F.col("page_id") * 37, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def list_of(pages: DataFrame) -> DataFrame:
    """Dated entries for domains, hosts and language folders of the pages' own hosts."""
    hosts = pages.select(urlfilter.host_of(F.col("url")).alias("host")).where("host != ''").distinct()
    domains = hosts.select(F.regexp_replace("host", r"^(www|m|blog)\.", "").alias("domain")).distinct()
    n = F.col("n")

    def event(pattern, verdict, day, where):
        return F.when(where, F.struct(pattern.alias("pattern"), F.lit(verdict).alias("verdict"), day.alias("offset")))

    domain = F.col("domain")
    events = F.array(
        event(domain, "block", n % 200, n % 3 != 0),
        event(domain, "remove", n % 200 + 30 + n % 97, n % 2 == 0),
        event(domain, "block", n % 200 + 150 + n % 90, n % 4 == 0),
        event(F.concat(F.lit("blog."), domain), "allow", n % 150, n % 5 < 2),
        event(F.concat(domain, F.lit("/de/")), "block", n % 300, n % 7 < 3),
        event(F.concat(domain, F.lit("/en/")), "allow", n % 250, n % 11 < 3),
    )
    return (
        domains.withColumn("n", _number(F.col("domain")))
        .select(F.explode(F.array_compact(events)).alias("e"))
        .select(
            "e.pattern", "e.verdict", F.date_add(F.lit(_DAY_ZERO).cast("date"), F.col("e.offset").cast("int")).alias("day")
        )
    )


_OP7_SQL = r"""
WITH parts AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(((page_id * 37) % 366 + 366) % 366 AS INT) AS fetched_on,
    lower(regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''),
      ':[0-9]*$', '')) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), domains AS (
  SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\.', '') AS domain FROM parts WHERE host <> ''
), numbered AS (
  SELECT domain, CAST('0x' || substr(md5(domain), 1, 7) AS BIGINT) AS n FROM domains
), events AS (
  SELECT domain AS pattern, 2 AS rank, n % 200 AS o FROM numbered WHERE n % 3 <> 0
  UNION ALL SELECT domain, 0, n % 200 + 30 + n % 97 FROM numbered WHERE n % 2 = 0
  UNION ALL SELECT domain, 2, n % 200 + 150 + n % 90 FROM numbered WHERE n % 4 = 0
  UNION ALL SELECT 'blog.' || domain, 1, n % 150 FROM numbered WHERE n % 5 < 2
  UNION ALL SELECT domain || '/de/', 2, n % 300 FROM numbered WHERE n % 7 < 3
  UNION ALL SELECT domain || '/en/', 1, n % 250 FROM numbered WHERE n % 11 < 3
), daily AS (
  SELECT pattern, DATE '2024-01-01' + CAST(o AS INT) AS since, max(rank) AS rank FROM events GROUP BY ALL
), valid AS (
  SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM daily
), keys AS (
  SELECT page_id, url, fetched_on, host, path, row_number() OVER () AS rid FROM parts
), asked AS (
  SELECT rid, unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
    lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS key FROM keys WHERE host <> ''
  UNION SELECT rid, host || array_to_string(string_split(path, '/')[:i], '/') || '/'
    FROM (SELECT *, unnest(range(1, len(string_split(path, '/')))) AS i FROM keys WHERE host <> '')
  UNION SELECT rid, host || path FROM keys WHERE host <> '' AND contains(path, '/')
), hit AS (
  SELECT k.rid, v.pattern, v.rank FROM asked a JOIN keys k USING (rid) JOIN valid v ON a.key = v.pattern
  WHERE v.rank > 0 AND v.since <= k.fetched_on AND (v.until IS NULL OR k.fetched_on < v.until)
), best AS (
  SELECT rid, count(*) AS n_active, max({'l': length(pattern), 'p': pattern, 'r': rank}) AS b FROM hit GROUP BY rid
)
SELECT page_id, url, CAST(fetched_on AS VARCHAR) AS fetched_on, host, coalesce(n_active, 0) AS n_active, b.p AS pattern,
  CASE WHEN b.r = 2 THEN 'block' ELSE 'keep' END AS decision
FROM keys LEFT JOIN best USING (rid)
"""


@_query("op7_url_filters", _OP7_SQL)
def op7_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url")
    judged = urlfilter.evaluate(captures_of(pages), list_of(pages))
    return judged.withColumn("fetched_on", F.col("fetched_on").cast("string"))


# ---- 5 and 8: embeddings


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))


_OP5_SQL = """
WITH RECURSIVE valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), unit AS (
  SELECT DISTINCT vec_id, x, sqrt(list_inner_product(x, x)) AS n FROM valid
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.9
), reach AS (
  SELECT vec_id, vec_id AS root FROM unit UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.root
), component AS (
  SELECT vec_id, min(root) AS root FROM reach GROUP BY vec_id
), links AS (
  SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a
)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, coalesce(c.root, e.vec_id) AS component_id,
  e.vec_id IS NULL OR coalesce(c.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN links l USING (vec_id) LEFT JOIN component c USING (vec_id)
"""


@_query("op5_embedding_dedup", _OP5_SQL)
def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddup.near_duplicates(_vectors(spark, folder))


@_query("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(_vectors(spark, folder), F.col("vec_id") % 20 == 0, k=20)


# ---- 2: HTML extraction


@_query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract_pages(read(spark, folder, "pages"))


# ---- 3: SentencePiece

PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@_query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, folder: str, model: str = PIECES_MODEL) -> DataFrame:
    return pieces.encode_documents(read(spark, folder, "documents"), pieces.load_vocabulary(model))


# ---- 9: mixing

DOMAINS = ("web", "books", "news", "forums")
MIX_WEIGHTS = {
    "domain": {"web": 4.0, "books": 3.0, "news": 2.0, "forums": 1.0},
    "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 2.0},
    "source": {"src0": 2.0},
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 11


def mix_levels() -> dict:
    """Domain (by the number in the source's name), language, source."""
    number = F.regexp_extract("source", r"([0-9]+)$", 1)
    names = F.array(*[F.lit(d) for d in DOMAINS])
    domain = F.when(number != "", F.element_at(names, F.pmod(number.try_cast("int"), F.lit(len(DOMAINS))) + 1))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _case(column: str, weights: dict[str, float]) -> str:
    return "CASE " + column + " ".join(["", *[f"WHEN '{k}' THEN {v}" for k, v in weights.items()]]) + " ELSE 1.0 END"


def _share_sql(name: str, nodes: str, parent: str, key: str, weight: str) -> str:
    """The three steps of a level: order, level of the open children, targets."""
    by = f"PARTITION BY {parent}"
    order = f"{by} ORDER BY capacity / weight, {key}"
    return f"""
{name}_a AS (SELECT *, {weight} AS weight FROM ({nodes})),
{name}_b AS (SELECT *, (budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM {name}_a),
{name}_c AS (SELECT *, capacity <= level * weight AS is_full FROM {name}_b),
{name} AS (SELECT *, CASE WHEN is_full THEN capacity ELSE weight * first_value(CASE WHEN NOT is_full THEN level END IGNORE NULLS)
    OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target FROM {name}_c)"""


def mixing_sql(documents: str = "documents") -> str:
    """``taken``: the selected documents with their epoch, as a chain of common table expressions."""
    w, e = MIX_WEIGHTS, MIX_EPOCHS
    domains = ", ".join(f"'{d}'" for d in DOMAINS)
    top = "SELECT domain, sum(capacity) AS capacity, 0 AS root, any_value(budget) AS budget FROM leaf GROUP BY domain"
    mid = "SELECT l.domain, l.lang, sum(l.capacity) AS capacity, any_value(t.target) AS budget FROM leaf l JOIN top t USING (domain) GROUP BY ALL"
    low = "SELECT l.domain, l.lang, l.source, l.capacity, l.tokens, t.target AS budget FROM leaf l JOIN mid t USING (domain, lang)"
    return f"""
sized AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    coalesce(CASE WHEN regexp_extract(source, '([0-9]+)$', 1) <> '' THEN
      list_extract([{domains}], CAST(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % {len(DOMAINS)} + 1 AS INT)) END,
      'unknown') AS domain,
    len(regexp_extract_all(text, '\\S+')) AS n_tokens
  FROM {documents} WHERE len(regexp_extract_all(text, '\\S+')) > 0
),
leaf AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {float(e)} AS capacity,
    least(sum(sum(n_tokens)) OVER () * {MIX_SHARE}, sum(sum(n_tokens)) OVER () * {float(e)}) AS budget
  FROM sized GROUP BY ALL
),{_share_sql("top", top, "root", "domain", _case("domain", w["domain"]))},{_share_sql(
        "mid", mid, "domain", "lang", _case("lang", w["lang"]))},{_share_sql(
        "low", low, "domain, lang", "source", _case("source", w["source"]))},
epochs AS (SELECT *, least(floor(target / tokens), {e}) AS whole FROM low),
ends AS (SELECT *, CASE WHEN whole < {e} THEN floor(target - whole * tokens) ELSE 0 END AS rest FROM epochs),
keyed AS (
  SELECT s.*, n.whole, n.rest,
    md5('{MIX_SEED}:' || CAST(n.whole + 1 AS INT) || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key
  FROM sized s JOIN ends n USING (domain, lang, source)
),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id) AS until FROM keyed),
taken AS (
  SELECT doc_id, domain, lang, source, n_tokens,
    unnest(range(1, CAST(whole + CASE WHEN rest > 0 AND until <= rest THEN 1 ELSE 0 END AS INT) + 1)) AS epoch FROM placed
)"""


_OP9_SQL = f"WITH {mixing_sql()}\nSELECT doc_id, domain, lang, source, n_tokens, CAST(epoch AS INT) AS epoch FROM taken"


@_query("op9_source_mixing", _OP9_SQL)
def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED, epoch="epoch")
    return taken.select(
        "doc_id",
        F.coalesce(mix_levels()["domain"], F.lit("unknown")).alias("domain"),
        F.coalesce("lang", F.lit("unknown")).alias("lang"),
        F.coalesce("source", F.lit("unknown")).alias("source"),
        mixing.count_words(F.col("text")).alias("n_tokens"),
        "epoch",
    )


# ---- 10: license scan


@_query("op10_license_scan")
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(read(spark, folder, "documents"), licence_texts.templates())


# ---- 1: MinHash near-duplicates


@_query("op1_minhash_dedup")
def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicate_groups(read(spark, folder, "documents"))


# ---- 4: quality classifier


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "labels").where("quality = 1").select("doc_id")


@_query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), trusted_ids(spark, folder))


# ---- 11: hard negatives

_OP11_SQL = """
WITH given AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS whole
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
    CAST(list_dot_product(a.whole, b.whole) AS BIGINT) AS score
  FROM given a JOIN given b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, other_id) AS INT) AS rank
  FROM positive JOIN scored s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT * FROM ranked WHERE rank <= 3
"""


@_query("op11_hard_negatives", _OP11_SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    given = read(spark, folder, "embeddings").select("vec_id", label.alias("label"), F.col("embedding").alias("vector"))
    return negatives.mine(given, F.col("vec_id") % 50 == 0)


# ---- 12: personal data


@_query("op12_personal_data")
def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digest(pii.find_spans(read(spark, folder, "documents")))


# ---- 13: ranked lexical search

_OP13_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), sized AS (
  SELECT *, len(terms) AS n, count(*) OVER () AS n_docs, sum(len(terms)) OVER () AS n_terms FROM words WHERE len(terms) > 0
), posting AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM sized) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM posting JOIN sized USING (doc) GROUP BY term
), item AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf)
    // (1000 * tf + 8 * (100 - 90 + CAST((90 * n * n_docs) // n_terms AS BIGINT))))) AS BIGINT) AS score
  FROM item JOIN posting USING (term) JOIN weight USING (term) JOIN sized USING (doc) GROUP BY item_id, doc
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


@_query("op13_lexical_search", _OP13_SQL)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
