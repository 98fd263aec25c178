"""Text column expressions: markup removal, cleaning, tokens, n-grams. All run inside the JVM."""

from __future__ import annotations

import string
from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.columns import col

# Endings split from English contractions, in the order in which they are split.
CONTRACTIONS = ("'s", "'ve", "n't", "'re", "'d", "'ll")


def html_to_text(c: str | Column) -> Column:
    """Visible text of a page: comments, scripts, styles and tags go, character references are decoded."""
    out = F.regexp_replace(col(c), r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?is)<script\b[^>]*>.*?</script\s*>", "")
    out = F.regexp_replace(out, r"(?is)<style\b[^>]*>.*?</style\s*>", "")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    return decode_entities(out)


def decode_entities(c: Column) -> Column:
    """Decode named and numeric character references in one pass; unknown names stay as they are."""
    names = F.create_map(*[F.lit(x) for n, code in sorted(name2codepoint.items()) for x in (n, chr(code))])
    known = r"&(?=(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);)"

    def decode(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        number = F.when(name.rlike("^#[0-9]"), F.substr(name, F.lit(2)).try_cast("int")).when(
            name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int")
        )
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        text = F.coalesce(names[name], char, F.concat(F.lit("&"), name, F.lit(";")))
        return F.concat(text, F.substr(part, F.length(name) + 2))

    parts = F.split(c, known)
    decoded = F.transform(parts, lambda part, i: F.when(i == 0, part).otherwise(decode(part)))
    return F.when(c.contains("&"), F.array_join(decoded, "")).otherwise(c)


class HtmlTextExtractor(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``html_to_text`` as a pipeline stage."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), html_to_text(self.getInputCol()))


def strip_tags(c: str | Column, mode: str = "tags", tag: str = "code") -> Column:
    """Remove markup by pattern.

    ``tags`` drops tags; ``greedy`` and ``lazy`` drop tags with what they enclose on a line;
    ``tag`` drops one tag with its content; ``keep`` drops one tag but keeps its content.
    """
    patterns = {
        "tags": (r"<[^>]*>", " "),
        "greedy": (r"<[^>]*>(.*)</[^>]*>", " "),
        "lazy": (r"<[^>]*>(.*?)</[^>]*>", " "),
        "tag": (rf"<{tag}[^>]*>(.*?)</{tag}>", " "),
        "keep": (rf"<{tag}[^>]*>(.*?)</{tag}>", "$1"),
    }
    return F.regexp_replace(col(c), *patterns[mode])


def clean_text(c: str | Column) -> Column:
    """Keep letters and ``(),!?'``, split contractions, space out punctuation, lower, collapse, trim."""
    out = F.regexp_replace(col(c), r"[^\sa-zA-Z(),!?']", " ")
    out = F.lower(out)
    for ending in CONTRACTIONS:
        out = F.replace(out, F.lit(ending), F.lit(" " + ending))
    for mark in (",", "!", "(", ")"):
        out = F.replace(out, F.lit(mark), F.lit(f" {mark} "))
    out = F.replace(out, F.lit("?"), F.lit(" ?"))
    return F.trim(F.regexp_replace(out, r"\s{2,}", " "))


def strip_punct(c: str | Column, digits: bool = False) -> Column:
    drop = string.punctuation + (string.digits if digits else "")
    # translate() drops every listed character without a counterpart in the empty target
    return F.translate(col(c), drop, "")


def weighted_text(title: str | Column, body: str | Column, k: int) -> Column:
    """The title k times, then the body, lower case and trimmed; a NULL part counts as absent."""
    return F.trim(F.lower(F.concat_ws(" ", *[col(title)] * k, col(body))))


def tokenize(c: str | Column, mode: str = "words") -> Column:
    """``space``: split at single spaces, empties kept; ``words``: at white space, empties dropped;
    ``lower``: lower case, split at each white-space character, trailing empties dropped."""
    c = col(c)
    if mode == "space":
        return F.split(c, " ")
    if mode == "words":
        return F.filter(F.split(c, r"\s+"), lambda w: w != "")
    if mode == "lower":
        return F.split(F.regexp_replace(F.lower(c), r"\s+$", ""), r"\s")
    raise ValueError(f"unknown mode {mode}")


def remove_stopwords(tokens: str | Column, stop: Sequence[str]) -> Column:
    listed = F.array(*[F.lit(w) for w in sorted(set(stop))])
    return F.filter(col(tokens), lambda w: ~F.array_contains(listed, F.lower(w)))


def ngrams(tokens: str | Column, n: int = 2) -> Column:
    """Adjacent n-grams joined by a space; an empty array when there are fewer than n tokens."""
    none = F.array().cast("array<string>")

    def build(t: Column) -> Column:
        starts = F.slice(t, 1, F.greatest(F.size(t) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda _, i: F.concat_ws(" ", F.slice(t, i + 1, n)))

    # wrapping the tokens in a one-element array binds them once, however often the body refers to them
    return F.coalesce(F.transform(F.array(col(tokens)), build)[0], none)


def unnest(df: DataFrame, array: str | Column, name: str, keep: Sequence[str | Column] = (), pos: str | None = None) -> DataFrame:
    """One row per array element, with the element's position when ``pos`` is named.

    An inner explode makes Spark filter on the array's size below the projection that builds it, which
    computes an expensive array (tokens, pairs) again for every test. The outer form followed by a test
    of its output builds the array once.
    """
    if pos is None:
        return df.select(*keep, F.explode_outer(col(array)).alias(name)).where(F.col(name).isNotNull())
    return df.select(*keep, F.posexplode_outer(col(array)).alias(pos, name)).where(F.col(pos).isNotNull())


def tag_array(c: str | Column) -> Column:
    return F.split(col(c), ",")


def tag_flags(tags: str | Column, names: Sequence[str]) -> dict[str, Column]:
    """A 0/1 column per tag and ``code``, the flags joined in the given order."""
    has = {name: F.array_contains(col(tags), name).cast("int") for name in names}
    return {**has, "code": F.concat(*[flag.cast("string") for flag in has.values()])}


def decode_tags(code: str | Column, names: Sequence[str]) -> Column:
    """Tag array of a code string."""
    parts = [F.when(F.substring(col(code), i + 1, 1) == "1", F.lit(n)) for i, n in enumerate(names)]
    return F.array_compact(F.array(*parts))


def collect_predictions(names: Sequence[str], suffix: str = "_pred") -> Column:
    """Tag array of the positive ``<tag>_pred`` columns."""
    return F.array_compact(F.array(*[F.when(F.col(f"{n}{suffix}") > 0, F.lit(n)) for n in names]))


def label_map(c: str | Column, positive: str = "positive") -> Column:
    return F.when(col(c) == positive, F.lit(1)).otherwise(F.lit(0))
