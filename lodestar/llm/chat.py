"""Chat formatting with a checked grammar round trip (DataFrame functions only).

A conversation is the concatenation of its turns, each written as ``<s ROLE>BODY</s>``. The parser is
deterministic: it cuts at every ``</s>``, takes the role up to the first ``>`` and undoes escapes. A text is
written as it is when it holds no control string and its rendered turn parses back to the same turn; otherwise its control
strings (and backslashes) are replaced by two-character codes, after which none is left in it. Every turn as
written is then parsed again and compared with its source, role and text; a difference is an error.

Defined results: turns are ordered by ``turn, role, text`` (nulls first), so ties and repeated rows have a
fixed order and all stay; a null text or role is an empty one; rows with a null ``conv_id`` form one
conversation with a null id; an empty table gives no rows; other columns are ignored.

One output row holds a whole conversation, because that is the result asked for; nothing else gathers a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ESCAPE = "\\"
# control string -> code letter; a backslash before the letter marks an escaped string
CODES = {"</s>": "e", "<s ": "o", "[INST]": "i", "[/INST]": "j", "<<SYS>>": "y", "<</SYS>>": "z"}
ROLE_CODES = {"<": "l", ">": "g"}
LOSS_ROLE = "assistant"


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column, codes: dict[str, str] = CODES) -> Column:
    return _replace(text, [(ESCAPE, ESCAPE + "b"), *[(s, ESCAPE + c) for s, c in codes.items()]])


def unescape(text: Column, codes: dict[str, str] = CODES) -> Column:
    return _replace(text, [*[(ESCAPE + c, s) for s, c in codes.items()], (ESCAPE + "b", ESCAPE)])


def render_turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit("<s "), escape(role, ROLE_CODES), F.lit(">"), body, F.lit("</s>"))


def segments(formatted: Column) -> Column:
    """The raw turns between terminators; the piece after the last terminator is dropped if it is empty."""
    pieces = F.split(formatted, "</s>")
    return F.when(F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)


def _raw_body(segment: Column) -> Column:
    return F.substring(segment, F.instr(segment, ">") + 1, F.length(segment))


def parse(formatted: Column) -> Column:
    """Array of ``(role, text, body_chars)``: recovered turns and the length of each body as written."""
    return F.transform(
        segments(formatted),
        lambda s: F.struct(
            unescape(F.substring(s, F.lit(4), F.instr(s, ">") - 4), ROLE_CODES).alias("role"),
            unescape(_raw_body(s)).alias("text"),
            F.length(_raw_body(s)).alias("body_chars"),
        ),
    )


def format_turns(turns: DataFrame) -> DataFrame:
    """Rendered turns ``conv_id, turn, role, text, escaped, rendered``."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    plain = render_turn(F.col("role"), F.col("text"))
    found = parse(plain)
    same = (
        (F.size(found) == 1) & (found[0]["role"] == F.col("role")) & (found[0]["text"] == F.col("text"))
    )
    holds = reduce(lambda a, b: a | b, [F.contains("text", F.lit(s)) for s in CODES])
    checked = rows.withColumn("escaped", holds | ~same)
    body = F.when(F.col("escaped"), escape(F.col("text"))).otherwise(F.col("text"))
    written = checked.withColumn("rendered", render_turn(F.col("role"), body))
    again = parse(F.col("rendered"))
    whole = (F.size(again) == 1) & (again[0]["role"] == F.col("role")) & (again[0]["text"] == F.col("text"))
    differs = F.raise_error(F.lit("a turn does not parse back to its source"))
    return written.withColumn("rendered", F.when(whole, F.col("rendered")).otherwise(differs))


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, n_escaped, spans``: spans has, per turn, the first code point and the length of
    its body in ``formatted`` (counted from 1) and whether it is under the loss mask."""
    rows = format_turns(turns)
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    place = Window.partitionBy("conv_id").orderBy(*order)
    head = F.length(escape(F.col("role"), ROLE_CODES)) + 4
    placed = rows.select(
        "conv_id",
        "rendered",
        "escaped",
        F.row_number().over(place).alias("at"),
        F.coalesce(
            F.sum(F.length("rendered").cast("long")).over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before"),
        head.alias("head"),
        (F.length("rendered") - head - 4).alias("length"),
        (F.col("role") == LOSS_ROLE).alias("loss"),
    )
    start = (F.col("before") + F.col("head") + 1).alias("start")
    whole = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "rendered", F.struct(start, "length", "loss").alias("span")))).alias(
            "turns"
        ),
        F.sum(F.col("escaped").cast("long")).alias("n_escaped"),
    )
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        "n_escaped",
        F.transform("turns", lambda t: t["span"]).alias("spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a reader recovers from the formatted text and its loss mask. Fails if the mask does
    not fit the parsed turns."""
    parsed = formatted.select("conv_id", "formatted", "spans", parse(F.col("formatted")).alias("parsed"))
    fits = F.transform("spans", lambda s: s["length"]) == F.transform("parsed", lambda p: p["body_chars"])
    lines = F.transform("parsed", lambda p: F.concat(p["role"], F.lit("\n"), p["text"], F.lit("\n")))
    under = F.filter(F.arrays_zip("spans", "parsed"), lambda z: z["spans"]["loss"])
    joined = parsed.select(
        "conv_id",
        F.size("parsed").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.array_join(F.transform(under, lambda z: z["parsed"]["text"]), "").alias("loss_text"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.when(fits, F.lit(None)).otherwise(F.raise_error(F.lit("the loss mask does not fit the turns"))).alias("bad"),
    )
    return joined.where(F.col("bad").isNull()).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )
