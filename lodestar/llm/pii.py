"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers expand and validate them.

Anchors are at-signs, a plus before a digit, two digits beside each other or apart by one of space, hyphen and dot, ``://``, and
cue words of accounts. A parser starts at its anchor, expands to both sides and never looks beyond the run it stands in, so a
text is read once whatever its length. Every kind keeps the end of its last match, found or dropped, and starts behind it:
matches are leftmost and do not overlap within their kind, as those of a pattern searched from the left.

Base kinds: ``email``, ``ip`` (parts up to 255), ``card`` (16 to 19 digits that pass Luhn), ``phone`` (8 to 15 digits). Added
kinds, never in place of a base one: ``address`` (mail addresses with letters beyond ASCII, user names in front of the host of a
URL, IPv6 hosts in brackets) and ``account`` (a cue word followed by an IBAN with a right remainder, a social security number in
a valid range, or 6 to 18 digits that no letter or digit touches).

Defined results: every row gives a row; a null or empty text has no spans; repeated rows each give theirs; a null id stays null;
whole texts are read; other columns are ignored; an empty table gives no rows. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_letters, digits

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "account")
KINDS = BASE + ADDED
SPANS = "array<struct<kind: string, start: int, end: int>>"

# fixed values: cue words of account numbers
CUES = ("iban", "account", "acct", "konto", "compte", "cuenta", "ssn", "social security number")

_LOCAL = ascii_letters + digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_WIDE_DOMAIN = re.compile(r"[^\W_](?:[\w-]*[^\W_])?(?:\.[^\W_](?:[\w-]*[^\W_])?)*\.[^\W\d_]{2,}")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USER = re.compile(r"[^\s/?#@:]+(?::[^\s/?#@]*)?@[A-Za-z0-9.-]*[A-Za-z0-9]")
_BRACKETS = re.compile(r"(?:[^\s/?#@]*@)?\[([0-9A-Fa-f:.]{2,45})\]")
_AFTER_CUE = re.compile(r"\s{0,4}(?:number|no|nr|num|n°|#)?\.?\s{0,4}[:#=]?\s{0,4}", re.IGNORECASE)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SOCIAL = re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}")
_ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,17}")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchor -> ``(parser, length)``; the patterns follow from rules and the cue words."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("mail", 1))
    found.add_word("://", ("scheme", 3))
    for a in digits:
        found.add_word("+" + a, ("phone", 2))
        for b in digits:
            for between in ("", " ", "-"):
                found.add_word(a + between + b, ("chain", 2 + len(between)))
            found.add_word(f"{a}.{b}", ("dotted", 3))
    for cue in CUES:
        for word in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(word, (cue, len(word)))
    found.make_automaton()
    return found


def _left(text: str, at: int, least: int, allowed: str) -> int:
    """Start of the run of allowed characters that ends before ``at``, not before ``least``."""
    while at > least:
        part = text[max(least, at - 64) : at]
        rest = len(part.rstrip(allowed))
        at -= len(part) - rest
        if rest:
            break
    return at


def _luhn(number: str) -> bool:
    total = 0
    for n, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _card(chain: str) -> bool:
    number = chain.replace(" ", "").replace("-", "")
    return 16 <= len(number) <= 19 and _luhn(number)


def _octet(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or 0) <= 255


def _iban_end(text: str, start: int) -> int | None:
    """End of the longest prefix that stops at a boundary and leaves the remainder 1 when divided by 97."""
    run = _IBAN.match(text, start)
    for end in range(run.end(), start + 14, -1) if run else ():
        if text[end - 1] == " " or text[end : end + 1].isalnum():
            continue
        code = text[start:end].replace(" ", "")
        if len(code) >= 15 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return end
    return None


def _free(text: str, start: int, end: int) -> bool:
    """Whether no letter or digit touches the span."""
    return not (text[end : end + 1].isalnum() or (start and text[start - 1].isalnum()))


class _Reader:
    """The parsers of one text and what they have found; ``done`` is the end of the last match of each parser."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[str, int, int]] = []
        self.done = dict.fromkeys(("mail", "dotted", "chain", "phone"), 0)
        self.at_sign = 0

    def mail(self, at: int) -> None:
        text, least = self.text, self.at_sign
        start = _left(text, at, max(self.done["mail"], least), _LOCAL)
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            self.spans.append(("email", start, found.end()))
            self.done["mail"] = found.end()
        wide = at
        while wide > least and (text[wide - 1].isalnum() or text[wide - 1] in "._%+-"):
            wide -= 1
        while wide < at and not text[wide].isalnum():
            wide += 1
        beyond = _WIDE_DOMAIN.match(text, at + 1) if wide < at else None
        if beyond and not text[wide : beyond.end()].isascii():
            self.spans.append(("address", wide, beyond.end()))
        self.at_sign = at + 1

    def dotted(self, at: int) -> None:
        if at < self.done["dotted"]:
            return
        run = _DOTTED.match(self.text, _left(self.text, at, self.done["dotted"], digits))
        self.done["dotted"] = run.end()
        start, parts = run.start(), run.group().split(".")
        for n in range(0, len(parts) - 3, 4):
            four = parts[n : n + 4]
            end = start + sum(map(len, four)) + 3
            if all(map(_octet, four)):
                self.spans.append(("ip", start, end))
            start = end + 1

    def chain(self, at: int) -> None:
        if at >= self.done["chain"]:
            run = _CHAIN.match(self.text, at)
            self.done["chain"] = run.end()
            if _card(run.group()):
                self.spans.append(("card", *run.span()))

    def phone(self, at: int) -> None:
        run = _PHONE.match(self.text, at)
        if run and 8 <= sum(c in digits for c in run.group()) <= 15:
            self.spans.append(("phone", *run.span()))

    def scheme(self, at: int) -> None:
        after = at + 3
        user, host = _USER.match(self.text, after), _BRACKETS.match(self.text, after)
        if user:
            self.spans.append(("address", *user.span()))
        if host:
            try:
                ipaddress.IPv6Address(host.group(1))
            except ValueError:
                return
            self.spans.append(("address", *host.span(1)))

    def cue(self, word: str, at: int, length: int) -> None:
        text = self.text
        if not _free(text, at, at + length):
            return
        start = _AFTER_CUE.match(text, at + length).end()
        if word == "iban":
            end = _iban_end(text, start)
        elif word in ("ssn", "social security number"):
            run = _SOCIAL.match(text, start)
            end = run.end() if run and _free(text, start, run.end()) else None
        else:
            run = _ACCOUNT.match(text, start)
            end = run.end() if run and _free(text, start, run.end()) else None
        if end is not None:
            self.spans.append(("account", start, end))


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of one text, by kind as listed in ``KINDS``, then start."""
    reader = _Reader(text)
    for last, (parser, length) in automaton().iter(text):
        at = last + 1 - length
        step = getattr(reader, parser, None)
        if step:
            step(at)
        else:
            reader.cue(parser, at, length)
    return sorted(set(reader.spans), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, overlapping ones together, replaced by the kind of the first in brackets."""
    out, done, last = [], 0, -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = last = max(last, end)
    return "".join([*out, text[done:]])


def find_spans(docs: DataFrame, redacted: bool = False) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs(doc_id, text)``, with ``redacted`` also ``redacted_text``."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    names = ["doc_id", "spans"] + ["redacted_text"] * redacted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                texts = batch.column("text").to_pylist()
                found = [find(t) if t else [] for t in texts]
                columns = [
                    batch.column("doc_id"),
                    pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in found], span_type),
                ]
                if redacted:
                    hidden = [t and redact(t, s) for t, s in zip(texts, found)]
                    columns.append(pa.array(hidden, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPANS}" + ", redacted_text string" * redacted)


def of_kinds(spans: str, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    """``kind:start:end``, joined by commas in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans and the list of all spans."""
    counts = [F.size(of_kinds("spans", (k,))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(listed(of_kinds("spans", BASE)), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
