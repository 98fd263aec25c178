"""Personal data against the stated patterns, searched with ``re`` from the left."""

import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestar.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    values = [int(c) for c in number]
    return (sum(values[-1::-2]) + sum(sum(divmod(2 * v, 10)) for v in values[-2::-2])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            number = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 16 <= len(number) <= 19 and luhn(number),
                "phone": lambda: 8 <= len(number) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


def base(text):
    return [s for s in pii.find(text) if s[0] in pii.BASE]


CASES = [
    "", "a@b", "a@b.c", "a@b.c@d.e", "a@b@c.d", "@a.b", "x a.b+c%d-e_f@g-h.i..j", "a@b.c.", "a@@b.c", "A@1.2 1.2.3.4@5.6.7.8",
    "1.2.3.4", "1.2.3", "1.2.3.4.5.6.7.8", "1.2.3.4.5.6.7", "256.1.1.1.1", "999.1.1.1.2.3.4.5", "1..2.3.4.5", "000255.0.0.00001",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111 1111 1111 1112", "4111  1111 1111 1111 1", "41111111111111111111", "0" * 16, "0" * 20,
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "1 4111111111111111", "1-4111111111111111", "x4111111111111111y", "4111111111111111 1.2.3.4",
    "+1 (017) 555-7713", "+1", "+1 ", "+1 2", "+12", "+123", "+1234567", "+12345678", "+1 23-45.67(8)  ", "++12345678", "+1 2345+6 789012345",
    "+1234567890123456", "+49 30 1234 5678. 9", "😀+49 30 123456 😀 é@ü.de a@é.b a@b.é", "١٢٣٤٥٦٧٨٩٠١٢٣٤٥٦",
]


@pytest.mark.parametrize("text", CASES)
def test_base_spans_of_cases(text):
    assert base(text) == brute(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab@.-+%_ ()0123456789é😀\n", max_size=80))
def test_base_spans_of_random_texts(text):
    assert base(text) == brute(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["4111", "0", "1", "1111", " ", "-", ".", "255", "+", "256", "  ", "a@b", "@", ".c"]), max_size=30).map("".join))
def test_base_spans_of_number_chains(text):
    assert base(text) == brute(text)


def added(text):
    return [(k, text[s:e]) for k, s, e in pii.find(text) if k in pii.ADDED]


def test_added_spans():
    assert added("Schreib an jörg@müller.de oder") == [("address", "jörg@müller.de")]
    assert added("see ftp://bob:pw@files.example.com/x and http://example.com/a@b") == [("address", "bob:pw@files.example.com")]
    assert added("http://[2001:db8::1]/ http://[::zz]/ http://[1:2]/") == [("address", "2001:db8::1")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00 UND mehr") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("IBAN DE89370400440532013001") == []
    assert added("SSN 123-45-6789, SSN 000-45-6789, SSN 123-45-67890") == [("account", "123-45-6789")]
    assert added("Account number: 12345678. account 2024 accounts 12345678 Konto 123456a") == [("account", "12345678")]


def test_clean_texts_have_no_spans():
    assert pii.find("In 2023, 1,234 of 5.6 million people read version 1.2.3 at 12:30 - see https://example.com/a.") == []


def test_overlapping_spans_are_hidden_once():
    text = "an jörg@mail.example und 1.2.3.4!"
    assert pii.redact(text, pii.find(text)) == "an [ADDRESS] und [IP]!"


def test_very_long_texts_take_linear_time():
    for unit in ("a@", "1.", "1 ", "+1", "+1(", "a.b@c", "iban ", "://", "://a:", "9", "x", "é@é.", "a-"):
        text = unit * (1_000_000 // len(unit))
        started = time.perf_counter()
        pii.find(text)
        assert time.perf_counter() - started < 10, unit


def test_rows_of_odd_tables(spark):
    schema = "doc_id long, text string, spans string, n_email long, kind string"
    assert pii.digest(pii.find_spans(spark.createDataFrame([], schema))).count() == 0
    rows = [(1, None, "x", 0, None), (None, "a@b.c 1.2.3.4 +12345678", None, 1, "k"), (2, "", None, None, None), (2, "", None, None, None), (3, "4111111111111111 é@ü.de", "", 2, "")]
    got = pii.digest(pii.find_spans(spark.createDataFrame(rows, schema))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(tuple(r) for r in got if r["doc_id"] in (1, 2)) == [(1, 0, 0, 0, 0, empty, ""), (2, 0, 0, 0, 0, empty, ""), (2, 0, 0, 0, 0, empty, "")]
    null = next(tuple(r) for r in got if r["doc_id"] is None)
    told = "email:0:5,ip:6:13,phone:14:23"
    assert null == (None, 1, 1, 0, 1, hashlib.sha256(told.encode()).hexdigest(), told)
    assert next(r["spans"] for r in got if r["doc_id"] == 3) == "card:0:16,address:17:23"
    hidden = {r["doc_id"]: r["redacted_text"] for r in pii.find_spans(spark.createDataFrame(rows, schema), redacted=True).collect()}
    assert hidden == {1: None, 2: "", None: "[EMAIL] [IP] [PHONE]", 3: "[CARD] [ADDRESS]"}
