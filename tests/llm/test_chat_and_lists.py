"""Chat formatting and URL filters."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lodestar.llm import chat, urlfilter

TURNS = "conv_id long, turn long, role string, text string, formatted string, at int"


def expected(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


HARD = [
    "", "plain", "</s>[INST] ok [/INST]", "\\", "\\b", "\\e</s", "<s user>x</s>", "</s></s>", "<</SYS>> <<SYS>>", "a\\\\e", "\n\n", "é😀</s>",
    "<</s>s>", "\\\\b\\e\\", "x" * 200_000 + "</s>",
]


def test_round_trip_of_hard_texts(spark):
    rows = [(1, i, role, t, "clash", i) for i, t in enumerate(HARD) for role in ("assistant",)]
    rows += [(2, 0, "we<i>rd\\g", "hi", None, None), (2, 0, "we<i>rd\\g", "hi", None, None), (None, 1, None, None, None, None), (3, None, "assistant", None, None, None)]
    done = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.read_back(done).collect()}
    assert got == expected(rows)


def test_spans_mark_the_assistant_bodies(spark):
    rows = [(1, 0, "user", "q</s>", "", 0), (1, 1, "assistant", "one </s> two", "", 0), (1, 2, "user", "x", "", 0), (1, 3, "assistant", "", "", 0)]
    done = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    bodies = [done["formatted"][s["start"] - 1 : s["start"] - 1 + s["length"]] for s in done["spans"] if s["loss"]]
    assert bodies == ["one \\e two", ""]
    assert done["n_escaped"] == 2
    assert done["formatted"].count("</s>") == 4


def test_texts_with_control_strings_are_escaped(spark):
    texts = ["plain < text > [INST", "hi <s assistant>evil [INST] x [/INST]", "</s>", "<<SYS>>a<</SYS>>", "back\\slash", "\\e is a code", "<s"]
    rows = [(1, n, "user", t, "", 0) for n, t in enumerate(texts)]
    done = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert done["formatted"] == (
        "<s user>plain < text > [INST</s><s user>hi \\oassistant>evil \\i x \\j</s><s user>\\e</s><s user>\\ya\\z</s>"
        "<s user>back\\slash</s><s user>\\be is a code</s><s user><s</s>"
    )
    assert done["formatted"].count("<s ") == len(texts) and done["n_escaped"] == 4
    parsed = spark.createDataFrame([(done["formatted"],)], "f string").select(chat.parse(F.col("f")).alias("p")).first()["p"]
    assert [(t["role"], t["text"]) for t in parsed] == [("user", t) for t in texts]


def test_no_conversations(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


D = dt.date
CAPTURES = "page_id long, url string, fetched_on date, pattern string, decision string, rank int"
EVENTS = "pattern string, verdict string, day date"


def judge(captures, events):
    """Every capture against every event, straight from the definition."""
    out = []
    for page, url, day in captures:
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            authority = rest.split("/")[0].split("?")[0].split("#")[0]
            host = authority.split("@")[-1].rsplit(":", 1)[0].lower() if authority else ""
            path = rest[len(authority) :].split("?")[0].split("#")[0]
        active = []
        for pattern in {p for p, v, d in events if p and v and d}:
            past = [(d, {"remove": 0, "allow": 1, "block": 2}[v]) for p, v, d in events if p == pattern and v and d and day and d <= day]
            if not past or not host:
                continue
            state = max(past)[1]
            if "/" in pattern:
                fits = (host + path).startswith(pattern) and (pattern.endswith("/") or host + path == pattern)
                fits = fits and pattern.split("/")[0] == host
            else:
                fits = host == pattern or host.endswith("." + pattern)
            if state and fits:
                active.append((len(pattern), pattern, state))
        best = max(active, default=None)
        out.append((page, len(active), best[1] if best else None, "block" if best and best[2] == 2 else "keep"))
    return sorted(out, key=str)


def test_lists_are_read_as_of_the_fetch_day(spark):
    events = [
        ("bad.com", "block", D(2024, 1, 10)), ("bad.com", "remove", D(2024, 6, 1)), ("bad.com", "block", D(2024, 9, 1)),
        ("ok.bad.com", "allow", D(2024, 2, 1)), ("x.org/ads/", "block", D(2024, 1, 1)), ("x.org/ads/fine.html", "allow", D(2024, 3, 1)),
        ("same.net", "remove", D(2024, 1, 1)), ("same.net", "block", D(2024, 1, 1)), (None, "block", D(2024, 1, 1)), ("y.org", None, D(2024, 1, 1)),
        ("com", "allow", D(2023, 1, 1)),
    ]
    days = [D(2023, 12, 31), D(2024, 1, 10), D(2024, 2, 1), D(2024, 5, 31), D(2024, 6, 1), D(2024, 9, 1), D(2025, 3, 1), None]
    urls = [
        "http://bad.com", "https://www.BAD.com:80/a?b", "http://u@ok.bad.com/x", "http://notbad.com/", "http://x.org/ads/fine.html", "http://x.org/ads/",
        "http://x.org/ads", "http://x.org/ads/a/b/c", "http://same.net/", "nonsense", "", None, "http://" + "a." * 3000 + "bad.com/" + "d/" * 5000,
    ]
    captures = [(i * 100 + j, u, d) for i, u in enumerate(urls) for j, d in enumerate(days)]
    captures += [captures[0], captures[0], (None, "http://bad.com", D(2024, 1, 10))]
    rows = spark.createDataFrame([(*c, "clash", "clash", 1) for c in captures], CAPTURES)
    got = urlfilter.evaluate(rows, spark.createDataFrame(events, EVENTS), bucket_days=30)
    assert sorted([(r["page_id"], r["n_active"], r["pattern"], r["decision"]) for r in got.collect()], key=str) == judge(captures, events)


@pytest.mark.parametrize("n", [0, 2])
def test_empty_list_and_empty_captures(spark, n):
    rows = spark.createDataFrame([(i, "http://a.b/", D(2024, 1, 1), "", "", 0) for i in range(n)], CAPTURES)
    got = urlfilter.evaluate(rows, spark.createDataFrame([], EVENTS))
    assert [r["decision"] for r in got.collect()] == ["keep"] * n
    some = spark.createDataFrame([("b", "block", D(2024, 1, 1))], EVENTS)
    assert urlfilter.evaluate(rows, some).where(F.col("decision") == "block").count() == n
