"""HTML extraction, SentencePiece, license scan, mixing, near-duplicates, quality classifier."""

import collections
import itertools
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import htmltext, licence_texts, licences, mixing, neardup, pieces, quality, queries

MODEL = queries.PIECES_MODEL
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key string, kept boolean"


def documents(spark, rows):
    """``(doc_id, text, lang, source)`` with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(*r, 0, "clash", "clash", False) for r in rows], DOCS)


# ---- HTML

PAGE = (
    '<html><head><title>T &amp; t</title><style>p{}</style></head><body><nav><a href="x">menu one</a></nav><header>site name</header>'
    '<div class="cookie-notice">We use cookies a lot here</div><article><h1>Head&nbsp;line</h1><p>First <b>bold</b>text &lt;p&gt; \n  x.'
    '<p>Second<br>line</p><aside>side story</aside><script>var a="</p>";</script><form>fill <input name=q> in</form><!-- <p>no</p> -->'
    "<ul><li>a</li><li>b</li></ul><p>Tail.</p></article><section id='comments'><p>I disagree strongly with this</p></section>"
    "<footer>&copy; someone</footer></body></html>"
)
PAGE_TEXT = "Head line\nFirst boldtext <p> x.\nSecond line\na\nb\nTail."


def best_by_hand(features, weights):
    best, found = 0.0, None
    for i, j in itertools.combinations_with_replacement(range(len(features)), 2):
        total = sum(n * htmltext.weight(weights, name) for name, n in features[i : j + 1])
        if total > best + 1e-9:
            best, found = total, (i, j)
    return best


def test_article_text():
    weights = htmltext.fit_weights([PAGE] * 3)
    assert htmltext.extract(PAGE, weights) == PAGE_TEXT
    assert htmltext.extract(PAGE, htmltext.starting_weights()) == PAGE_TEXT
    assert all(w > 0 if name == "word" else w < 0 for name, w in weights.items())
    unlabelled = PAGE.replace("<article>", '<div class="story">').replace("</article>", "</div>")
    assert htmltext.extract(unlabelled, weights) == PAGE_TEXT


@pytest.mark.parametrize(
    "old,new",
    [
        ("<article>", '<article class="post comments-open share-enabled">'),
        ("<article>", '<article class="x" title="a hidden gem">'),
        ("<h1>", '<h1 id="related-work">'),
        ("<p>Tail.</p>", '<section id="social-history"><p>Tail.</p></section>'),
        ("<b>bold</b>", '<a title="a hidden gem">bold</a>'),
    ],
)
def test_marks_do_not_hide_the_article(old, new):
    for weights in (htmltext.fit_weights([PAGE] * 3), htmltext.starting_weights()):
        assert htmltext.extract(PAGE.replace(old, new), weights) == PAGE_TEXT


def test_wrappers_of_the_article_are_not_masked():
    weights = htmltext.fit_weights([PAGE] * 3)
    wrapped = PAGE.replace("<article>", '<div class="content-sidebar-wrap"><article>').replace("</article>", "</article></div>")
    assert htmltext.extract(wrapped, weights) == PAGE_TEXT
    main = PAGE.replace("<article>", '<main class="with-sidebar">').replace("</article>", "</main>")
    assert htmltext.extract(main, weights) == PAGE_TEXT
    story = PAGE.replace("<article>", '<div class="with-sidebar">').replace("</article>", "more words here " * 9 + "</div>")
    assert htmltext.extract(story, weights).startswith(PAGE_TEXT)


def test_region_has_the_highest_sum():
    rng = random.Random(3)
    for _ in range(200):
        features = [rng.choice([("word", rng.randint(0, 4)), ("p", 1), ("/p", 1), ("div", 1), ("article", 1), ("!nav", 1)]) for _ in range(14)]
        weights = {"word": 1.0, "p": -0.5, "/p": -1.0, "div": -2.5, "article": -4.0}
        region = htmltext.best_region(features, weights)
        total = sum(n * htmltext.weight(weights, name) for name, n in features[region[0] : region[1] + 1]) if region else 0.0
        assert math.isclose(total, best_by_hand(features, weights), abs_tol=1e-9)


@pytest.mark.parametrize("page", ["<", "<<<>", "<p", "<a href='", "&amp", "plain words", "<script>x", "</article></div>", "<!--", "<nav>a", "\x00<b>"])
def test_broken_pages_do_not_fail(page):
    htmltext.extract(page, htmltext.starting_weights())


def test_pages_table(spark):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "word " * 200_000)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in htmltext.extract_pages(pages).collect()]
    want = [(1, "u", PAGE_TEXT, len(PAGE_TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", ("word " * 200_000).strip(), 999_999)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert htmltext.extract_pages(pages.limit(0)).count() == 0


# ---- SentencePiece

needs_model = pytest.mark.skipif(not os.path.exists(MODEL), reason="the public vocabulary file is not here")


def toy(words):
    scores = {w: (i + 3, s) for i, (w, s) in enumerate(words.items())}
    return pieces.Vocabulary(scores, [-1] * 256, 0, [b""] * 3 + [w.replace("▁", " ").encode() for w in words])


def best_sum(s, v):
    best = [0.0] + [-math.inf] * len(s)
    for end in range(1, len(s) + 1):
        for start in range(end):
            if s[start:end] in v.scores:
                best[end] = max(best[end], best[start] + v.scores[s[start:end]][1])
        if s[end - 1] not in v.scores:
            best[end] = max(best[end], best[end - 1] + v.unknown_score)
    return best[-1]


def test_viterbi_finds_the_best_sum_and_commits_early():
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))): -rng.uniform(1, 9) for _ in range(40)}
    v = toy(words | {c: -10.0 for c in "abc"})
    encoder = pieces.Encoder(v)
    score = {i: s for i, s in v.scores.values()}
    for n in (0, 1, 7, 300, 5000):
        s = "".join(rng.choice("abc") for _ in range(n))
        ids = encoder.viterbi(s)
        assert b"".join(v.surface[i] for i in ids).decode() == s
        assert math.isclose(sum(score[i] for i in ids), best_sum(s, v), abs_tol=1e-6)
        if 0 < n <= 4 * v.longest:
            assert encoder.short(s) == ids
    assert encoder.most_pending < 200


@needs_model
def test_round_trip_is_exact():
    v = pieces.load_vocabulary(MODEL)
    encoder = pieces.Encoder(v, cached_words=50)
    rng = random.Random(6)
    texts = ["", " ", "  a", "a  b ", "\n\n", "▁", "a▁b ▁▁ ", "日本語😀 x", "a\tb\r\n", "x" * 3000, "ab " * 2000, "﷐\x00"]
    texts += ["".join(rng.choice("abe ▁\né$日") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    for text in texts:
        ids = encoder.encode(text).tolist()
        assert pieces.decode(ids, v) == text
        if "▁" not in text and "﷐" not in text and text:
            whole = "▁" + text.replace(" ", "▁")
            score = {i: s for i, s in v.scores.values()}
            got = sum(score.get(i, 0.0) for i in ids)
            unknown = sum(1 for c in whole if c not in v.scores)
            assert math.isclose(got + unknown * v.unknown_score, best_sum(whole, v), rel_tol=1e-9)


@needs_model
def test_encoded_table(spark):
    rows = [(1, "some text\nmore", "en", "s"), (1, "some text\nmore", "en", "s"), (None, "x", None, None), (2, None, "en", "s"), (3, "", "en", "s"), (4, "word " * 50_000, "en", "s")]
    got = pieces.encode_documents(documents(spark, rows), pieces.load_vocabulary(MODEL), keep=("lang",)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["ids"] is None) == (r["doc_id"] == 2) and r["n_ids"] == len(r["ids"] or [])
        assert r["identical"] is (None if r["doc_id"] == 2 else True)
    assert pieces.encode_documents(documents(spark, []), pieces.load_vocabulary(MODEL)).count() == 0


# ---- license scan


def test_winnowing_keeps_a_fingerprint_of_every_common_run():
    rng = np.random.default_rng(7)
    for _ in range(50):
        run = rng.integers(1, 9, 5)
        a, b = np.concatenate([rng.integers(1, 9, 20), run, rng.integers(1, 9, 9)]), np.concatenate([rng.integers(1, 9, 6), run])
        marks = [set(licences._hashes(x, 3)[licences.winnow(x, 3, 3)].tolist()) for x in (a, b)]
        assert marks[0] & marks[1]


def local_score(words, template):
    best, rows = 0, [[0] * (len(template) + 1)]
    for w in words:
        row = [0]
        for j, t in enumerate(template, 1):
            row.append(max(0, rows[-1][j - 1] + (1 if w == t else -1), rows[-1][j] - 1, row[j - 1] - 1))
            best = max(best, row[-1])
        rows.append(row)
    return best


def test_alignment_equals_the_full_table_in_a_wide_band():
    rng = np.random.default_rng(8)
    for _ in range(60):
        words, template = rng.integers(0, 4, 15), rng.integers(1, 4, 8)
        path = licences.align(words, template, 0, 25)
        assert (path[0] if path else 0) == local_score(words.tolist(), template.tolist())


def test_licenses_and_their_spans(spark):
    edited = licence_texts.MIT.replace("free of charge", "at no charge").replace("publish, ", "")
    texts = {
        1: "prose here.\nLicensed under CC BY-NC 4.0.\nmore", 2: "The works. This work is licensed under the GNU General Public License, version 3.", 3: "x " * 400_000 + edited + " y",
        4: "Released under the MIT License. Later: Licensed under the Apache License, Version 2.0.", 5: "a license is fine to talk about, under the law", 6: "", 7: None,
    }
    rows = [(i, t, "en", "s") for i, t in texts.items()] + [(1, texts[1], "en", "s"), (None, texts[1], None, None)]
    got = licences.scan(documents(spark, rows), licence_texts.templates()).collect()
    found = collections.Counter((r["doc_id"], r["license"]) for r in got)
    assert found == {(1, "CC-BY-NC-4.0"): 2, (None, "CC-BY-NC-4.0"): 1, (2, "GPL-3.0"): 1, (3, "MIT"): 1, (4, "MIT"): 1, (4, "Apache-2.0"): 1}
    spans = {(r["doc_id"], r["license"]): texts.get(r["doc_id"], texts[1])[r["start"] : r["end"]] for r in got}
    assert spans[1, "CC-BY-NC-4.0"] == "Licensed under CC BY-NC 4.0"
    assert spans[4, "Apache-2.0"] == "Licensed under the Apache License, Version 2.0"
    assert spans[3, "MIT"].startswith("Permission is hereby") and spans[3, "MIT"].endswith("NONINFRINGEMENT")
    assert licences.scan(documents(spark, []), licence_texts.templates()).count() == 0


def test_letters_that_lower_case_to_two_do_not_move_spans():
    index = licences.Index(licence_texts.templates())
    notice = "Licensed under CC BY-NC 4.0"
    for text in (f"\u0130stanbul, \u0130zmir. {notice}", f"\u0130stanbul {notice} and more words"):
        assert [(m[0], text[m[4] : m[5]]) for m in index.matches(text)] == [("CC-BY-NC-4.0", notice)]


def test_one_changed_word_at_each_place_is_found():
    index = licences.Index(licence_texts.templates())
    for t, wording in enumerate(index.templates):
        if len(wording) > 25:
            continue
        name = {n: w for w, n in index.words.items()}
        for place in range(len(wording)):
            words = [name[n] for n in wording]
            words[place] = "otherword"
            ids = index.number(" ".join(words))
            path = licences.align(ids, wording, 0, max(2, len(wording) // 5))
            if path[1] >= licences.COVERAGE * len(wording):
                assert index.matches(" ".join(["some", "prose", *words, "after"])), (index.names[t], place)
    assert [m[0] for m in index.matches("It is released under an MIT License")] == ["MIT"]
    assert [m[0] for m in index.matches("It is licensed under the MIT Licence")] == ["MIT"]


# ---- mixing


def fill(budget, caps, weights):
    """Water level by bisection."""
    if budget >= sum(caps):
        return list(caps)
    low, high = 0.0, 1e12
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(c, mid * w) for c, w in zip(caps, weights)) < budget else (low, mid)
    return [min(c, high * w) for c, w in zip(caps, weights)]


def test_shortages_go_to_siblings_first(spark):
    rng = random.Random(9)
    leaves = [(d, f"{d}{s}", rng.randint(1, 500)) for d in "abc" for s in range(4)]
    weights = {"top": {"a": 5.0, "b": 1.0, "c": 0.0}, "leaf": {"a1": 7.0, "b2": 0.0}}
    frame = spark.createDataFrame(leaves, "top string, leaf string, tokens long")
    for share, epochs in ((0.1, 1), (0.5, 1), (0.9, 2), (3.0, 2)):
        budget = share * sum(x[2] for x in leaves)
        got = {r["leaf"]: r["target"] for r in mixing.leaf_targets(frame, ["top", "leaf"], weights, budget, epochs).collect()}
        w = lambda level, name: weights[level].get(name, 1.0)
        caps = {x[1]: x[2] * epochs * (w("leaf", x[1]) > 0) * (w("top", x[0]) > 0) for x in leaves}
        tops = fill(budget, [sum(caps[x[1]] for x in leaves if x[0] == d) for d in "abc"], [w("top", d) for d in "abc"])
        for d, target in zip("abc", tops):
            own = [x[1] for x in leaves if x[0] == d]
            for leaf, t in zip(own, fill(target, [caps[x] for x in own], [w("leaf", x) for x in own])):
                assert math.isclose(got.get(leaf, 0.0), t, rel_tol=1e-6, abs_tol=1e-6)


def test_mixing_takes_prefixes_of_seeded_epochs(spark):
    rng = random.Random(10)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", "de", None]), rng.choice(["src0", "src1", "odd", None])) for i in range(600)]
    rows += [rows[5], rows[5], (None, "a b", "en", "src0"), (700, None, "en", "src0"), (701, "", "de", "src1")]
    docs = documents(spark, rows)
    taken = mixing.mix(docs, queries.mix_levels(), queries.MIX_WEIGHTS, 0.7, 2, 3, epoch="epoch").collect()
    assert set(taken[0].asDict()) == {*docs.columns, "epoch"}
    n = {i: len((t or "").split()) for i, t, *_ in rows}
    total = sum(len((r[1] or "").split()) for r in rows)
    assert 0.6 * total < sum(n[r["doc_id"]] for r in taken) <= 0.7 * total
    assert not any(r["doc_id"] in (700, 701) for r in taken)
    times = collections.Counter((r["doc_id"], r["epoch"]) for r in taken)
    assert times[5, 1] in (0, 3) or rows[5][1] == ""
    again = mixing.mix(docs.repartition(7), queries.mix_levels(), queries.MIX_WEIGHTS, 0.7, 2, 3, epoch="epoch").collect()
    assert collections.Counter(map(str, again)) == collections.Counter(map(str, taken))
    assert mixing.mix(docs.limit(0), queries.mix_levels(), queries.MIX_WEIGHTS).count() == 0
    assert mixing.mix(docs, queries.mix_levels(), queries.MIX_WEIGHTS, 9.0, 2, 3).count() == 2 * sum(bool((r[1] or "").split()) for r in rows)


# ---- near-duplicates


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[at] = f"new{rng.randrange(10**6)}"
        elif kind < 0.8:
            del words[at]
        else:
            words.insert(at, f"new{rng.randrange(10**6)}")
    return words


def plain_similarity(a, b):
    """The same measure by a full table of edit distances with insertions and deletions."""
    n, m = len(a), len(b)
    d = [[i + j if not i * j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = d[i - 1][j - 1] if a[i - 1] == b[j - 1] else 1 + min(d[i - 1][j], d[i][j - 1])
    return d[n][m]


def group_by_hand(rows):
    number = neardup.WordNumbers()
    words = {n: number(t) for n, (_, t, *_) in enumerate(rows)}
    parent = {n: n for n in words}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(words, 2):
        if len(words[a]) and len(words[b]):
            x, y = words[a].astype(np.uint32), words[b].astype(np.uint32)
            if neardup.aligned_similarity(x, y) >= 0.8:
                parent[find(b)] = find(a)
    groups = collections.defaultdict(list)
    for n in words:
        groups[find(n)].append(n)
    out = collections.Counter()
    for members in groups.values():
        ids = [rows[n][0] for n in members if rows[n][0] is not None]
        for n in members:
            best = min(ids, default=None)
            out[rows[n][0], best, rows[n][0] == best] += 1
    return out


def corpus(seed, bases, copies, most_edits, length):
    rng = random.Random(seed)
    rows, passage = [], [f"shared{i}" for i in range(60)]
    for b in range(bases):
        base = [f"w{rng.randrange(3000)}" for _ in range(length)]
        if b % 3 == 0:
            base[10:10] = passage
        rows.append(base)
        rows += [edited(rng, base, rng.randint(0, most_edits)) for _ in range(copies)]
    return [(i, " ".join(w), "en", "s") for i, w in enumerate(rows)]


def test_groups_equal_all_pairs(spark):
    rows = corpus(11, 12, 6, 6, 150)
    rows += [(500, rows[0][1].upper() + " !!", "en", "s"), (501, "", "en", "s"), (502, None, "en", "s"), (503, "a b", "en", "s"), (504, "A, b.", "en", "s"), rows[3], rows[3]]
    got = neardup.near_duplicate_groups(documents(spark, rows)).collect()
    assert collections.Counter((r["doc_id"], r["group_id"], r["kept"]) for r in got) == group_by_hand(rows)


def test_large_group_with_a_hub_and_divided_buckets(spark):
    rng = random.Random(12)
    base = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(edited(rng, base, i % 9)), "en", "s") for i in range(120)]
    got = neardup.near_duplicate_groups(documents(spark, rows), small=8).collect()
    assert collections.Counter((r["doc_id"], r["group_id"], r["kept"]) for r in got) == group_by_hand(rows)


def test_alignment_has_the_fewest_edits():
    rng = random.Random(13)
    for _ in range(60):
        a = [rng.randrange(50) for _ in range(rng.randint(20, 60))]
        b = [x for x in edited(rng, a, rng.randint(0, 3))]
        b = [x if isinstance(x, int) else 1000 + n for n, x in enumerate(b)]
        got = neardup.aligned_similarity(np.array(a), np.array(b), least=0.01)
        n = max(1, len(a) - 4), max(1, len(b) - 4)
        most = (len(a) + len(b) - plain_similarity(a, b)) / 2
        assert 0.0 <= got <= 1.0 and (got == 1.0) == (a == b)
        assert got * sum(n) / (1 + got) <= most + 1e-9
    swap = np.arange(100)
    changed = swap.copy()
    changed[50] = 999
    assert math.isclose(neardup.aligned_similarity(swap, changed), (96 - 5) / (96 + 96 - 91))
    assert neardup.aligned_similarity(swap, swap[::-1].copy()) == 0.0


def test_near_duplicates_broadcast_no_table_of_the_corpus(spark, monkeypatch):
    """Every such table would be built in the driver; only the components of the links are left to Spark."""
    plans, write = [], neardup.store

    def plan(df):
        if df.columns != ["node", "component"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(neardup, "store", lambda df: write(plan(df)))
    near = lambda i, n: " ".join(f"w{i}" if j == n else f"v{j}" for j in range(60))
    rows = [(k, near(k, k % 50), None, None) for k in range(80)] + [(100 + k, f"a{k} b c d e f g h", None, None) for k in range(20)]
    plan(neardup.near_duplicate_groups(documents(spark, rows), small=4)).count()
    assert sum("SortMergeJoin" in p for p in plans) > 5
    assert not [p for p in plans if "BroadcastExchange" in p]


def test_near_duplicates_of_odd_tables(spark):
    assert neardup.near_duplicate_groups(documents(spark, [])).count() == 0
    got = neardup.near_duplicate_groups(documents(spark, [(1, None, None, None), (2, "  ", None, None), (None, "x y", None, None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["group_id"]), r["kept"]) for r in got) == [("1", "1", True), ("2", "2", True), ("None", "None", True)]


# ---- quality classifier


def plain_model(trusted):
    """Interpolated modified Kneser-Ney from dictionaries; every trusted word is in the vocabulary."""
    pairs, tokens = collections.Counter(), collections.Counter()
    for lang, text in trusted:
        words = (text or "").split()
        tokens.update((lang, w) for w in words)
        pairs.update(((lang, a), (lang, b)) for a, b in zip([None, *words], words))
    pairs = collections.Counter({((lang_b[0], a[1]), lang_b): n for (a, lang_b), n in pairs.items()})
    return pairs, tokens


def test_scores_equal_a_plain_model(spark):
    rng = random.Random(14)
    word = lambda: f"w{int(rng.paretovariate(0.8)) % 60}"
    trusted = [("en" if i % 3 else "de", " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(80)]
    docs = [(i, t, lang, "s") for i, (lang, t) in enumerate(trusted)]
    model = quality.train(documents(spark, docs))
    pairs, tokens = collections.Counter(), collections.Counter()
    for lang, text in trusted:
        words = text.split()
        tokens.update((lang, w) for w in words)
        # the first word of every document follows one mark, whatever the language
        pairs.update((("", "^") if not n else (lang, words[n - 1]), (lang, w)) for n, w in enumerate(words))
    n1, n2, n3, n4 = (sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    d = [0, *np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.95, 2.95])]
    total, held, after = collections.Counter(), collections.Counter(), collections.Counter()
    for (a, b), c in pairs.items():
        total[a] += c
        held[a] += d[min(c, 3)]
        after[b] += 1
    k1, k2 = sum(c == 1 for c in after.values()), sum(c == 2 for c in after.values())
    cut = k1 / (k1 + 2 * k2) if k1 and k2 else 0.5

    def log_prob(lang, text):
        out, words = 0.0, text.split()
        own = [w for w in tokens if w[0] == lang]
        mass, size = sum(after[w] for w in own), sum(tokens[w] for w in own)
        for n, w in enumerate(words):
            share = 1 / (size + 2)
            if (lang, w) not in tokens:
                out += math.log(share / 1)
                continue
            p = max(after[lang, w] - cut, 0) / mass + cut * sum(after[x] > 0 for x in own) / mass / len(own)
            a = ("", "^") if not n else (lang, words[n - 1])
            if total[a]:
                c = pairs[a, (lang, w)]
                p = (c - d[min(c, 3)]) / total[a] * (c > 0) + held[a] / total[a] * p
            out += math.log((1 - share) * p)
        return out

    asked = docs + [(900, "w1 w2 never w3 seen", "en", "s"), (901, "", "en", "s"), (902, None, "en", "s"), (None, "w1", "de", "s"), docs[4], docs[4]]
    got = quality.score(documents(spark, asked).repartition(5, "doc_id"), model).collect()
    assert len(got) == len(asked)
    text_of = {i: (lang, t or "") for i, t, lang, _ in asked}
    for r in got:
        lang, text = text_of[r["doc_id"]]
        assert r["n_words"] == len(text.split())
        assert math.isclose(r["log_prob"], log_prob(lang, text), rel_tol=1e-9, abs_tol=1e-9), r
        assert (r["log_perplexity"] is None) == (not text.split())


def test_every_trusted_word_is_known(spark):
    # 70,000 words that occur once, and frequent ones of another language
    rare = [(i, " ".join(f"r{j}" for j in range(i * 700, i * 700 + 700)), "de", "s") for i in range(100)]
    rows = rare + [(1000, "a b " * 5_000, "en", "s")]
    model = quality.train(documents(spark, rows))
    asked = [(1, "r69300 r5", "de", "s"), (2, "never r69301", "de", "s"), (3, rare[99][1], "de", "s")]
    got = {r["doc_id"]: r["log_prob"] for r in quality.score(documents(spark, asked), model).collect()}
    # all words end one bigram; the first word of a text follows the start, the next one an unseen word pair
    u, mass, start = 1 / 70_002, 70_000, 101
    first = math.log((1 - u) * ((1 - 0.5) / start + 0.5 / mass * (101 / start)))
    follows = math.log((1 - u) * (0.5 + 0.5 / mass))
    # r69300 is followed by r69301 only, so r5 after it has the rest of that context
    assert math.isclose(got[1], first + math.log((1 - u) * 0.5 / mass), rel_tol=1e-9)
    assert math.isclose(got[2], math.log(u) + math.log((1 - u) / mass), rel_tol=1e-9)
    assert math.isclose(got[3], first + 699 * follows, rel_tol=1e-9)


def test_equal_partitions_each_get_their_rows(spark, tmp_path):
    documents(spark, [(i, f"a b w{i % 7} {i}", "en", "s") for i in range(40)]).coalesce(1).write.parquet(str(tmp_path / "docs"))
    once = spark.read.parquet(str(tmp_path / "docs"))
    got = quality.score(once.unionByName(once), quality.train(once)).collect()
    assert collections.Counter(r["doc_id"] for r in got) == dict.fromkeys(range(40), 2)
    assert len({(r["doc_id"], r["log_prob"]) for r in got}) == 40


def test_classifier_separates_held_out_documents(spark):
    rng = random.Random(15)
    clean = lambda: " ".join(f"w{int(rng.paretovariate(0.9)) % 400}" for _ in range(rng.randint(30, 120)))
    noise = lambda: " ".join(f"z{rng.randrange(10**6)}%%" for _ in range(rng.randint(30, 120)))
    rows = [(i, clean() if i % 5 else noise(), "en" if i % 2 else None, "s") for i in range(1500)]
    trusted = documents(spark, rows).where((F.col("doc_id") % 5 != 0) & (F.col("doc_id") < 900)).select("doc_id")
    got = quality.classify(documents(spark, rows), trusted).toPandas()
    later = got[got.doc_id >= 900]
    assert later[later.doc_id % 5 != 0].kept.mean() > 0.97
    assert not later[later.doc_id % 5 == 0].kept.any()


def test_small_and_unknown_languages_are_not_dropped(spark):
    rng = random.Random(16)
    # the small language repeats itself less, so that its perplexity is higher
    text = lambda lang, most: " ".join(f"{lang}{rng.randrange(most)}" for _ in range(60))
    rows = [(i, text("e", 40), "en", "s") for i in range(900)] + [(i, text("k", 900), "kk", "s") for i in range(900, 1040)]
    rows += [(i, text("x", 300), lang, "s") for i, lang in zip(range(1040, 1080), itertools.cycle(["xx", None]))]
    rows += [(i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(60)), "kk", "s") for i in range(1080, 1100)]
    trusted = documents(spark, rows).where("doc_id < 600 OR doc_id BETWEEN 900 AND 1019").select("doc_id")
    got = quality.classify(documents(spark, rows), trusted).toPandas().set_index("doc_id").kept
    assert got.loc[1020:1039].mean() >= 0.9
    assert got.loc[1040:1079].all()
    assert not got.loc[1080:1099].any()


def test_classifier_of_odd_tables(spark):
    none = documents(spark, [])
    ids = none.select("doc_id")
    assert quality.classify(none, ids).count() == 0
    some = documents(spark, [(1, "a b", "en", "s"), (2, None, None, None), (None, "x", None, None)])
    got = {r["doc_id"]: r["kept"] for r in quality.classify(some, ids).collect()}
    assert got == {1: True, 2: False, None: True}
    assert quality.classify(some, some.select("doc_id")).count() == 3


def test_blocks_pack_and_unpack():
    a, b = np.sort(np.random.default_rng(1).integers(0, 2**32, 500)).astype(np.uint32), np.arange(3, dtype=np.int64)
    steps, c = quality._unpack(quality._pack(quality._differences(a), b), np.uint32, np.int64)
    assert (np.cumsum(steps, dtype=np.uint64) == a).all() and (c == b).all()


def test_decoding_a_table_and_bad_ids(spark):
    v = pieces.load_vocabulary(MODEL)
    texts = [(1, "Über  den\nWolken \U0001f600\u2581", "de", "s"), (2, "", "en", "s"), (3, None, "en", "s"), (1, "again", "en", "s")]
    encoded = pieces.encode_documents(documents(spark, texts), v, keep=("lang",))
    back = sorted(((r["doc_id"], r["lang"], r["text"]) for r in pieces.decode_documents(encoded, v, keep=("lang",)).collect()), key=str)
    assert back == sorted(((i, c, t) for i, t, c, _ in texts), key=str)
    byte = v.byte_ids
    assert pieces.decode([byte[0xE2], byte[0x82]], v) == "\ufffd"
    assert pieces.decode([byte[0x41], -5, len(v.surface), None, byte[0x42]], v) == "A\ufffd\ufffd\ufffdB"
    assert pieces.decode([], v) == ""
    bad = spark.createDataFrame([(1, [byte[0xFF], -1], 0), (None, None, 1)], "doc_id long, ids array<int>, text int")
    assert sorted((str(r["doc_id"]), r["text"]) for r in pieces.decode_documents(bad, v).collect()) == [("1", "\ufffd\ufffd"), ("None", None)]
