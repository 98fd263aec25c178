"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of tags and runs of text. Words score positive and tags negative; an element that is never
article text (menu, footer, form, script, advert ...) scores as one negative tag and its words not at all. One
linear scan finds the contiguous region with the highest sum; the text is that of the region's blocks, without such elements.

The weights are fitted on labelled pages: a bounded sample (``sample_pages`` pages of at most ``sample_chars``
characters, chosen by hash) of pages with exactly one ``article`` or ``main`` element, whose content is the label.
A structured perceptron raises the weights of tokens that the best region wrongly leaves out and lowers those
it wrongly takes in. A table without labelled pages uses the starting weights.

Blocks are separated by block-level tags; ``br`` and table cells are white space. Character references are decoded
after the markup is gone. Nothing is cut: whole pages are scanned.

Defined results: a null or empty page, or one without words, gives an empty text; repeated rows each get their row; a
null url stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 256
SAMPLE_CHARS = 100_000
EPOCHS = 6

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head nav aside footer form dialog menu object".split())
ROOTS = frozenset(("article", "main"))
# words of class, id and role attributes that mark parts which are not the article
NOT_TEXT = frozenset(
    "nav navbar navigation menu sidebar aside complementary footer foot contentinfo ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "dialog overlay newsletter subscribe subscription signup login social share sharing related recommended breadcrumb "
    "breadcrumbs pagination pager comment comments disqus respond replies reply search widget toolbar copyright hidden "
    "masthead".split()
)

# words that an id may hold beside them; any other word makes it the name of a subject ("related-work")
GENERIC = frozenset(
    "site page main left right top bottom box section area block wrap wrapper container list form bar content post global "
    "primary secondary inner outer".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|template|iframe|svg|math|select|button)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[A-Za-z/!?][^>]*+(?:>|\Z)|[^<]++|<""",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
_NO_DISPLAY = re.compile(r"display\s*+:\s*+none", re.I)
_WORD_PARTS = re.compile(r"[a-z0-9]+")

TEXT, TAG, OTHER = 0, 1, 2


class Page:
    """Tokens of one page: ``kind``, tag ``name``, ``closing``, ``value`` and whether the token is masked."""

    def __init__(self, source: str):
        self.kind: list[int] = []
        self.name: list[str] = []
        self.closing: list[bool] = []
        self.value: list[str] = []
        self.marked: list[bool] = []
        kind, name, closing, value, marked = (
            self.kind.append, self.name.append, self.closing.append, self.value.append, self.marked.append
        )
        for m in _TOKEN.finditer(source):
            raw, slash, tag, rest = m.groups()
            is_close = slash == "/"
            if tag is not None:
                kind(TAG)
                name(tag.lower())
                value("")
                marked(bool(rest) and not is_close and self._is_marked(rest))
            else:
                whole = m.group()
                is_text = whole[0] != "<" or len(whole) == 1
                kind(TEXT if is_text else OTHER)
                name(raw.lower() if raw else "")
                value(whole if is_text else "")
                marked(False)
            closing(is_close)
        self.masked = self._mask()

    @staticmethod
    def _is_marked(attributes: str) -> bool:
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m.group(1).lower(), m.group(m.lastindex) if m.lastindex > 1 else ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            if name == "style" and _NO_DISPLAY.search(value):
                return True
            if name in ("class", "id", "role"):
                parts = _WORD_PARTS.findall(value.lower())
                if any(part in NOT_TEXT for part in parts) and (
                    name != "id" or all(part in NOT_TEXT or part in GENERIC or part.isdigit() for part in parts)
                ):
                    return True
        return False

    def _protect(self, ends: dict[int, int]) -> None:
        """An element is not marked if it is or holds the article or main with the most words, or holds most of the page's words."""
        marked = [i for i, m in enumerate(self.marked) if m and i in ends]
        if not marked:
            return
        until = [0]
        for kind, value in zip(self.kind, self.value):
            until.append(until[-1] + (len(value.split()) if kind == TEXT else 0))
        words = lambda i: until[ends[i]] - until[i]
        roots = [i for i in ends if self.name[i] in ROOTS]
        root = max(roots, key=lambda i: (words(i), -i), default=None)
        for i in marked:
            if root is not None and i <= root <= ends[i] or 2 * words(i) > until[-1]:
                self.marked[i] = False

    def _ends(self) -> dict[int, int]:
        """Index of the closing tag of each opening tag that has one."""
        ends, open_at = {}, {}
        for i, kind in enumerate(self.kind):
            if kind != TAG or self.name[i] in VOID:
                continue
            if not self.closing[i]:
                open_at.setdefault(self.name[i], []).append(i)
            elif open_at.get(self.name[i]):
                ends[open_at[self.name[i]].pop()] = i
        return ends

    def _mask(self) -> list[bool]:
        ends, size = self._ends(), len(self.kind)
        self._protect(ends)
        masked, until, inside = [False] * size, -1, 0
        for i in range(size):
            if i <= until:
                masked[i] = True
                continue
            if self.kind[i] != TAG:
                continue
            name = self.name[i]
            if name in ROOTS and not self.marked[i]:
                inside += -1 if self.closing[i] else 1
            if self.closing[i] or name in ("html", "body"):
                continue
            if self.marked[i] or name in NEVER or (name == "header" and inside <= 0):
                if name in VOID:
                    masked[i] = True
                else:
                    until = ends.get(i, self._lost_end(i))
                    masked[i] = True
        return masked

    def _lost_end(self, start: int) -> int:
        """An element that is never closed ends before the next article, main or first heading, or here."""
        for j in range(start + 1, len(self.kind)):
            if self.kind[j] == TAG and not self.closing[j] and (self.name[j] in ROOTS or self.name[j] == "h1"):
                return j - 1
        return len(self.kind) - 1 if self.name[start] == "footer" else start

    def features(self) -> list[tuple[str, int]]:
        """Name and count per token. Of a masked element only its first tag counts, whatever its size, so that a
        long sidebar inside an article does not cut the article in two."""
        out = []
        for i, kind in enumerate(self.kind):
            if self.masked[i]:
                first = not i or not self.masked[i - 1] or kind == TAG and self.marked[i]
                out.append(("!" + self.name[i], int(first)))
            elif kind == TEXT:
                out.append(("word", len(self.value[i].split())))
            elif kind == TAG:
                out.append((("/" if self.closing[i] else "") + self.name[i], 1))
            else:
                out.append(("other", 1))
        return out

    def region_text(self, first: int, last: int) -> str:
        blocks, parts = [], []

        def flush() -> None:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                blocks.append(text)
            parts.clear()

        for i in range(first, last + 1):
            kind, name = self.kind[i], self.name[i]
            if kind == TEXT:
                if not self.masked[i]:
                    parts.append(self.value[i])
            elif kind == TAG and name in BLOCKS:
                flush()
            elif kind == TAG and name in SPACES:
                parts.append(" ")
        flush()
        return "\n".join(blocks)


def starting_weights() -> dict[str, float]:
    """Used where there are no labelled pages, and for tokens that they do not hold."""
    weights = {"word": 1.0, "other": -0.05}
    weights.update({f"{slash}{name}": -4.0 for name in ("article", "main", "body", "html") for slash in ("", "/")})
    return weights


def counted_weights(samples: list[tuple[list[tuple[str, int]], tuple[int, int]]]) -> dict[str, float]:
    """Starting weights, with those of the tags in the sample set by how much oftener they stand outside."""
    counts: dict[str, list[int]] = {}
    for features, (first, last) in samples:
        for i, (name, _) in enumerate(features):
            counts.setdefault(name, [0, 0])[first <= i <= last] += 1
    weights = starting_weights()
    for name, (outside, inside) in counts.items():
        if name != "word":
            worst = _WORST_MASKED if name[0] == "!" or name == "other" else _WORST
            weights[name] = -0.02 - min(worst, max(0.0, math.log((outside + 1) / (inside + 1))))
    return weights


_DEFAULT_TAG, _DEFAULT_MASKED_TAG = -0.05, -0.2
# the least weight of a tag, and of an element whose text is left out anyway
_WORST, _WORST_MASKED = 4.0, 0.5


def weight(weights: dict[str, float], feature: str) -> float:
    found = weights.get(feature)
    if found is not None:
        return found
    return _DEFAULT_MASKED_TAG if feature.startswith("!") else _DEFAULT_TAG


def best_region(features: list[tuple[str, int]], weights: dict[str, float]) -> tuple[int, int] | None:
    """First and last token of the contiguous run with the highest positive sum (the earliest, and of equal
    sums the longest); none if no run is positive."""
    best, found, total, start = 0.0, None, 0.0, 0
    known = dict(weights)
    for i, (name, count) in enumerate(features):
        if total < 0:
            total, start = 0.0, i
        each = known.get(name)
        if each is None:
            each = known[name] = weight(weights, name)
        total += count * each
        if total > best or (found is not None and total == best and start == found[0]):
            best, found = total, (start, i)
    return found


def labelled_region(page: Page) -> tuple[int, int] | None:
    opens = [
        i for i, k in enumerate(page.kind) if k == TAG and page.name[i] in ROOTS and not page.closing[i] and not page.masked[i]
    ]
    if len(opens) != 1:
        return None
    end = page._ends().get(opens[0])
    if end is None or end - opens[0] < 2:
        return None
    return opens[0] + 1, end - 1


def fit_weights(pages: list[str], epochs: int = EPOCHS) -> dict[str, float]:
    """Structured perceptron: words stay positive, everything else negative."""
    samples = []
    for source in pages:
        page = Page(source)
        label = labelled_region(page)
        if label:
            samples.append((page.features(), label))
    weights = counted_weights(samples)
    for _ in range(epochs):
        wrong = 0
        for features, label in samples:
            region = best_region(features, weights) or (0, -1)
            steps = ((_beyond(region, label), -1.0), (_beyond(label, region), 1.0))
            if not any(features[i][0] == "word" and features[i][1] for span, _ in steps for i in span):
                continue
            wrong += 1
            for span, step in steps:
                for i in span:
                    name, count = features[i]
                    if not count:
                        continue
                    new = weight(weights, name) + step * (0.01 if name == "word" else 0.25)
                    weights[name] = max(new, 0.5) if name == "word" else min(new, -0.01)
        if not wrong:
            break
    return weights


def _beyond(span: tuple[int, int], other: tuple[int, int]) -> list[int]:
    """Tokens of a span that the other one does not hold."""
    return [i for i in range(span[0], span[1] + 1) if not other[0] <= i <= other[1]]


def extract(source: str | None, weights: dict[str, float]) -> str:
    if not source:
        return ""
    page = Page(source)
    region = best_region(page.features(), weights)
    return page.region_text(*region) if region else ""


def labelled_sample(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> list[str]:
    lower = F.lower("html")
    labelled = pages.where((F.length("html") <= sample_chars) & (lower.contains("<article") | lower.contains("<main")))
    order = F.xxhash64("html")
    # hashes first, so that no more than the chosen pages travel to the driver
    chosen = labelled.select(order.alias("order")).distinct().orderBy("order").limit(sample_pages)
    last = chosen.agg(F.max("order").alias("last")).first()["last"]
    if last is None:
        return []
    return [r["html"] for r in labelled.where(order <= last).select("html").distinct().orderBy("html").collect()]


def extract_pages(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``."""
    if weights is None:
        weights = fit_weights(labelled_sample(pages))
    rows = pages.select("page_id", "url", "html")
    id_type = rows.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py(), weights) for h in batch.column("html")]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    return rows.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
