"""License scan: common pairs of words pick candidates, banded alignment measures them.

Texts and templates are sequences of lower-case words. Every pair of consecutive template words is in an inverted index
``hash -> (template, position)``: a local path that scores more than one matched word alone has two matches in a row, so every
match that the alignment would report shares a pair. Its size follows from the templates alone and is checked
(``MOST_TEMPLATE_WORDS``), so it travels with the tasks; documents are never shuffled. A template is aligned only where the
text around holds enough of its words in any order, which every match of the asked coverage does.

Hits of a template on nearby diagonals are one candidate. It is aligned with the words around it inside a band (match 1,
mismatch and gap -1, best local path); coverage is the matched share of the template's words. Of overlapping matches
of a document the one with the higher score less its unmatched template words stays (then the higher coverage, the
earlier start, the smaller template).

Defined results: a null or empty text, and one without a match, give no rows; repeated rows each give theirs; whole
texts are scanned, long ones piece by piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

K = 2
WINDOW = 1
COVERAGE = 0.8
MOST_TEMPLATE_WORDS = 1_000_000
_PIECE_CHARS = 1 << 20
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word numbers."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ ids[i : i + n].astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


def winnow(ids: np.ndarray, k: int, window: int) -> np.ndarray:
    """Positions whose hash is the (rightmost) smallest of some window; all hashes of a shorter sequence compete in one."""
    hashes = _hashes(ids, k)
    if len(hashes) <= 1:
        return np.arange(len(hashes))
    width = min(window, len(hashes))
    views = np.lib.stride_tricks.sliding_window_view(hashes, width)
    best = width - 1 - views[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(views)) + best)


def align(words: np.ndarray, template: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int, int] | None:
    """Best local path with ``|word position - template position - diagonal| <= band``:
    ``(score, matched words, first word, last word)``; of equal scores the one that ends first."""
    width = 2 * band + 1
    score = np.zeros((len(template) + 1, width + 2), np.int32)
    move = np.zeros((len(template) + 1, width + 2), np.int8)
    best, at = 0, None
    for i in range(1, len(template) + 1):
        for b in range(1, width + 1):
            j = i - 1 + diagonal + b - 1 - band  # word position
            if not 0 <= j < len(words):
                continue
            step = 1 if words[j] == template[i - 1] else -1
            options = (
                (score[i - 1, b] + step, 1),  # both advance: same diagonal
                (score[i - 1, b + 1] - 1, 2),  # template word without counterpart
                (score[i, b - 1] - 1, 3),  # text word without counterpart
            )
            value, kind = max(options, key=lambda o: (o[0], -o[1]))
            if value > 0:
                score[i, b], move[i, b] = value, kind
                if value > best:
                    best, at = value, (i, b)
    if at is None:
        return None
    i, b = at
    last, matched = i - 1 + diagonal + b - 1 - band, 0
    first = last
    while i > 0 and score[i, b] > 0:
        j = i - 1 + diagonal + b - 1 - band
        if move[i, b] == 1:
            matched += int(words[j] == template[i - 1])
            first, i = j, i - 1
        elif move[i, b] == 2:
            i, b = i - 1, b + 1
        else:
            first, b = j, b - 1
    return int(best), matched, first, last


class Index:
    def __init__(self, templates: list[tuple[str, str]], k: int = K, window: int = WINDOW):
        self.k, self.window = k, window
        self.names = [name for name, _ in templates]
        split = [[w.lower() for w in _WORD.findall(text)] for _, text in templates]
        if sum(map(len, split)) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
        # word numbers from 1; every other word is 0 and matches nothing
        self.words = {w: n for n, w in enumerate(sorted({w for ws in split for w in ws}), 1)}
        self.templates = [np.array([self.words[w] for w in ws], np.int32) for ws in split]
        self.bags = [np.unique(ids, return_counts=True) for ids in self.templates]
        entries = []
        for t, ids in enumerate(self.templates):
            hashes = _hashes(ids, k)
            entries += [(int(hashes[p]), t, int(p)) for p in winnow(ids, k, window)]
        entries.sort()
        self.hash = np.array([e[0] for e in entries], np.uint64)
        self.template = np.array([e[1] for e in entries], np.int64)
        self.position = np.array([e[2] for e in entries], np.int64)

    def number(self, text: str) -> np.ndarray:
        """Numbers of the words of the text as it stands; lower-casing comes after, as it can divide a word in two."""
        get, parts, start = self.words.get, [], 0
        while start < len(text):
            stop = min(start + _PIECE_CHARS, len(text))
            if stop < len(text):  # do not cut a word
                while stop > start + 1 and (text[stop - 1].isalnum() or text[stop - 1] == "_"):
                    stop -= 1
                stop = stop if stop > start + 1 else min(start + _PIECE_CHARS, len(text))
            parts.append(np.array([get(w.lower(), 0) for w in _WORD.findall(text[start:stop])], np.int32))
            start = stop
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index entries and positions of the fingerprints that the text shares with templates."""
        places = winnow(ids, self.k, self.window)
        # a run of words that no template holds cannot be a hit
        places = places[ids[places] > 0]
        own = _hashes(ids, self.k)[places] if len(places) else np.empty(0, np.uint64)
        low, high = np.searchsorted(self.hash, own, "left"), np.searchsorted(self.hash, own, "right")
        count = high - low
        rows = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return rows, np.repeat(places, count)

    def holds(self, counts: np.ndarray, t: int, coverage: float) -> bool:
        """Whether words with these counts can cover a template."""
        words, times = self.bags[t]
        return np.minimum(counts[words], times).sum() >= coverage * len(self.templates[t])

    def matches(self, text: str, coverage: float = COVERAGE) -> list[tuple[str, int, float, int, int, int]]:
        """``(license, template, coverage, matched words, start, end)`` with code point offsets."""
        ids = self.number(text)
        rows, places = self.hits(ids)
        if not len(rows):
            return []
        found = []
        counts = np.bincount(ids, minlength=len(self.words) + 1)
        able = np.zeros(len(self.templates), bool)
        for t in np.unique(self.template[rows]):
            able[t] = self.holds(counts, t, coverage)
        template, diagonal = self.template[rows], places - self.position[rows]
        order = np.flatnonzero(able[template])
        template, diagonal = template[order], diagonal[order]
        order = np.lexsort((diagonal, template))
        seen: dict[int, list[tuple[int, int]]] = {}
        for r in order:
            t, d = int(template[r]), int(diagonal[r])
            wording = self.templates[t]
            band = max(2, len(wording) // 5)
            low = max(0, d - band)
            around = ids[low : d + len(wording) + band + 1]
            if not self.holds(np.bincount(around, minlength=len(counts)), t, coverage):
                continue
            if any(abs(d - e) <= band // 2 for e, _ in seen.get(t, [])[-1:]):
                continue
            seen.setdefault(t, []).append((d, band))
            path = align(around, wording, d - low, band)
            if path and path[1] >= coverage * len(wording):
                score, matched, first, last = path
                net = score - (len(wording) - matched)
                found.append((net, matched / len(wording), low + first, low + last, t, matched))
        kept: list[tuple] = []
        for item in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[4])):
            if all(item[3] < k[2] or item[2] > k[3] for k in kept):
                kept.append(item)
        if not kept:
            return []
        wanted = {f[2] for f in kept} | {f[3] for f in kept}
        spans = {n: m.span() for n, m in enumerate(_WORD.finditer(text)) if n in wanted}
        return [
            (self.names[t], t, share, matched, spans[first][0], spans[last][1])
            for _, share, first, last, t, matched in sorted(kept, key=lambda f: f[2])
        ]


def scan(docs: DataFrame, templates: list[tuple[str, str]], coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, license, template, coverage, matched_words, start, end`` per match in ``docs(doc_id, text)``."""
    rows = docs.select("doc_id", "text")
    index = Index(templates)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, out = [], []
            for n, text in enumerate(batch.column("text")):
                source = text.as_py()
                if source:
                    for match in index.matches(source, coverage):
                        take.append(n)
                        out.append(match)
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(take, pa.int64())),
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.float64()),
                    pa.array(columns[3], pa.int32()),
                    pa.array(columns[4], pa.int64()),
                    pa.array(columns[5], pa.int64()),
                ],
                names=["doc_id", "license", "template", "coverage", "matched_words", "start", "end"],
            )

    return rows.mapInArrow(
        run, f"doc_id {kind}, license string, template int, coverage double, matched_words int, start long, end long"
    )
