"""SentencePiece encoding and decoding by streaming Viterbi.

The segmentation with the highest sum of the model's piece scores is found in one pass from left to right (of
equal sums, the one whose last piece is longer). Only positions within one maximum piece length can still start
a piece. Their backpointer paths are followed until they meet; everything before that boundary is final and its ids
are committed, so a text of any length needs memory for the undecided part only.

Where no piece can cross a position, all paths meet there at once: before a run of spaces, and around characters
that occur in no piece. Texts are cut there first and the ids of recent words are kept in a bounded table.

A space is the mark U+2581 and a text begins with one such mark, as the model expects. Characters outside the
vocabulary become byte pieces; so does a literal U+2581 in the text, which makes decoding exact for every text.

The model file names pieces and scores; the path is a parameter, read on the driver and sent to the tasks as a table.
The scores of a file made by pair merging are minus the merge rank: the ids are then the best-scoring segmentation
with that vocabulary, which is not always the one that merging would reach.

Defined results: a null text has null ids, 0 ids and no digest; an empty text has no ids; repeated rows each get their row;
an empty table gives no rows; other columns are ignored. Decoding gives U+FFFD for ids that the vocabulary lacks and for bytes that
are no whole character.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 400_000
LOST = "\ufffd".encode()


@dataclass
class Vocabulary:
    scores: dict[str, tuple[int, float]]
    byte_ids: list[int]
    unknown_id: int
    surface: list[bytes]
    longest: int = 0
    unknown_score: float = 0.0
    cuts_at_mark: bool = True
    cuts_at_newline: bool = True
    single: frozenset[str] = field(default_factory=frozenset)
    root: list = field(default_factory=list)

    def __post_init__(self):
        self.longest = max(map(len, self.scores))
        self.unknown_score = min(s for _, s in self.scores.values()) - UNKNOWN_PENALTY
        self.cuts_at_mark = not any(MARK in p.lstrip(MARK) for p in self.scores)
        self.cuts_at_newline = not any("\n" in p for p in self.scores)
        self.single = frozenset(p for p in self.scores if len(p) == 1)
        # a tree of the pieces by character: a node is [following nodes, score of the piece that ends here]
        self.root = [{}, None]
        for piece, (_, score) in self.scores.items():
            node = self.root
            for c in piece:
                node = node[0].setdefault(c, [{}, None])
            node[1] = score


def load_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    scores, byte_ids, surface = {}, [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            surface.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            surface.append(b"")
        else:
            scores[piece] = (i, model.get_score(i))
            surface.append(piece.replace(MARK, " ").encode())
    return Vocabulary(scores, byte_ids, model.unk_id(), surface)


class Encoder:
    def __init__(self, vocabulary: Vocabulary, cached_words: int = CACHED_WORDS):
        self.v = vocabulary
        self.cached_words = cached_words
        self.cache: dict[str, bytes] = {}
        self.most_pending = 0

    def _fallback(self, text: str) -> list[int]:
        ids = [self.v.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")]
        return ids if min(ids) >= 0 else [self.v.unknown_id]

    def viterbi(self, s: str) -> list[int]:
        """Ids of a marked text. ``best`` and ``back`` cover the undecided part, which begins at ``base``."""
        v, single, size = self.v, self.v.single, len(s)
        lowest = -float("inf")
        ids: list[int] = []
        base, best, back = 0, [0.0], [0]
        check = 4 * v.longest
        for start in range(size):
            here = best[start - base]
            if len(best) == start - base + 1:
                best.append(lowest)
                back.append(start)
            if s[start] not in single and here + v.unknown_score > best[start - base + 1]:
                best[start - base + 1], back[start - base + 1] = here + v.unknown_score, start
            node = v.root
            for end in range(start, min(size, start + v.longest)):
                node = node[0].get(s[end])
                if node is None:
                    break
                at = end + 1 - base
                if at == len(best):
                    best.append(lowest)
                    back.append(start)
                if node[1] is not None and here + node[1] > best[at]:
                    best[at], back[at] = here + node[1], start
            if start + 1 - base >= check:
                self.most_pending = max(self.most_pending, start + 1 - base)
                meet = self._meeting(best, back, base, start + 1)
                if meet > base:
                    ids += self._ids(s, back, base, meet)
                    best, back, base = best[meet - base :], back[meet - base :], meet
                check = max(4 * v.longest, 2 * (start + 1 - base))
        return ids + self._ids(s, back, base, size)

    def short(self, s: str) -> list[int]:
        """The same for a word that fits one window: nothing to commit before its end."""
        root, single, unknown = self.v.root, self.v.single, self.v.unknown_score
        size = len(s)
        best = [0.0] + [-float("inf")] * size
        back = [0] * (size + 1)
        for start in range(size):
            here = best[start]
            if s[start] not in single and here + unknown > best[start + 1]:
                best[start + 1] = here + unknown
                back[start + 1] = start
            end, node = start, root
            for c in s[start:]:
                node = node[0].get(c)
                if node is None:
                    break
                end += 1
                score = node[1]
                if score is not None and here + score > best[end]:
                    best[end] = here + score
                    back[end] = start
        return self._ids(s, back, 0, size)

    @staticmethod
    def _meeting(best: list[float], back: list[int], base: int, done: int) -> int:
        """The last boundary that the best paths to all open positions share: those from ``done`` on which a piece
        has reached. No later piece starts before ``done``."""
        open_ends = {done, *(base + i for i in range(done - base, len(best)) if best[i] != -float("inf"))}
        while len(open_ends) > 1:
            last = max(open_ends)
            open_ends.remove(last)
            open_ends.add(back[last - base])
        return open_ends.pop()

    def _ids(self, s: str, back: list[int], base: int, end: int) -> list[int]:
        scores, ids = self.v.scores, []
        while end > base:
            start = back[end - base]
            hit = scores.get(s[start:end])
            if hit is not None:
                ids.append(hit[0])
            else:
                ids += self._fallback(s[start:end])[::-1]
            end = start
        ids.reverse()
        return ids

    def _word(self, marked: str) -> bytes:
        found = self.cache.get(marked)
        if found is None:
            small = len(marked) <= 4 * self.v.longest
            found = array("i", self.short(marked) if small else self.viterbi(marked)).tobytes()
            if small:
                if len(self.cache) >= self.cached_words:
                    self.cache.clear()
                self.cache[marked] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        parts = text.split(MARK)
        literal = np.array(self._fallback(MARK), np.int32).tobytes()
        out = [self._plain(MARK + parts[0].replace(" ", MARK))]
        for part in parts[1:]:
            out.append(literal)
            out.append(self._plain(part.replace(" ", MARK)))
        return np.frombuffer(b"".join(out), np.int32)

    def _plain(self, s: str) -> bytes:
        """Ids of a marked text without literal marks: line by line and word by word where no piece crosses."""
        v, word = self.v, self._word
        if not s:
            return b""
        if not v.cuts_at_mark:
            return word(s)
        if not v.cuts_at_newline:
            return b"".join(self._words(s))
        newline = word("\n")
        out = []
        for n, line in enumerate(s.split("\n")):
            if n:
                out.append(newline)
            if line:
                out += self._words(line)
        return b"".join(out)

    def _words(self, line: str) -> list[bytes]:
        """A word is a run of marks and what follows up to the next run."""
        word, pieces = self._word, line.split(MARK)
        get = self.cache.get
        out = [word(pieces[0])] if pieces[0] else []
        marks = 0
        for piece in pieces[1:]:
            marks += 1
            if piece:
                marked = MARK * marks + piece
                out.append(get(marked) or word(marked))
                marks = 0
        if marks:
            out.append(word(MARK * marks))
        return out


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of the ids. An id that is null or not in the vocabulary, and bytes that are no whole character, become U+FFFD."""
    surface = vocabulary.surface
    try:
        if min(ids, default=0) < 0:
            raise IndexError
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "surrogatepass")
    except (IndexError, TypeError, UnicodeDecodeError):
        known = [surface[i] if i is not None and 0 <= i < len(surface) else LOST for i in ids]
        text = b"".join(known).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``keep`` columns and ``text`` of ``encoded(doc_id, ids)``; null ids give a null text, no ids an empty one."""
    rows = encoded.select("doc_id", "ids", *keep)
    fixed = ["doc_id", *keep]
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                texts = [None if ids is None else decode(ids, sent.value) for ids in batch.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in fixed], pa.array(texts, pa.string())], names=[*fixed, "text"])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in fixed]
    return rows.mapInArrow(run, ", ".join([*kinds, "text string"]))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the ``keep`` columns, ``ids``, ``n_ids``, ``decoded_sha256`` (of the text decoded from the ids) and
    ``identical`` (whether it is the source text)."""
    rows = docs.select("doc_id", "text", *keep)
    fixed = ["doc_id", *keep]
    # one copy per Python worker, and with it one table of recent words for all tasks that the worker runs
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in fixed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        encoder = vocabulary.encoder = getattr(vocabulary, "encoder", None) or Encoder(vocabulary)
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                found, digests, same = [], [], []
                for text in batch.column("text").to_pylist():
                    if text is None:
                        found.append(None)
                        digests.append(None)
                        same.append(None)
                        continue
                    ids = encoder.encode(text)
                    decoded = decode(ids.tolist(), vocabulary)
                    found.append(ids)
                    digests.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                    same.append(decoded == text)
                sizes = np.array([0 if f is None else len(f) for f in found], np.int64)
                flat = np.concatenate([f for f in found if f is not None] or [np.empty(0, np.int32)])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                nulls = pa.array([f is None for f in found], pa.bool_())
                ids_column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=nulls)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in fixed]
                    + [ids_column, pa.array(sizes), pa.array(digests, pa.string()), pa.array(same, pa.bool_())],
                    names=[*fixed, "ids", "n_ids", "decoded_sha256", "identical"],
                )

    return rows.mapInArrow(run, ", ".join([*kinds, "ids array<int>, n_ids long, decoded_sha256 string, identical boolean"]))
