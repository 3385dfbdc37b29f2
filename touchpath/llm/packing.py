"""Order-preserving packing of documents into token windows by dynamic programming.

The documents of an input split, in their order, form one token stream. It is cut into
windows of at most 4096 tokens at the cheapest places: a cut between documents costs
nothing, one between sentences a little, one inside a sentence (only offered in long
stretches without a boundary, and near the end of the split) more; a window is charged
for its padding, which is none at a power of two. With cut positions ``p`` and best costs
``f`` the full-window transition is

    f(j) = W - p(j) + min { f(i) + p(i) : p(j) - p(i) <= W },

a sliding minimum that a monotone queue yields in constant time per position; the windows
of a power of two are looked up besides.

A split is worked through in stretches of some 64 windows; the last windows of a stretch
stay open and are decided again with what follows, so memory is bounded by a stretch and
the longest document. Nothing is shuffled. A rerun of a task gives the same rows: sequence
ids are the split number and a count.

NULL and empty texts have only the end token. NULL ids stay NULL. Equal rows are separate
documents. No token is dropped.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"
WINDOW, END_ID = 4096, 2
SENTENCE_COST, INSIDE_COST, SEQUENCE_COST = 8, 64, 16
STRETCH, OPEN_WINDOWS, LONG_GAP = 64 * WINDOW, 3, 1024
MEMO = 400_000
SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])


def tokenizer_path(name: str) -> str:
    """A path stays; a bare name is looked up where the public tokenizers are installed."""
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of a text, each distinct word encoded once by the library and remembered.

    The tokenizer drops white space and never merges across it, so a text's ids are those
    of its words. Texts with special strings, or with separators that Python takes for
    white space and the library does not, are encoded whole.

    A new word of printable ASCII and Latin-1 letters is lower-cased and split into the
    pre-tokens of the tokenizer's pattern; each distinct one goes through the library's
    merges once, in the byte alphabet. Other words go through the whole library.
    """

    _ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
    _LATIN = "".join(chr(i) for i in range(0xC0, 0x100) if i not in (0xD7, 0xF7))
    _PLAIN = re.compile(f"[!-~{_LATIN}]+")
    _PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z{_LATIN}0-9]+")

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.splits = self._splits_like_the_pattern()
        self.bytes_of = {ord(c): self._byte_letters(c) for c in self._LATIN}
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(max(size, END_ID + 1), bool)
        for token, i in self.library.get_vocab().items():
            mark = token.removesuffix("</w>")
            self.ends[i] = bool(mark) and set(mark) <= set(".!?\"')") and bool(set(mark) & set(".!?"))

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word, all words in one call of the library."""
        found = self.library.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, "<u4").tobytes()
        ends = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words)), side="right").tolist()
        return [ids[4 * a:4 * b] for a, b in zip([0, *ends], ends)]

    def _splits_like_the_pattern(self) -> bool:
        """Whether the tokenizer lower-cases and splits as ``_PIECES`` does; if not, all words go through the library."""
        probe = "Don't we'LL x12y é.Ünd--ÿ#s' 'sa"
        pieces = [q for w in probe.split() for q in self._PIECES.findall(w.lower())]
        found = self.library.normalizer and self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(probe))
        return bool(found) and [piece for piece, _ in found] == ["".join(map(self._byte_letters, q)) for q in pieces]

    @staticmethod
    def _byte_letters(char: str) -> str:
        """The byte alphabet's letters for a character: printable bytes stand for themselves, others follow U+00FF."""
        other = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF)]
        return "".join(chr(0x100 + other.index(b)) if b in other else chr(b) for b in char.encode())

    def _piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            if len(self.pieces) > MEMO:
                self.pieces.clear()
            letters = piece if piece.isascii() else piece.translate(self.bytes_of)
            known = self.pieces[piece] = np.array([t.id for t in self.library.model.tokenize(letters)], "<u4").tobytes()
        return known

    def __call__(self, text: str) -> np.ndarray:
        if any(mark in text for mark in self._ODD):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        words = text.split()
        try:
            packed = b"".join(map(self.memo.__getitem__, words))
        except KeyError:
            self._learn(set(words))
            memo = self.memo
            packed = b"".join([memo[w] for w in words])
        return np.frombuffer(packed, "<u4")

    def _learn(self, words: set[str]) -> None:
        """Put ``words`` into the memo; a full memo becomes the older one, which gives back what is used again."""
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo, older = self.memo, self.older
        new = []
        plain, pieces, piece = self._PLAIN.fullmatch if self.splits else lambda _: None, self._PIECES.findall, self._piece
        for w in words:
            if w not in memo:
                if (known := older.get(w)) is not None:
                    memo[w] = known
                elif plain(w):
                    memo[w] = b"".join(map(piece, pieces(w.lower())))
                else:
                    new.append(w)
        if new:
            memo.update(zip(new, self._ids(new)))


@lru_cache(maxsize=2)
def encoder_for(name: str) -> WordEncoder:
    """One encoder per worker process: later tasks find the words known."""
    return WordEncoder(name)


def cut_places(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may end, ascending from 0 to len(ids), and their costs."""
    n = len(ids)
    cost = np.full(n + 1, -1, np.int64)
    cost[1:][ends[ids]] = SENTENCE_COST
    cost[doc_ends] = 0
    cost[0] = cost[n] = 0
    if last:
        tail = cost[max(0, n - WINDOW):]
        tail[tail < 0] = INSIDE_COST
    places = np.flatnonzero(cost >= 0)
    gaps = np.flatnonzero(np.diff(places) > LONG_GAP)
    if len(gaps):
        for g in gaps:
            inner = np.arange(places[g] + LONG_GAP, places[g + 1], LONG_GAP)
            cost[inner] = INSIDE_COST
        places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int = WINDOW) -> list[int]:
    """Cut positions (without 0) of the cheapest division into windows."""
    m = len(places)
    exact: list[list[int]] = [[] for _ in range(m)]
    for k in range(window.bit_length()):
        at = np.searchsorted(places, places - (1 << k))
        for j in np.flatnonzero((places >= 1 << k) & (places[np.minimum(at, m - 1)] == places - (1 << k))).tolist():
            exact[j].append(int(at[j]))
    place, cost = places.tolist(), costs.tolist()
    best, origin = [0] * m, [0] * m
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (f(i) + p(i), i), ascending
    for j in range(1, m):
        p = place[j]
        while place[queue[0][1]] < p - window:
            queue.popleft()
        value, i = queue[0]
        value += window - p
        for x in exact[j]:
            if best[x] < value:
                value, i = best[x], x
        best[j] = f = value + cost[j] + SEQUENCE_COST
        origin[j] = i
        key = f + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], m - 1
    while j > 0:
        cuts.append(place[j])
        j = origin[j]
    return cuts[::-1]


class Packer:
    """Takes documents in order, gives pieces; see the module for the method."""

    def __init__(self, ends: np.ndarray, first_sequence: int) -> None:
        self.ends, self.sequence = ends, first_sequence
        self.docs: deque[list] = deque()  # [doc_id, ids, tokens already packed]
        self.waiting = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append([doc_id, ids, 0])
        self.waiting += len(ids)
        if self.waiting >= STRETCH:
            self._cut(last=False)

    def finish(self) -> None:
        if self.waiting:
            self._cut(last=True)

    def _cut(self, last: bool) -> None:
        stream = np.concatenate([ids[done:] for _, ids, done in self.docs])
        doc_ends = np.cumsum([len(ids) - done for _, ids, done in self.docs])
        cuts = best_cuts(*cut_places(stream, doc_ends, self.ends, last))
        if not last:
            cuts = cuts[: max(1, len(cuts) - OPEN_WINDOWS)]
        start = 0
        for cut in cuts:
            self._emit(cut - start)
            start = cut

    def _emit(self, size: int) -> None:
        offset = 0
        self.waiting -= size
        while offset < size:
            doc = self.docs[0]
            doc_id, ids, done = doc
            n = min(len(ids) - done, size - offset)
            crc = zlib.crc32(ids[done:done + n].tobytes())
            self.rows.append((doc_id, done, n, crc, len(ids), self.sequence, offset))
            offset += n
            if done + n == len(ids):
                self.docs.popleft()
            else:
                doc[2] = done + n
        self.sequence += 1

    def take(self) -> pa.RecordBatch | None:
        rows, self.rows = self.rows, []
        if not rows:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], schema=SCHEMA)


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = packer = None
        end = np.array([END_ID], "<u4")
        for batch in batches:
            if packer is None:
                encoder = encoder_for(tokenizer)
                packer = Packer(encoder.ends, TaskContext.get().partitionId() << 40)
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(key, np.concatenate((encoder(value.as_py() or ""), end)))
            if (out := packer.take()) is not None:
                yield out
        if packer is not None:
            packer.finish()
            if (out := packer.take()) is not None:
                yield out

    names = ", ".join(f"{f.name} long" for f in SCHEMA)
    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, names)
