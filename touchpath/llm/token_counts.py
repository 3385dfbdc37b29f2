"""Token counts from piece counts of distinct pre-tokens; no token id is ever made.

1. A scan cuts texts into pre-tokens and counts them per task; the sums give the distinct
   pre-tokens of the corpus, and the tokenizer's model counts the pieces of each once.
2. A second scan makes every document's pre-token frequencies and joins them with the
   piece counts. Pre-tokens with at least ``SHARE`` of all occurrences, at most
   1 / ``SHARE`` of them whatever the corpus, are broadcast and joined inside the task;
   all others are joined by a shuffle, in which no key can be hot, as none has more than
   ``SHARE`` of the occurrences. Sums per document follow.

Texts are first cut where the kinds of two neighbouring bytes tell that a pre-token begins
(`units`: Arrow columns over the texts' own bytes); nearly all units are pre-tokens then.
Distinct units with an apostrophe or with characters beyond U+023F are split further by the
library, each once. Special strings of the tokenizer count one token each.

NULL and empty texts have no tokens. Rows with equal ids are counted one by one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import written
from touchpath.llm.packing import tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
SHARE = 5e-7
MEMO, PIECE = 400_000, 1 << 23
# kinds of bytes; FAR are those of which the library alone decides, with QUOTE it may
LETTER, DIGIT, OTHER, BLANK, SPACE, QUOTE, FAR = range(7)
NO, CUT, AFTER_SPACE, AFTER_FAR, AFTER_LINE = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, FAR, np.uint8)
    kinds[:128] = OTHER
    for kind, members in ((DIGIT, b"0123456789"), (BLANK, b" "), (SPACE, b"\t\n\x0b\x0c\r"), (QUOTE, b"'"),
                          (FAR, b"\x1c\x1d\x1e\x1f")):
        kinds[list(members)] = kind
    for a, z in (("A", "Z"), ("a", "z")):
        kinds[ord(a):ord(z) + 1] = LETTER
    kinds[0xC3:0xC9] = LETTER  # first byte of U+00C0 to U+023F
    return kinds


def _pairs() -> np.ndarray:
    """Whether a pre-token begins between two kinds of bytes, or what is to be asked."""
    pairs = np.full((7, 7), NO, np.uint8)
    plain, blanks = [LETTER, DIGIT, OTHER, QUOTE], [BLANK, SPACE]
    for a in plain:
        pairs[a, [b for b in (*plain, *blanks) if b != a]] = CUT
    pairs[OTHER, QUOTE] = pairs[QUOTE, OTHER] = pairs[QUOTE, LETTER] = NO
    pairs[SPACE, plain] = AFTER_LINE
    pairs[np.ix_(blanks, blanks)] = AFTER_SPACE
    pairs[FAR, blanks] = AFTER_FAR
    return pairs.ravel()


KINDS, PAIRS = _kinds(), _pairs()


def byte_kinds(data: np.ndarray) -> np.ndarray:
    kinds = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC8))
    kinds[lead + 1] = LETTER
    signs = lead[(data[lead] == 0xC3) & ((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7))]  # times, divided by
    kinds[signs] = kinds[signs + 1] = FAR
    return kinds


def begins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The places where a unit begins: all starts of texts, and others where a pre-token surely does."""
    if not len(data):
        return np.zeros(0, np.int64)
    text = np.zeros(len(data) + 1, bool)
    text[starts] = True
    kinds = byte_kinds(data)
    pairs = PAIRS[kinds[:-1] * np.uint8(7) + kinds[1:]]
    cut = text[:-1].copy()
    cut[1:] |= pairs == CUT
    # of several spaces, the last one goes apart if something follows in the text
    at = np.flatnonzero(pairs == AFTER_SPACE) + 1
    at = at[~text[at + 1]]
    at = at[at + 1 < len(data)]
    then = kinds[at + 1]
    cut[at[(then <= OTHER) | (then == QUOTE)]] = True
    # a character that may be a space itself is left to the library
    at = np.flatnonzero(pairs == AFTER_FAR) + 1
    a, b, c = data[at - 3], data[at - 2], data[at - 1]
    space = (c < 0x80) | (b == 0xC2) | (a == 0xE1) & ((b == 0x9A) | (b == 0xA0)) | (a == 0xE3) & (b == 0x80) & (c == 0x80) | (
        a == 0xE2) & ((b == 0x81) & (c >= 0x9F) | (b == 0x80) & ((c <= 0x8F) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
    cut[at[~space]] = True
    # only a blank belongs to what follows it; another space stands alone if what is before it does not join it
    at = np.flatnonzero(pairs == AFTER_LINE) + 1
    cut[at[cut[at - 1]]] = True
    return np.flatnonzero(cut)


def in_pieces(texts: pa.StringArray, size: int) -> Iterator[pa.StringArray]:
    """A column, without NULLs, in slices of about ``size`` bytes."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield texts[at:stop]
        at = stop


class PreTokenizer:
    """Pre-tokens of texts as the library makes them."""

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(tokenizer_path(name))
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, self.specials)))
        self.memo: dict[str, tuple[str, ...]] = {}

    def pieces(self, pre_token: str) -> int:
        return len(self.library.encode(pre_token, add_special_tokens=False).ids)

    def parts(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """Texts without their special strings, in parts, and how many parts each has."""
        several = np.ones(len(texts), np.int64)
        if not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.specials):
            return texts, several
        split = [self.special.split(t) for t in texts.to_pylist()]
        several[:] = [len(s) for s in split]
        return pa.array([p for s in split for p in s], pa.string()), several

    def units(self, texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct units, which of them follow one another, the first of each text, each text's special strings."""
        parts, several = self.parts(texts)
        _, offsets, body = parts.buffers()
        offsets = np.frombuffer(offsets, np.int32)[parts.offset:parts.offset + len(parts) + 1]
        data = np.frombuffer(body or b"", np.uint8)[offsets[0]:offsets[-1]]
        starts = begins(data, offsets[:-1] - offsets[0])
        first = np.searchsorted(starts, offsets - offsets[0])[np.concatenate(([0], np.cumsum(several)))]
        edges = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        found = pa.StringArray.from_buffers(len(starts), edges, pa.py_buffer(data)).dictionary_encode()
        return found.dictionary, found.indices.to_numpy(), first, several - 1

    def split(self, unit: str) -> tuple[str, ...]:
        known = self.memo.get(unit)
        if known is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            known = self.memo[unit] = tuple(
                unit[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(unit))
        return known

    def tokens(self, units: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """Distinct pre-tokens of distinct units, which of them each unit has in turn, how many it has."""
        _, offsets, body = units.buffers()
        offsets = np.frombuffer(offsets, np.int32)[units.offset:units.offset + len(units) + 1]
        asked = np.concatenate(([0], np.cumsum(byte_kinds(np.frombuffer(body or b"", np.uint8)) >= QUOTE)))
        odd = asked[offsets[1:]] > asked[offsets[:-1]]
        split = [self.split(u) for u in units.filter(pa.array(odd)).to_pylist()]
        several = np.ones(len(units), np.int64)
        several[odd] = [len(s) for s in split]
        found = pa.concat_arrays([units.filter(pa.array(~odd)), pa.array([t for s in split for t in s], pa.string())]).dictionary_encode()
        which, owned, plain = np.empty(several.sum(), np.int64), np.repeat(odd, several), int((~odd).sum())
        which[~owned], which[owned] = found.indices[:plain], found.indices[plain:]
        return found.dictionary, which, several


@lru_cache(maxsize=2)
def cutter_for(name: str) -> PreTokenizer:
    """One per worker process: later tasks find the units known."""
    return PreTokenizer(name)


def distinct_pre_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(token, n, pieces): every distinct pre-token, its occurrences and its pieces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = cutter_for(tokenizer)
        for batch in batches:
            for texts in in_pieces(batch.column(0), PIECE):
                units, order, _, _ = cutter.units(texts)
                tokens, which, several = cutter.tokens(units)
                times = np.repeat(np.bincount(order, minlength=len(units)), several)
                n = np.bincount(which, times, len(tokens)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([tokens, pa.array(n)], ["token", "n"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = cutter_for(tokenizer)
        for batch in batches:
            pieces = [cutter.pieces(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], ["token", "n", "pieces"])

    counted = docs.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(measure, "token string, n long, pieces long")


def _rare_counts(tokens: pa.StringArray, owner: np.ndarray, which: np.ndarray, n: int) -> pa.MapArray:
    """A map from token to its number for each of ``n`` owners."""
    keys, times = np.unique(owner * len(tokens) + which, return_counts=True)
    edges = np.searchsorted(keys, np.arange(n + 1) * len(tokens))
    return pa.MapArray.from_arrays(
        pa.array(edges, pa.int32()), tokens.take(pa.array(keys % max(1, len(tokens)))), pa.array(times, pa.int64()))


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT, share: float = SHARE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, one row per input row."""
    spark = docs.sparkSession
    table = written(distinct_pre_tokens(docs, tokenizer), "token-pieces")
    total = table.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= share * total
    common = spark.sparkContext.broadcast(table.where(often).select("token", "pieces").toArrow().combine_chunks())

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, shared = cutter_for(tokenizer), common.value
        known = shared["token"].combine_chunks()
        pieces = np.append(shared["pieces"].to_numpy(), 0)

        def counted(texts: pa.StringArray) -> tuple[np.ndarray, pa.MapArray]:
            units, order, first, specials = cutter.units(texts)
            tokens, which, several = cutter.tokens(units)
            at = pc.fill_null(pc.index_in(tokens, value_set=known), len(pieces) - 1).to_numpy()[which]
            rare = at == len(pieces) - 1
            owner = np.repeat(np.arange(len(units)), several)
            per_unit = np.bincount(owner, pieces[at], len(units)).astype(np.int64)
            sums = np.concatenate(([0], np.cumsum(per_unit[order])))
            # the rare pre-tokens of each unit in each place where it stands
            n_rare = np.bincount(owner[rare], minlength=len(units))
            begin = np.cumsum(n_rare) - n_rare
            row = np.repeat(np.arange(len(texts)), np.diff(first))
            some = np.flatnonzero(n_rare[order])
            unit, row = order[some], row[some]
            n = n_rare[unit]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[unit], n)
            return sums[first[1:]] - sums[first[:-1]] + specials, _rare_counts(tokens, np.repeat(row, n), which[rare][place], len(texts))

        for batch in batches:
            at = 0
            for texts in in_pieces(batch.column(1), PIECE):
                n, rest = counted(texts)
                part = batch.slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), part.column(3), pa.array(n, pa.int64()), rest,
                ], ["doc_id", "row", "n_bytes", "n", "rare"])

    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    ).mapInArrow(frequencies, "doc_id long, row long, n_bytes long, n long, rare map<string,long>"), "token-rows")
    rare = rows.select("row", F.explode("rare").alias("token", "times")).join(
        table.where(~often).select("token", "pieces"), "token")
    extra = rare.groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("extra"))
    n = (F.col("n") + F.coalesce("extra", F.lit(0))).alias("n_tokens")
    return rows.drop("rare").join(extra, "row", "left").select("doc_id", "n_bytes", n).withColumn(
        "over_limit", F.col("n_tokens") > limit)
