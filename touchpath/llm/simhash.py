"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most two bits differ in
at most two bytes, so they share at least six bytes at their positions. The index lists
fingerprints under what they hold at byte positions. A list for a single byte would hold
one of 256 fingerprints, far too many to pair; the positions are therefore indexed
jointly: eight bytes are four blocks of two, two differing bytes leave two blocks
untouched, and each of the six block pairs (four positional bytes) has a list. Pairs from
one list are tallied (shared positional bytes of all eight), kept from six matches on,
and verified by their bits.

Only distinct fingerprints are indexed, so exact copies never meet. A list longer than
``max_list`` is not paired. Its fingerprints are linked exactly by common neighbours:
each stands under itself and its 64 one-bit changes, and two fingerprints are at most two
bits apart just if they share such an entry; an entry has at most 65 members.

NULL and empty texts have no words and fingerprint zero, which links as any other does.
A text with one or two words has one shingle. Rows with equal ids are separate members;
NULL ids stay in the result but never name a component unless all its ids are NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import components, rows_of, written

SPAN, SEED, MAX_BITS = 3, 42, 2
BLOCKS = (0, 16, 32, 48)
MAX_LIST = 64
_SLICE = 1 << 16


def shingles(text: str | None, span: int = SPAN) -> np.ndarray:
    """XXH64 of each run of ``span`` words, of the whole text if it has no more words than that."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, ">u8")
    joined = b" ".join(words)
    if len(words) <= span:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], ">u8")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - span + 1].tolist()
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[span - 1:].tolist())
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), ">u8", len(starts))


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of one text."""
    hashes = shingles(text)
    n = len(hashes)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, _SLICE):
        part = hashes[i:i + _SLICE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["id", "text_hash", "fp"]
        )


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    rows = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(_fingerprints, "id long, text_hash long, fp long")


def _lists(prints: DataFrame) -> DataFrame:
    """(pair of blocks, their four bytes, fingerprint)."""
    def bits(at: int) -> Column:
        return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit(0xFFFF))
    return prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("positions"), (bits(a) * 65536 + bits(b)).alias("held"))
        for k, (a, b) in enumerate(combinations(BLOCKS, 2))
    ])).alias("x")).select("fp", "x.*")


def _shared_bytes(x: Column) -> Column:
    """Bytes in which two fingerprints agree, given their xor."""
    return sum(
        (F.when(F.shiftrightunsigned(x, at).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0)
         for at in range(8, 64, 8)),
        F.when(x.bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0),
    )


def links(prints: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """(a, b): enough links between distinct fingerprints ``fp`` for their components."""
    lists = written(_lists(prints), "simhash-lists")
    sizes = lists.groupBy("positions", "held").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(lists.join(sizes, ["positions", "held"]), "simhash-shared")
    short = shared.where(F.col("n") <= max_list)
    other = short.select("positions", "held", F.col("fp").alias("fp_b"))
    x = F.col("fp").bitwiseXOR(F.col("fp_b"))
    pairs = (
        short.join(other, ["positions", "held"]).where("fp < fp_b")
        .where((_shared_bytes(x) >= 8 - MAX_BITS) & (F.bit_count(x) <= MAX_BITS))
        .select(F.col("fp").alias("a"), F.col("fp_b").alias("b"))
    )
    crowded = shared.where(F.col("n") > max_list).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)]
    near = crowded.select("fp", F.explode(F.array(*flips)).alias("middle"))
    first = near.groupBy("middle").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).where("first < last")
    stars = near.join(first, "middle").where("fp <> first").select(
        F.col("first").alias("a"), F.col("fp").alias("b"))
    return pairs.union(stars).distinct()


def grouped(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """id, text_hash, fp, ``component`` (smallest id reachable) and ``root``, one row per input row.

    ``root`` is the smallest fingerprint of the component: components may share an id, or
    have none, but never a root.
    """
    rows = written(with_fingerprints(docs), "simhash-rows")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    joined = components(links(distinct.select("fp"), max_list), "simhash-components")
    classes = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    names = classes.groupBy("root").agg(F.min("least").alias("component"))
    named = classes.join(names, "root").select("fp", "component", "root")
    return rows.join(named, "fp")


def near_duplicates(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per input row."""
    return grouped(docs, max_list).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def one_of_each(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``docs`` without all but one of each ``root``, columns unchanged.

    ``members``: id, text_hash, root. The row with the smallest id stays, one without an id
    only if all are; of different texts under that id, the one with the smaller hash; of
    rows equal in id and text, one.
    """
    stay = written(
        members.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("m"))
        .select(F.col("m.id").alias("id"), F.col("m.text_hash").alias("text_hash")),
        "simhash-kept",
    )
    return rows_of(docs, stay).select("row.*")


def keep_one(docs: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, columns unchanged."""
    return one_of_each(docs, grouped(docs, max_list))
