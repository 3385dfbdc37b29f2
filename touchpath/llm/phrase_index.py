"""Benchmark passages in documents, found through a positional inverted index.

The index holds the postings of all words of all documents. Documents are folded into
shards of about ``shard_bytes`` of text; a row of the index is one word of one shard with
its positions (words are numbered through the shard), and one row per shard, without a
word, tells where its documents begin. A frequent word thus has one bounded list per
shard, and no list grows with the corpus. The index is a written table and serves any
number of searches.

A phrase search takes the terms of a phrase in the order of their frequency. The two
rarest lists of every shard are intersected first, adjusted by the terms' offsets; these
lists are short, so only few (shard, phrase) pairs are left. The lists of all terms of the
phrases still open are brought together by shard (the one larger shuffle; lists of other
words never move), where each is searched for the places left, again rarest first, and
places that reach into the next document go.

A proximity search asks for documents in which the rarest terms of an item occur within
some words of each other, in any order; each match is the shortest such run that ends
where it ends.

Words are lower-cased (A-Z only) runs of 0-9, a-z and all characters from U+0080 on. NULL
and empty texts have none and give a row with zeros. Rows with equal or NULL ids are
documents of their own. Items with equal ids are one item, whatever their texts; a NULL id
counts as the id ''. Items without words match nothing; an empty benchmark leaves all
documents clean; an empty table of documents has no rows. Other columns are not read. A
document is in one shard, so the largest one bounds memory (four bytes per word, and its
bytes); its words are never one list.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import LOWER, UPPER, byte_table, lowered, words_in, written

WINDOW = 10
SHARD_BYTES = 16 << 20
NEAR_TERMS, NEAR_WORDS = 4, 30
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = byte_table(string.digits)
_SLICE = 1 << 15
INDEX = "shard long, term binary, n int, positions array<int>, starts array<int>, ids array<long>"
SPAN = "array<struct<item:string,start:int,stop:int>>"
HITS = f"shard long, place int, doc_id long, n_words long, n_hit long, spans {SPAN}"


class Shard:
    """The postings of the documents folded so far."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.words: list[np.ndarray] = []
        self.ids: list[int | None] = []
        self.starts = [0]
        self.size = 0

    def fold(self, doc_id: int | None, text: bytes | None) -> None:
        number = self.terms.setdefault
        end = self.starts[-1]
        for words in words_in(text, _WORD):
            self.words.append(np.fromiter((number(w, len(self.terms)) for w in words), np.int32, len(words)))
            end += len(words)
        self.ids.append(doc_id)
        self.starts.append(end)
        self.size += len(text or b"")

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        names = ["shard", "term", "n", "positions", "starts", "ids"]
        words = np.concatenate(self.words) if self.words else np.zeros(0, np.int32)
        many = np.bincount(words, minlength=len(self.terms)).astype(np.int32)
        ends = np.cumsum(many)
        positions = np.argsort(words, kind="stable").astype(np.int32)
        terms = pa.array(self.terms, pa.binary())
        for i in range(0, len(many), _SLICE):
            count = many[i:i + _SLICE]
            first = ends[i] - many[i]
            offsets = np.append(first, ends[i:i + _SLICE]) - first
            held = positions[first:first + offsets[-1]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(count), shard)), terms.slice(i, len(count)), pa.array(count),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(held)),
                pa.nulls(len(count), pa.list_(pa.int32())), pa.nulls(len(count), pa.list_(pa.int64())),
            ], names)
        yield pa.RecordBatch.from_arrays([
            pa.array([shard]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.int32())),
            pa.array([self.starts], pa.list_(pa.int32())), pa.array([self.ids], pa.list_(pa.int64())),
        ], names)


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The written index of ``docs`` (doc_id, text)."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, Shard()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.fold(doc_id, text.as_py())
                if held.size >= shard_bytes:
                    yield from held.rows(number)
                    number, held = number + 1, Shard()
        if held.ids:
            yield from held.rows(number)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return written(rows.mapInArrow(fold, INDEX), "phrase-index")


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, phrase (words): all windows of the items; a shorter item is one window."""
    words = F.regexp_extract_all(lowered(F.col("text")), F.lit(WORD), F.lit(0))
    texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words.alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (
        texts.where(F.size("words") > 0).select("item", "words", F.explode(starts).alias("first"))
        .select("item", F.slice("words", F.col("first"), window).alias("phrase")).distinct()
    )


def item_terms(items: DataFrame) -> DataFrame:
    """item, phrase: the distinct words of an item."""
    whole = phrases(items, 2**31 - 2)
    return whole.groupBy("item").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("phrase")))).alias("phrase"))


def ranked(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Queries whose words all occur, with ``rarest``: their distinct words, rarest first, as bytes."""
    numbered = written(queries, "phrase-queries").withColumn("words", F.transform("phrase", lambda w: w.cast("binary")))
    each = numbered.select("item", "phrase", F.explode(F.array_distinct("words")).alias("term"))
    terms = written(each.select("term").distinct(), "phrase-terms")
    often = index.select("term", "n").join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    counted = each.join(written(often, "phrase-frequencies"), "term", "left").groupBy("item", "phrase").agg(
        F.array_sort(F.collect_list(F.struct("n", "term"))).alias("order"))
    known = counted.where(~F.exists("order", lambda x: x["n"].isNull()))
    return written(known.select("item", "phrase", F.transform("order", lambda x: x["term"]).alias("rarest")), "phrase-ranked")


def _offset(term: Column) -> Column:
    """Place of a word's first occurrence in the phrase."""
    return (F.array_position(F.transform("phrase", lambda w: w.cast("binary")), term) - 1).cast("int")


def _candidates(index: DataFrame, queries: DataFrame, adjusted: bool) -> DataFrame:
    """(shard, item, phrase, rarest) where the two rarest words meet, at their offsets if ``adjusted``."""
    rare = queries.select(F.explode(F.slice("rarest", 1, 2)).alias("term")).distinct()
    lists = written(index.select("shard", "term", "positions").join(written(rare, "phrase-rare"), "term", "left_semi"), "phrase-lists")
    first, second = F.col("rarest")[0], F.get("rarest", F.lit(1))
    one = lists.withColumnsRenamed({"term": "t1", "positions": "p1"})
    two = lists.withColumnsRenamed({"term": "t2", "positions": "p2", "shard": "s2"})
    found = queries.join(one, first == F.col("t1"))
    single = found.where(second.isNull())
    both = found.where(second.isNotNull()).join(two, (F.col("s2") == F.col("shard")) & (second == F.col("t2")))
    if adjusted:  # the places of the second word may be repeated in the phrase; its first one is there, too
        apart = _offset(second) - _offset(first)
        both = both.withColumn("apart", apart).where(
            F.arrays_overlap(F.transform("p1", lambda p: p + F.col("apart")), "p2"))
    keep = ["shard", "item", "phrase", "rarest"]
    return written(both.select(*keep).union(single.select(*keep)), "phrase-candidates")


def exact_places(phrase: list[bytes], rarest: list[bytes], lists: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where the phrase starts and stops: lists intersected by offsets, rarest first."""
    order = {term: i for i, term in enumerate(rarest)}
    offsets = sorted(range(len(phrase)), key=lambda k: order[phrase[k]])
    starts = lists[phrase[offsets[0]]] - offsets[0]
    for k in offsets[1:]:
        held = lists[phrase[k]]
        at = np.searchsorted(held, starts + k)
        starts = starts[held[np.minimum(at, len(held) - 1)] == starts + k]
    return starts, starts + len(phrase)


def near_places(terms: list[bytes], within: int, lists: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shortest runs of at most ``within`` words that hold all terms, rarest term first."""
    held = np.unique(np.concatenate([lists[t] for t in terms]))
    stops = held + 1
    for term in terms:
        after = lists[term]
        at = np.searchsorted(after, held)
        inside = at < len(after)
        held, stops, at = held[inside], stops[inside], at[inside]
        stops = np.maximum(stops, after[at] + 1)
        near = stops - held <= within
        held, stops = held[near], stops[near]
    # of runs that end together the last to begin is the shortest
    last = np.append(stops[1:] != stops[:-1], True) if len(stops) else np.zeros(0, bool)
    return held[last], stops[last]


def _joined(items: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping matches of an item as one span."""
    order = np.lexsort((starts, items))
    items, starts, stops = items[order], starts[order], stops[order]
    new = np.ones(len(items), bool)
    new[1:] = (items[1:] != items[:-1]) | (starts[1:] >= stops[:-1])
    first = np.flatnonzero(new)
    return items[first], starts[first], np.maximum.reduceat(stops, first) if len(first) else stops


def _hits(held: pa.Table, queries: pa.Table, places: Callable) -> pa.Table:
    """One row per document of a shard, with its matches."""
    terms = held["term"].to_pylist()
    directory = terms.index(None)
    starts = held["starts"][directory].values.to_numpy()
    ids = held["ids"][directory].values
    positions = held["positions"].combine_chunks()
    lists = {t: positions[i].values.to_numpy() for i, t in enumerate(terms) if t is not None}
    names: dict[str, int] = {}
    found = [np.zeros((3, 0), np.int64)]
    for item, phrase, rarest in zip(*(queries[c].to_pylist() for c in ("item", "phrase", "rarest"))):
        if any(t not in lists for t in rarest):
            continue
        begin, end = places([w.encode() for w in phrase], rarest, lists)
        doc = np.searchsorted(starts, begin, "right") - 1
        inside = (begin >= 0) & (end <= starts[np.minimum(doc + 1, len(starts) - 1)])
        number = names.setdefault(item, len(names))
        found.append(np.stack([np.full(inside.sum(), number), begin[inside], end[inside]]))
    item, begin, end = np.concatenate(found, axis=1)
    item, begin, end = _joined(item, begin, end)
    doc = np.searchsorted(starts, begin, "right") - 1
    order = np.lexsort((end, begin, item, doc))
    item, begin, end, doc = item[order], begin[order], end[order], doc[order]
    marks = np.zeros(starts[-1] + 1, np.int32)
    np.add.at(marks, begin, 1)
    np.add.at(marks, end, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(marks[:-1]) > 0)))
    n = len(ids)
    spans = pa.StructArray.from_arrays([
        pa.array(list(names), pa.string()).take(pa.array(item)), pa.array(begin - starts[doc], pa.int32()),
        pa.array(end - starts[doc], pa.int32()),
    ], ["item", "start", "stop"])
    return pa.Table.from_arrays([
        pa.array([held["shard"][0].as_py()] * n, pa.int64()), pa.array(np.arange(n), pa.int32()), ids,
        pa.array(np.diff(starts).astype(np.int64)), pa.array(np.diff(covered[starts])),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32()), spans),
    ], ["shard", "place", "doc_id", "n_words", "n_hit", "spans"])


def _search(index: DataFrame, queries: DataFrame, adjusted: bool, places: Callable) -> DataFrame:
    candidates = _candidates(index, queries, adjusted)
    # as many as the open phrases have words, however many shards there are
    needed = written(candidates.select(F.explode("rarest").alias("term")).distinct(), "phrase-needed")
    lists = index.where("term is not null").join(needed, "term", "left_semi").select(*index.columns)
    held = lists.union(index.where("term is null"))
    return held.groupBy("shard").cogroup(candidates.groupBy("shard")).applyInArrow(
        lambda postings, asked: _hits(postings, asked, places), HITS)


def exact_matches(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every document with its words, hit words and ``spans``: where windows of an item occur.

    Spans count words from the document's first; overlapping windows of an item are one
    span. ``shard`` and ``place`` tell documents with equal ids apart.
    """
    return _search(index, ranked(index, phrases(items, window)), True, exact_places)


def near_matches(index: DataFrame, items: DataFrame, n_terms: int = NEAR_TERMS, within: int = NEAR_WORDS) -> DataFrame:
    """Every document with ``spans`` in which the ``n_terms`` rarest words of an item lie close together.

    Only items all of whose words occur in the corpus are looked for. Overlapping runs of an
    item are one span.
    """
    queries = ranked(index, item_terms(items)).withColumn("rarest", F.slice("rarest", 1, n_terms))
    return _search(index, queries, False, lambda _, rarest, lists: near_places(rarest, within, lists))


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the ``spans``."""
    found = exact_matches(build_index(docs, shard_bytes), items, window)
    names = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"])))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = f"""
with docs as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from documents
), items as (
  select coalesce(cast(item_id as varchar), '') as item,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as w
  from benchmark
), windows as (
  select distinct item, least(len(w), {WINDOW}) as n, array_to_string(w[i:i + {WINDOW - 1}], ' ') as phrase
  from (select item, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 2))) as i from items where len(w) > 0)
), runs as (
  select rid, i, n, array_to_string(w[i:i + n - 1], ' ') as phrase
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from docs cross join (select distinct n from windows))
), hits as (select rid, i, r.n, item from runs r join windows x on r.n = x.n and r.phrase = x.phrase),
words as (
  select rid, count(*) as n_hit from (select distinct rid, unnest(range(i, i + n)) as place from hits) group by rid
), named as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct rid, item from hits) group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join words using (rid) left join named using (rid)
"""
