"""How far the sources of a language differ in their words, from term stripes.

In-mapper stripes: every partition folds whole documents into stripes, one per (language,
term), of the number of documents with the term and its occurrences per source. Stripes
stay in the worker until it holds ``max_terms`` distinct terms; then they are emitted
(spilled) and folding starts anew, so memory is bounded and nothing is left out. The
shuffle merges stripes by key. A frequent term has one row per spill and source at its
key, far less than its occurrences.

Merged stripes that enough documents back are kept. They are dealt into buckets, by terms,
of at most ``BUCKET`` entries on average; a bucket meets the list of its language's
sources once and emits its share of every distance between two sources and its strongest
terms per source. Shares are summed and the strongest of the strongest ranked, so neither
a language nor a term is ever in one task as a whole. With very many sources the pairs,
which are the result, are divided over tasks by their first source, too.

All arithmetic is on integers; shares whose numerators pass 64 bits are computed with
Python's integers.

NULL text, language and source count as empty. Texts without a term make their group
occur. Rows equal in all columns count as documents of their own. A language with one
source has no pairs; one without kept terms has distances of 0 and no terms. An empty
table has no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.llm.common import LOWER, UPPER, byte_table, spread_join, words_in, written

MIN_DOCUMENTS, TOP = 30, 50
SCALE, PRIOR = 10**9, 5
MAX_TERMS = 500_000
BUCKET, PAIRS = 50_000, 1_000_000
_TERM = byte_table()
_SLICE = 1 << 16
_BATCH_WORDS = 1 << 20
_GROUPS = 1 << 20
STRIPE = "lang string, term binary, n_docs long, sources array<string>, counts array<long>"
SHARE = "lang string, source string, part string, item binary, value long"


def folded(keys: np.ndarray, *amounts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct ``keys``, sorted, with the sums of their ``amounts``."""
    if not len(keys):
        return (keys, *amounts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return (keys[first], *(np.add.reduceat(a[order], first) for a in amounts))


class Stripes:
    """The stripes of the documents folded so far."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.fresh: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.fresh_size = 0
        none = np.zeros(0, np.int64)
        self.held = (none, none, none)

    def fold(self, lang: str, source: str, text: bytes | None) -> None:
        group = self.groups.setdefault((lang, source), len(self.groups))
        number = self.terms.setdefault
        found, counts = [], []
        for words in words_in(text, _TERM):
            ids = np.fromiter((number(w, len(self.terms)) for w in words), np.int64, len(words))
            part = folded(ids, np.ones(len(ids), np.int64))
            found.append(part[0])
            counts.append(part[1])
        if len(found) > 1:
            found, counts = [[x] for x in folded(np.concatenate(found), np.concatenate(counts))]
        if found and len(found[0]):
            self.fresh.append((found[0] * _GROUPS + group, np.ones(len(found[0]), np.int64), counts[0]))
            self.fresh_size += len(found[0])
        if self.fresh_size > _BATCH_WORDS + len(self.held[0]):
            self._settle()

    def _settle(self) -> None:
        self.held = folded(*(np.concatenate(x) for x in zip(self.held, *self.fresh)))
        self.fresh, self.fresh_size = [], 0

    def full(self, max_terms: int) -> bool:
        return len(self.terms) >= max_terms or len(self.groups) >= _GROUPS

    def spill(self) -> Iterator[pa.RecordBatch]:
        self._settle()
        keys, docs, counts = self.held
        names = list(self.groups)
        langs = sorted({lang for lang, _ in names})
        lang_of = np.array([langs.index(lang) for lang, _ in names], np.int64)
        term, group = keys // _GROUPS, keys % _GROUPS
        stripe = term * max(1, len(langs)) + (lang_of[group] if len(group) else group)
        order = np.argsort(stripe, kind="stable")
        stripe, docs, counts, group = stripe[order], docs[order], counts[order], group[order]
        starts = np.flatnonzero(np.concatenate(([True], stripe[1:] != stripe[:-1]))) if len(stripe) else stripe
        ends = np.append(starts[1:], len(stripe))
        all_terms, all_langs = pa.array(self.terms, pa.binary()), pa.array(langs, pa.string())
        sources = pa.array([source for _, source in names], pa.string())
        for i in range(0, len(starts), _SLICE):
            a, b = starts[i:i + _SLICE], ends[i:i + _SLICE]
            rows = slice(a[0], b[-1])
            offsets = pa.array(np.append(a, b[-1]) - a[0], pa.int32())
            which = stripe[a]
            yield pa.RecordBatch.from_arrays([
                all_langs.take(pa.array(which % len(langs))),
                all_terms.take(pa.array(which // len(langs))),
                pa.array(np.add.reduceat(docs[rows], a - a[0])),
                pa.ListArray.from_arrays(offsets, sources.take(pa.array(group[rows]))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[rows])),
            ], ["lang", "term", "n_docs", "sources", "counts"])


def stripes(docs: DataFrame, max_terms: int = MAX_TERMS) -> DataFrame:
    """The spilled stripes of ``docs`` (lang, source, text as bytes)."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Stripes()
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns[:2]), batch.column(2)):
                held.fold(lang, source, text.as_py())
                if held.full(max_terms):
                    yield from held.spill()
                    held = Stripes()
        yield from held.spill()
    return docs.select("lang", "source", "text").mapInArrow(fold, STRIPE)


def merged(spilled: DataFrame, min_documents: int) -> DataFrame:
    """lang, term, ``by_source`` (source, count): stripes merged by key, those of enough documents."""
    stripe = written(spilled, "divergence-spilled")
    often = stripe.groupBy("lang", "term").agg(F.sum("n_docs").alias("n")).where(F.col("n") >= min_documents)
    often = written(often.select("lang", "term"), "divergence-terms")
    entries = stripe.join(often, ["lang", "term"], "left_semi").select(
        "lang", "term", F.inline(F.arrays_zip("sources", "counts")))
    by_source = entries.groupBy("lang", "term", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    return by_source.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("by_source"))


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / total), exactly."""
    if not len(counts):
        return counts
    if int(counts.max()) >= 9 * SCALE:
        counts = counts.astype(object)
    return (1 + SCALE * (counts + PRIOR) // total).astype(np.int64)


def _shares_of(kept: pa.Table, sources: pa.Table, top: int) -> pa.Table:
    """A bucket's part of all distances from the sources of a block, and their strongest terms."""
    lang = sources["lang"][0].as_py()
    listed = sorted(zip(sources["source"].to_pylist(), sources["total"].to_pylist(), sources["own"].to_pylist()))
    names = [name for name, _, _ in listed]
    totals = [total for _, total, _ in listed]
    own = [i for i, (_, _, mine) in enumerate(listed) if mine]
    name_array = pa.array(names, pa.string())
    n_terms = kept.num_rows
    table = kept.sort_by("term") if n_terms else kept
    terms = table["term"].combine_chunks()
    by_source = table["by_source"].combine_chunks()
    entries = by_source.flatten()
    term = np.repeat(np.arange(n_terms), by_source.value_lengths().to_numpy(zero_copy_only=False)) if n_terms else np.zeros(0, np.int64)
    source = pc.index_in(entries.field("source"), name_array).to_numpy(zero_copy_only=False).astype(np.int64) if n_terms else term
    count = entries.field("n").to_numpy(zero_copy_only=False).astype(np.int64) if n_terms else term
    order = np.argsort(source, kind="stable")
    term, source, count = term[order], source[order], count[order]
    first = np.searchsorted(source, np.arange(len(names) + 1))
    share = np.concatenate([shares(count[first[i]:first[i + 1]], totals[i]) for i in range(len(names))])
    absent = np.array([1 + SCALE * PRIOR // total if total else 0 for total in totals], np.int64)
    overall = np.zeros(n_terms, np.int64)
    np.add.at(overall, term, count)
    whole = shares(overall, sources["lang_total"][0].as_py())
    present = first[1:] > first[:-1]
    out: list[pa.RecordBatch] = []

    def emit(name: str, part: str, items: pa.Array, values: np.ndarray) -> None:
        n = len(values)
        out.append(pa.RecordBatch.from_arrays([
            pa.array([lang] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array([part] * n, pa.string()),
            items.cast(pa.binary()), pa.array(values, pa.int64()),
        ], ["lang", "source", "part", "item", "value"]))

    for i in own:
        mine = slice(first[i], first[i + 1])
        here, my_terms = share[mine], term[mine]
        # all terms as if the other source had none of them, then put right where it has
        low = np.sort(here)
        below = np.searchsorted(low, absent)
        sums = np.concatenate(([0], np.cumsum(low)))
        distance = (absent * below - sums[below]) + (sums[-1] - sums[below] - absent * (len(low) - below))
        distance += (n_terms - len(low)) * np.abs(absent[i] - absent)
        if len(share):
            at = np.full(n_terms, absent[i])
            at[my_terms] = here
            change = np.abs(at[term] - share) - np.abs(at[term] - absent[source])
            distance[present] += np.add.reduceat(change, first[:-1][present])
        others = np.arange(len(names)) != i
        emit(names[i], "pair", name_array.filter(pa.array(others)), distance[others])
        more = here - whole[my_terms]
        strong = np.flatnonzero(more > 0)
        strong = strong[np.lexsort((my_terms[strong], -more[strong]))][:top]
        emit(names[i], "term", terms.take(pa.array(my_terms[strong])), more[strong])
    return pa.Table.from_batches(out)


def divergences(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP, max_terms: int = MAX_TERMS,
                bucket: int = BUCKET, pairs: int = PAIRS) -> DataFrame:
    """lang, source, part, item, value and rank, for every (lang, source) that occurs."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)
    rows = docs.select(text_of("lang"), text_of("source"), text_of("text").cast("binary").alias("text"))
    groups = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_documents"))
    kept = written(merged(stripes(rows, max_terms), min_documents), "divergence-stripes")

    counted = kept.select("lang", F.inline("by_source")).groupBy("lang", "source").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("entries"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    per_lang = Window.partitionBy("lang")
    place = F.row_number().over(per_lang.orderBy("source")) - 1
    known = groups.join(counted, ["lang", "source"], "left").join(terms, "lang", "left").select(
        "lang", "source", place.alias("place"), F.count(F.lit(1)).over(per_lang).alias("s"),
        (F.coalesce("n", F.lit(0)) + PRIOR * F.coalesce("v", F.lit(0))).alias("total"),
        (F.coalesce(F.sum("n").over(per_lang), F.lit(0)) + PRIOR * F.coalesce("v", F.lit(0))).alias("lang_total"),
        F.ceil(F.coalesce(F.sum("entries").over(per_lang), F.lit(1)) / bucket).cast("int").alias("buckets"),
    ).withColumn("block", F.greatest(F.lit(1), F.expr(f"cast({int(pairs)} div s as int)")))
    known = written(known.withColumn("blocks", F.ceil(F.col("s") / F.col("block")).cast("int")), "divergence-sources")

    def numbers(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)
    split = known.groupBy("lang").agg(F.max("buckets").alias("buckets"), F.max("blocks").alias("blocks"))
    dealt = spread_join(kept, split, ["lang"], F.col("term")).select(
        "lang", "term", "by_source", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"),
        F.explode(numbers("blocks")).alias("nth"))
    listed = known.withColumn("bucket", F.explode(numbers("buckets"))).withColumn("nth", F.explode(numbers("blocks"))).select(
        "lang", "bucket", "nth", "source", "total", "lang_total",
        (F.floor(F.col("place") / F.col("block")) == F.col("nth")).alias("own"))
    keys = ["lang", "bucket", "nth"]
    found = listed.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        lambda sources, stripes_: _shares_of(stripes_, sources, top), SHARE)
    summed = found.groupBy("lang", "source", "part", F.col("item").cast("string").alias("item")).agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))


ORACLE = f"""
with docs as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as words
  from documents
), words as (select rid, lang, source, unnest(words) as term from docs),
kept as (select lang, term from words group by all having count(distinct rid) >= {MIN_DOCUMENTS}),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (select distinct d.lang, d.source, coalesce(v, 0) as v from docs d left join sizes z on d.lang = z.lang),
counts as (select w.lang, source, w.term, count(*) as n from words w join kept k on w.lang = k.lang and w.term = k.term group by all),
totals as (select lang, source, sum(n) as total from counts group by all),
dense as (
  select g.lang, g.source, k.term, coalesce(n, 0) as n,
    (1 + ({SCALE}::hugeint * (coalesce(n, 0) + {PRIOR})) // (coalesce(total, 0)::hugeint + {PRIOR} * v))::bigint as p
  from groups g join kept k on g.lang = k.lang
  left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join totals t on t.lang = g.lang and t.source = g.source
), whole as (
  select lang, term, (1 + ({SCALE}::hugeint * (sum(n) + {PRIOR})) // (sum(sum(n)) over (partition by lang) + {PRIOR} * any_value(v)))::bigint as q
  from counts join sizes using (lang) group by lang, term
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, sum(abs(a.p - b.p))::bigint as value
  from dense a join dense b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all
  select a.lang, a.source, 'pair', b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source where a.v = 0
  union all
  select d.lang, source, 'term', d.term, p - q from dense d join whole w on d.lang = w.lang and d.term = w.term where n > 0 and p > q
)
select * from (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from found
) where part = 'pair' or rank <= {TOP}
"""
