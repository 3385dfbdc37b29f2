"""Mix sources to target weights with Sainte-Laguë apportionment of equal-token blocks.

1. Sources in code point order (NULL last) get the weights 3, 1, 2, repeating, and share
   ``SHARE`` times all words. No target exceeds ``MAX_PASSES`` times its source; the
   excess goes to the others by weight until none is above. In order of
   (limit / weight) this is one running sum over the sources.
2. The mix is made of blocks of ``block_words`` words. Blocks go to sources by highest
   quotients target / (2 k + 1). Each source is cut into shards by a seeded hash of the
   document id, and its blocks go to its shards by highest quotients of their sizes.
   Seats that every party certainly has are given at once; only the quotients around the
   last seat, a few per party, are ranked.
3. Inside a shard the documents stand in seeded order, one after the other, and the quota
   takes whole blocks from the front; a quota beyond the shard starts a second pass.

A word is a run of other characters than space and U+0009 to U+000D. NULL and empty texts
have size 0 and take nothing; a NULL source is a source. Equal rows are separate documents.
The hash is MD5 of seed and id, so reruns agree and SQL can follow. A source has at most
``max_shards`` shards, so the quotient ranking of a source is bounded; a shard is one
window partition of (id, size) rows.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from touchpath.llm.common import WORD, rows_of, spread_join, written

WEIGHTS, SHARE, MAX_PASSES = (3, 1, 2), 1.5, 2
BLOCK_WORDS, SHARD_WORDS, MAX_SHARDS = 32, 1 << 18, 4096


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source."""
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(place - 1, F.lit(len(WEIGHTS))) + 1).alias("weight"),
        (F.lit(SHARE) * F.sum("source_size").over(everything)).alias("total"),
        (F.col("source_size") * MAX_PASSES).alias("limit"),
    ).withColumn("ratio", F.col("limit") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    leveled = weighed.withColumn("level", (F.col("total") - before) / onward)
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    share = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return leveled.select("source", "source_size", share.cast("double").alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], votes: str, seats: str) -> DataFrame:
    """Adds ``won``: the ``seats`` of a group (equal on all its rows) go to the highest quotients.

    The divisor method with seats n and m parties gives each party at least what divisor
    votes / (n - m/2) gives it and at most what votes / (n + m/2) gives it.
    """
    whole = Window.partitionBy(*group)
    v = F.col(votes).cast("double")
    sums = parties.withColumns({
        "__all": F.sum(v).over(whole), "__m": F.count_if(v > 0).over(whole) / 2,
    })

    def rounded(n: Column) -> Column:
        return F.when((n > 0) & (F.col("__all") > 0), F.floor(v * n / F.col("__all") + 0.5)).otherwise(0).cast("long")
    sure = rounded(F.col(seats) - F.col("__m") - 0.001)
    bounds = sums.withColumns({"__low": sure, "__high": rounded(F.col(seats) + F.col("__m")) + 1})
    quotients = bounds.withColumn("__left", F.col(seats) - F.sum("__low").over(whole)).where(v > 0).select(
        *group, *party, "__left",
        F.explode(F.expr("transform(sequence(__low, __high), k -> 2 * k + 1)")).alias("__odd"), v.alias("__v"),
    )
    order = Window.partitionBy(*group).orderBy(F.desc(F.col("__v") / F.col("__odd")), *[F.col(p).asc_nulls_last() for p in party])
    extra = quotients.withColumn("__rank", F.row_number().over(order)).where("__rank <= __left").groupBy(
        *group, *party).agg(F.count(F.lit(1)).alias("__extra"))
    keys = [*group, *party]
    extra = extra.withColumnsRenamed({k: f"__x_{k}" for k in keys})
    on = [bounds[k].eqNullSafe(extra[f"__x_{k}"]) for k in keys]
    won = F.col("__low") + F.coalesce("__extra", F.lit(0))
    return bounds.join(extra, on, "left").select(*[F.col(c) for c in parties.columns], won.cast("long").alias("won"))


def _seeded(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mix(
    docs: DataFrame, seed: int = 0, block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS, max_shards: int = MAX_SHARDS,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken and text_hash, one row per input row."""
    rows = written(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    ), "mix-sizes")
    wanted = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long")
    by_source = sainte_lague(wanted.withColumns({"seats": blocks, "all": F.lit(0)}), ["all"], ["source"], "target", "seats")
    parts = F.greatest(F.lit(1), F.least(F.lit(max_shards), F.ceil(F.col("source_size") / shard_words)))
    by_source = written(by_source.select(
        "source", "source_size", "target", F.col("won").alias("source_blocks"), parts.cast("long").alias("parts")), "mix-sources")

    place = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")
    placed = spread_join(rows, by_source, ["source"], F.col("doc_id")).withColumn("key", _seeded(seed)).withColumn(
        "shard", F.pmod(place, F.col("parts")))
    shards = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks"))
    quotas = sainte_lague(shards, ["source"], ["shard"], "shard_size", "source_blocks").select(
        F.col("source").alias("s"), F.col("shard").alias("h"), F.col("won").alias("quota"))
    joined = placed.join(quotas, placed["source"].eqNullSafe(quotas["s"]) & (placed["shard"] == quotas["h"])).drop("s", "h")

    shard = Window.partitionBy("source", "shard")
    order = shard.orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    laid = joined.withColumns({"end": F.sum("size").over(order), "length": F.sum("size").over(shard)})
    laid = laid.withColumn("n", F.ceil(F.col("length") / block_words)).withColumn(
        "quota", F.least("quota", MAX_PASSES * F.col("n")))
    passes = F.expr("case when n > 0 then quota div n else 0 end")
    front = F.expr(f"case when n > 0 then least((quota % n) * {int(block_words)}, length) else 0 end")
    start = F.col("end") - F.col("size")
    part = F.greatest(F.lit(0), F.least("end", front) - start)
    taken = (passes * F.col("size") + part).cast("long")
    return laid.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "text_hash")


def mix_report(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken, one row per input row."""
    return mix(docs, seed).select("doc_id", "size", "source_size", "target", "taken")


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def first_words(text: str, n: int) -> str:
    """``text`` up to the end of its n-th word."""
    match = next(itertools.islice(_WORDS.finditer(text), n - 1, None), None) if n > 0 else None
    return text[: match.end()] if match else ""


@F.pandas_udf(StringType())
def _first_words(text: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else first_words(t, int(k)) for t, k in zip(text, n)], dtype=object)


def mixed_texts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents: a text once or twice, then its first words, by what was taken.

    Documents of which nothing is taken go. Rows equal in id and text become one row
    with what they take together. ``n_chars`` is brought up to date.
    """
    plan = mix(docs, seed).groupBy(F.col("doc_id").alias("id"), "text_hash").agg(
        F.sum("taken").alias("taken"), F.max("size").alias("size")).where("taken > 0")
    some = rows_of(docs, plan).withColumn("text", F.col("row.text"))
    whole = F.expr("cast(taken div size as int)")
    rest = F.col("taken") - whole * F.col("size")
    head = _first_words(F.when(rest > 0, F.col("text")), rest)
    times = F.array_repeat(F.col("text"), whole)
    text = F.array_join(F.when(rest > 0, F.array_append(times, head)).otherwise(times), "\n")
    made = some.select("row", text.alias("__text"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("__text").alias(c)
        if c == "n_chars":
            return F.length("__text").cast(docs.schema[c].dataType).alias(c)
        return F.col(f"row.`{c}`").alias(c)
    return made.select(*[column(c) for c in docs.columns])
