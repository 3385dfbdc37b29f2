"""Merkle manifest of a table of documents, with a proof for every row.

Leaves are digests of rows. Within a source they are ordered by ``doc_id`` and every 16
consecutive nodes become one, level by level, up to the source's subroot; the subroots,
ordered by source, are joined to the root in the same way.

A level is one aggregation per parent (slot pivot): conditional aggregates spread the
children into the columns ``c0`` to ``c15``. Concatenated, the columns give the parent's
digest; without a child's own column they are its siblings. Going down again, a parent
hands its path (the siblings of it and of all nodes above) to its children, so a path is
carried once for 16 leaves.

A source may hold any share of the rows: positions come from a range partitioning by
(source, doc_id) and counts per partition, never from a window over a source, and a group
holds 16 rows at most. The number of levels is the only figure that the driver reads.

NULL sources come first and are a source of their own, not that of the empty string. NULL
ids come first in their source. Rows equal in source and id are ordered by their digests;
equal rows have equal digests and proofs of their own. An empty table has no root and
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchpath.llm.common import LOWER, UPPER, lowered, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"c{i}" for i in range(FANOUT)]
TAMPER = 5
NO_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of a row: each field as byte count, colon and value, or a dash for NULL."""
    texts = [value.cast("string") for value in values.values()]
    return digest(*[
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ])


def leaves(docs: DataFrame, changed: Column, change: Column) -> DataFrame:
    """key, doc_id, leaf and ``found``: the leaf of the row as found, with text ``change`` where ``changed``."""
    values = {name: F.col(f"`{name}`") for name in FIELDS}
    key = F.coalesce(F.concat(F.lit("="), values["source"].cast("string")), F.lit(""))
    other = leaf_digest(values | {"text": change})
    return docs.select(
        key.alias("key"), values["doc_id"].alias("doc_id"), leaf_digest(values).alias("leaf"),
        F.when(changed & values["text"].isNotNull(), other).alias("other"),
    ).select("key", "doc_id", "leaf", F.coalesce("other", "leaf").alias("found"))


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``pos`` (from 0) within ``key`` by ``order``, and ``size``, the rows of the key.

    Rows are dealt by ranges and numbered inside their partition; the rows that a key has
    in the partitions before are added from counts per (key, partition).
    """
    dealt = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    numbered = written(dealt.select(
        "*", F.monotonically_increasing_id().alias("n"), F.spark_partition_id().alias("part")), name)
    counts = numbered.groupBy("key", "part").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("many"))
    by_part = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "key", "part", (F.col("first") - F.coalesce(F.sum("many").over(by_part), F.lit(0))).alias("zero"),
        F.sum("many").over(Window.partitionBy("key")).alias("size"),
    )
    return numbered.join(counts, ["key", "part"]).withColumn("pos", F.col("n") - F.col("zero")).drop("n", "part", "zero")


def pivoted(nodes: DataFrame) -> DataFrame:
    """key, size, parent and the children's digests in slots, one row per parent."""
    parent = F.expr(f"pos div {FANOUT}").alias("parent")
    slot = F.pmod("pos", F.lit(FANOUT))
    return nodes.groupBy("key", "size", parent).agg(
        *[F.max(F.when(slot == i, F.col("h"))).alias(c) for i, c in enumerate(SLOTS)])


def joined_slots(slots: list[str]) -> Column:
    return F.concat_ws("", *slots) if slots else F.lit("")


def tree(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The pivoted levels above ``nodes`` (key, size, pos, h), and the roots (key, level, h)."""
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels, roots = [], []
    while True:
        roots.append(nodes.where("size = 1").select("key", F.lit(len(levels)).alias("level"), "h"))
        if largest <= 1:
            return levels, reduce(DataFrame.union, roots)
        levels.append(written(pivoted(nodes.where("size > 1")), name))
        nodes = levels[-1].select(
            "key", F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size"), F.col("parent").alias("pos"),
            digest(joined_slots(SLOTS)).alias("h"))
        largest = -(-largest // FANOUT)


def around(i: int) -> Column:
    """The slots left and right of slot ``i``."""
    return F.struct(joined_slots(SLOTS[:i]).alias("left"), joined_slots(SLOTS[i + 1:]).alias("right"))


def with_paths(levels: list[DataFrame], roots: DataFrame, carried: list[str], name: str) -> DataFrame | None:
    """The lowest level's parents with the ``path`` from there up, lowest step first, and ``carried``.

    ``roots``: key, level, path, carried. None where no key has more than one node.
    """
    below = None
    for level in range(len(levels), 0, -1):
        above = roots.where(F.col("level") == level).select("key", F.lit(0).cast("long").alias("parent"), "path", *carried)
        if below is not None:
            steps = F.array(*[
                F.struct((F.col("parent") * FANOUT + i).alias("pos"), F.col(c).alias("h"), around(i).alias("step"))
                for i, c in enumerate(SLOTS)
            ])
            inner = below.select("key", "path", *carried, F.inline(steps)).where("h is not null").select(
                "key", F.col("pos").alias("parent"), F.concat(F.array("step"), "path").alias("path"), *carried)
            above = above.union(inner)
        below = written(levels[level - 1].join(above, ["key", "parent"]), name)
    return below


def own_step(parents: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` (key, pos, ...) with their whole ``path``, the own slot left out of the first step."""
    slot = F.pmod("pos", F.lit(FANOUT))
    step = reduce(lambda found, i: found.when(slot == i, around(i)), range(1, FANOUT), F.when(slot == 0, around(0)))
    both = nodes.withColumn("parent", F.expr(f"pos div {FANOUT}")).join(parents.drop("size"), ["key", "parent"])
    return both.withColumn("path", F.concat(F.array(step), "path")).drop("parent", *SLOTS)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["left"], h, step["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def proofs(found: DataFrame) -> DataFrame:
    """doc_id, leaf, found, subroot, root and ``path`` for rows of ``leaves``."""
    rows = written(ranked(found, ["doc_id", "leaf", "found"], "merkle-order"), "merkle-leaves")
    levels, subroots = tree(rows.select("key", "size", "pos", F.col("leaf").alias("h")), "merkle-level")
    subroots = written(subroots, "merkle-subroots")

    sources = ranked(subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), "level", "h"), ["source"], "merkle-sources")
    sources = written(sources, "merkle-top")
    top_levels, root = tree(sources.select("key", "size", "pos", "h"), "merkle-top-level")
    root = root.select("key", F.col("level"), F.array().cast(NO_PATH).alias("path"), F.col("h").alias("root"))
    parents = with_paths(top_levels, root, ["root"], "merkle-top-path")
    if parents is None:  # one source, or none
        tops = sources.join(root.drop("level"), "key")
    else:
        tops = own_step(parents, sources)
    tops = written(tops.select(F.col("source").alias("key"), "level", "path", F.col("h").alias("subroot"), "root"), "merkle-paths")

    alone = rows.where("size = 1").join(tops.drop("level"), "key")
    parents = with_paths(levels, tops, ["subroot", "root"], "merkle-path")
    out = ["doc_id", "leaf", "found", "subroot", "root", "path"]
    if parents is None:
        return alone.select(*out)
    return own_step(parents, rows.where("size > 1")).select(*out).union(alone.select(*out))


def manifest(docs: DataFrame) -> DataFrame:
    """Digests, proof and verification of every row; ids divisible by crc32 are found with changed text.

    The rows whose unsigned CRC-32 of the decimal id is divisible by 5 are looked at as if
    A-Z of their texts had been lower-cased since the manifest was made.
    """
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPER)) == 0
    rows = proofs(leaves(docs, F.coalesce(tampered, F.lit(False)), lowered(F.col("text"))))
    root = folded(F.col("found"), F.col("path"))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_LEVELS = 8


def _oracle() -> str:
    """The manifest in DuckDB's SQL, for up to 16**8 documents of a source and as many sources."""
    def field(c: str, value: str | None = None) -> str:
        value = value or f"cast({c} as varchar)"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*(field(c) for c in FIELDS[:-1]), field("text", text)]) + ")"

    low = f"translate(text, '{UPPER}', '{LOWER}')"
    crc = (
        "xor(4294967295, list_reduce([4294967295::bigint] || [ascii(x)::bigint for x in string_split(cast(doc_id as varchar), '')], "
        "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"
    )
    steps = [
        f"base as (select doc_id, coalesce('=' || source, '') as k, {leaf('text')} as leaf, "
        f"case when {crc} % {TAMPER} = 0 then {leaf(low)} else {leaf('text')} end as found from documents)",
        "s0 as (select *, row_number() over (partition by k order by doc_id nulls first, leaf, found) - 1 as pos, "
        "count(*) over (partition by k) as size from base)",
        "s_n0 as (select k, size, pos, leaf as h from s0)",
    ]

    def climb(p: str) -> None:
        for i in range(_LEVELS):
            run = f"partition by k, pos // {FANOUT} order by pos rows between"
            steps.append(
                f"{p}_w{i} as (select *, case when size = 1 then '' else coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') end as l, "
                f"case when size = 1 then '' else coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') end as r from {p}_n{i})")
            steps.append(
                f"{p}_n{i + 1} as (select k, (size + {FANOUT - 1}) // {FANOUT} as size, pos // {FANOUT} as pos, "
                f"case when size = 1 then min(h) else sha256(string_agg(h, '' order by pos)) end as h from {p}_n{i} group by k, size, pos // {FANOUT})")

    climb("s")
    steps.append(f"t_n0 as (select '' as k, count(*) over () as size, row_number() over (order by k) - 1 as pos, h, k as source from s_n{_LEVELS})")
    climb("t")

    def follow(p: str, start: str) -> None:
        steps.append(f"{p}_f0 as ({start})")
        for i in range(_LEVELS):
            steps.append(
                f"{p}_f{i + 1} as (select f.* exclude (node, cur, proof), f.node // {FANOUT} as node, "
                f"case when w.size = 1 then cur else sha256(w.l || cur || w.r) end as cur, proof || w.l || w.r as proof "
                f"from {p}_f{i} f join {p}_w{i} w on f.tree = w.k and f.node = w.pos)")

    follow("s", "select doc_id, leaf, k, k as tree, pos as node, found as cur, '' as proof from s0")
    follow("t", f"select f.doc_id, f.leaf, n.h as subroot, '' as tree, n.pos as node, f.cur, f.proof from s_f{_LEVELS} f join t_n0 n on f.k = n.source")
    return (
        f"with {', '.join(steps)} select f.doc_id, f.leaf, f.subroot, n.h as root, sha256(f.proof) as proof_sha256, "
        f"f.cur as folded_root, f.cur = n.h as verified from t_f{_LEVELS} f cross join t_n{_LEVELS} n"
    )


ORACLE = _oracle()
