"""What the operators share: tables, the shared folder, word patterns, joins, components."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase
PIECE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``).

    Only a local session without that setting, as in tests, gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors.

    ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowered(text: Column) -> Column:
    """``text`` with A-Z, and no other letter, in lower case."""
    return F.translate(text, UPPER, LOWER)


def byte_table(others: str = "") -> bytes:
    """For ``words_in``: A-Z become lower case; a-z, ``others`` and bytes from 0x80 on stay; the rest parts words."""
    kept = (LOWER + others).encode()
    same = {ord(u): ord(v) for u, v in zip(UPPER, LOWER)} | {b: b for b in (*kept, *range(0x80, 0x100))}
    return bytes(same.get(b, 0x20) for b in range(256))


def words_in(data: bytes | None, table: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text in lists of about ``piece`` bytes, so that no list grows with the text."""
    data = (data or b"").translate(table)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece) if len(data) - at > piece else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once: a generator keeps filters and later columns from repeating it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` reads it inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], by: Column, n: int = 16) -> DataFrame:
    """Left join of a small table on keys of which one may hold most rows of ``big``.

    ``big`` is spread over ``n`` salts made from ``by``; ``small`` has a copy for each.
    NULL keys match NULL keys. Columns of ``small`` must not clash with ``big``.
    """
    left = big.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(n)).cast("int"))
    names = {k: f"__key_{k}" for k in keys}
    right = small.withColumnsRenamed(names).withColumn(
        "__salt_right", F.explode(F.array(*[F.lit(i) for i in range(n)]))
    )
    on = left["__salt"] == right["__salt_right"]
    for k, name in names.items():
        on &= left[k].eqNullSafe(right[name])
    return left.join(right, on, "left").drop("__salt", "__salt_right", *names.values())


def whole_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (all columns, the text in it once), ``id``, ``text_hash`` and ``key``, a hash of both.

    ``key`` is never NULL, so that joins on it and groupings by it share one exchange of the rows.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
    )
    return rows.withColumn("key", F.xxhash64("id", "text_hash"))


def rows_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``row`` of ``docs`` for each (id, text_hash) in ``chosen``, with its other columns; one row of equal ones.

    The rows are moved once: the join and the grouping are dealt by the same key.
    """
    right = chosen.withColumn("id", F.col("id").cast("long")).withColumn("key", F.xxhash64("id", "text_hash")).withColumnsRenamed({"id": "__id", "text_hash": "__hash"})
    rows = whole_rows(docs)
    on = (rows["key"] == right["key"]) & rows["id"].eqNullSafe(right["__id"]) & (rows["text_hash"] == right["__hash"])
    found = rows.join(right.hint("shuffle_hash"), on).drop(right["key"])
    return found.dropDuplicates(["key", "id", "text_hash"]).drop("key", "__id", "__hash")


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component) for each node in an edge.

    ``component`` is the smallest node reachable. Alternates large-star and small-star
    steps; every round is a written table, so nothing is collected and a lost executor
    costs one round at most. NULL ends and loops are ignored.
    """
    e = written(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        name,
    )
    mark = _checksum(e)
    for _ in range(rounds):
        if not mark[0]:
            break
        e = written(_small_star(_large_star(e)), name)
        before, mark = mark, _checksum(e)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()


def _checksum(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.join(least, "u").where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and the node, to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    others = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()
