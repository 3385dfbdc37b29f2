"""Repeated 400-byte strings, found by merging Burrows-Wheeler transforms of shards.

Sorting all suffixes of a corpus is out of reach, and most of them are alone. So the work
is first divided without losing a repeat:

1. Anchors. Every window of ``LENGTH`` bytes has one anchor, the ``GRAM``-byte piece in it
   with the smallest hash (the last one, if several). Equal windows have equal anchors at
   the same place. The windows of one anchor are neighbours; with the bytes they span they
   are its context. Only anchors that occur at least twice matter further on.
2. Copies. Occurrences of an anchor with equal contexts are counted before anything moves:
   all their windows are repeated. One of them stands for all in the next step.
3. Different contexts of an anchor can only share a window if half of the bytes missing
   to ``LENGTH`` agree on one side of the anchor. Contexts that agree on a side (by hash)
   with another one are brought together by anchor; with the bytes at hand those remain
   that agree with another one in all but less than ``STEP`` bytes of a window.
4. The contexts of groups are laid out in shards. Each shard's suffixes are sorted and
   give its Burrows-Wheeler transform. The transforms are merged by iterative interleave
   refinement: starting from one class per group, each round puts the suffixes that are
   one symbol longer in order of that symbol, stably, so that after k rounds suffixes are
   together exactly if they share k symbols (``WIDE`` bytes each). The round in which neighbours part is their
   common prefix; suffixes left alone can never be repeated and leave. What is still
   together after ``LENGTH`` rounds are the repeated windows. No suffix is sorted again.

A group of more than ``GROUP`` contexts is divided into blocks that meet in pairs. Texts
move twice at most, the second time only those with something repeated.

NULL and empty texts have no bytes. Texts shorter than ``LENGTH`` keep all. Rows equal in
id and text are copies of each other. Contexts and anchors are compared by 64-bit hashes
within the same anchor hash; step 4 compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import written

LENGTH, GRAM = 400, 32
SIDE = (LENGTH - GRAM) // 2
GROUP = 1024
BUFFER, SHARD, BATCH = 1 << 23, 1 << 17, 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_FACTOR = 0x9E3779B97F4A7C15
SEPARATOR = 0xFF  # never in UTF-8
WIDE = 8  # bytes in a symbol of the transform; divides LENGTH
STEP = 46  # a window around an anchor has STEP-wise known bytes on its sides
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes at each place."""
    h, factor, width = data.astype(np.uint64) + np.uint64(1), _FACTOR, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n = len(x) - width + 1
    pad = -len(x) % width
    rows = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def anchor_runs(data: bytes, starts: np.ndarray, ends: np.ndarray) -> list[tuple]:
    """(text number, anchor, context, left, right, start, n, offset of the anchor) of all windows inside texts.

    ``data`` holds texts one after the other; ``start`` counts from the text's start.
    """
    if len(data) < LENGTH:
        return []
    buffer = np.frombuffer(data, np.uint8)
    hashes = _gram_hashes(buffer)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_min((hashes & ~_PLACE) | (_PLACE - places), LENGTH - GRAM + 1)
    anchor = (_PLACE - (least & _PLACE)).astype(np.int64)
    owner = np.full(len(anchor), -1, np.int64)
    for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist())):
        if e - s >= LENGTH:
            owner[s:e - LENGTH + 1] = i
    change = np.flatnonzero((anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change, [len(anchor)]))
    real = owner[first] >= 0
    first, last = first[real], last[real]
    own, at = owner[first], anchor[first]
    digest, rows = xxhash.xxh3_64_intdigest, []
    signed = hashes.view(np.int64)[at].tolist()
    for i, a, p, q, s, e, h in zip(own.tolist(), at.tolist(), first.tolist(), last.tolist(),
                                   starts[own].tolist(), ends[own].tolist(), signed):
        left = digest(data[a - SIDE:a]) >> 1 if a - SIDE >= s else None
        right = digest(data[a + GRAM:a + GRAM + SIDE]) >> 1 if a + GRAM + SIDE <= e else None
        rows.append((i, h, digest(data[p:q - 1 + LENGTH]) >> 1, left, right, p - s, q - p, a - p))
    return rows


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "hash", "anchor", "context", "left", "right", "start", "n", "at"]

    def rows(texts: list[tuple]) -> pa.RecordBatch:
        data = b"".join(t[2] for t in texts)
        ends = np.cumsum([len(t[2]) for t in texts])
        starts = ends - [len(t[2]) for t in texts]
        found = anchor_runs(data, starts, ends)
        columns = list(zip(*found)) if found else [()] * 8
        keys = [[texts[i][k] for i in columns[0]] for k in (0, 1)]
        shifted = [p + texts[i][3] for i, p in zip(columns[0], columns[5])]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in (*keys, *columns[1:5], shifted, *columns[6:])], names)

    for batch in batches:
        waiting, size = [], 0
        for doc_id, key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            data = (value.as_py() or "").encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(data) - LENGTH + 1), BUFFER):
                part = data[at:at + BUFFER + LENGTH - 1]
                if len(part) >= LENGTH:
                    waiting.append((doc_id, key, part, at))
                    size += len(part)
                if size >= BUFFER // 2:
                    yield rows(waiting)
                    waiting, size = [], 0
        if waiting:
            yield rows(waiting)


def sorted_suffixes(data: np.ndarray, depth: int = 64) -> np.ndarray:
    """Suffixes of a shard in order of their first ``depth`` symbols, by prefix doubling."""
    rank = data.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step, n = 1, len(data)
    while step < depth:
        then = np.zeros(n, np.int64)
        then[:n - step] = rank[step:] + 1
        key = rank * (n + 257) + then
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        step *= 2
    return order


def repeated_windows(contexts: list[bytes], groups: list[int], owned: list[int]) -> list[np.ndarray]:
    """For each context, which of its first ``owned`` windows occur in another of its group."""
    lengths = np.array([len(c) + 1 for c in contexts])
    data = np.frombuffer(bytes([SEPARATOR]) + b"".join(c + bytes([SEPARATOR]) for c in contexts), np.uint8)
    begin = np.cumsum(lengths) - lengths + 1
    # shards of whole contexts, each with its suffix order and transform
    cut = [0, *np.flatnonzero(np.diff((begin - 1) // SHARD)) + 1]
    bounds = [0, *[int(begin[i]) for i in cut[1:]], len(data)]
    suffix = np.concatenate([sorted_suffixes(data[a:b]) + a for a, b in zip(bounds, bounds[1:])])
    rank = np.empty(len(data), np.int32)
    rank[suffix] = np.arange(len(data))
    before = suffix - WIDE  # the texts form a ring
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(
        np.concatenate((data, data[:WIDE - 1])), WIDE)).view(np.uint64).ravel()
    transform = np.unique(words[before], return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
    back = rank[before]
    # interleave: suffixes by shard and rank, one class for each group
    group = np.repeat(np.asarray(groups), lengths)
    group = np.concatenate((group[:1], group))[suffix]
    line = np.argsort(group, kind="stable").astype(np.int32)
    kind = group[line].astype(np.int32)
    for _ in range(LENGTH // WIDE):
        # sorted by symbol, and stably so by the place in the line
        key = np.sort(transform[line] | np.arange(len(line), dtype=np.uint64))
        order = (key & _LOW).astype(np.int32)
        line, kind, symbol = back[line[order]], kind[order], key >> np.uint64(32)
        new = np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (kind[1:] != kind[:-1]), [True]))
        together = ~(new[:-1] & new[1:])
        kind = np.cumsum(new[:-1], dtype=np.int32)[together]
        line = line[together]
        if not len(line):
            break
    place = suffix[line]
    mine = np.zeros(len(data), bool)
    for b, n in zip(begin.tolist(), owned):
        mine[b:b + n] = True
    place, kind = place[mine[place]], kind[mine[place]]
    several = np.zeros(len(data), bool)
    if len(place):
        counts = np.bincount(kind)
        several[place[counts[kind] > 1]] = True
    return [several[b:b + n] for b, n in zip(begin.tolist(), owned)]


def _alike(rows: list[tuple]) -> list[tuple]:
    """Contexts of a group that agree with another one in all but less than STEP bytes of a window."""
    seen: dict[tuple, int] = {}
    keys = []
    for *_, at, data in rows:
        own = []
        for left in range(0, LENGTH - GRAM + 1, STEP):
            end = at + GRAM + max(0, LENGTH - GRAM - left - STEP)
            if left <= at and end <= len(data):
                own.append((left, xxhash.xxh3_64_intdigest(data[at - left:end])))
        for k in own:
            seen[k] = seen.get(k, 0) + 1
        keys.append(own)
    return [r for r, own in zip(rows, keys) if any(seen[k] > 1 for k in own)]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups arrive whole, one after the other; several are merged at a time."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        ids: dict = {}
        groups = [ids.setdefault(r[0], len(ids)) for r in rows]
        out = []
        for r, flags in zip(rows, repeated_windows([r[6] for r in rows], groups, [r[4] for r in rows])):
            edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
            out += [(r[1], r[2], r[3] + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]
        columns = list(zip(*out)) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "hash", "start", "n"])

    waiting, size, group = [], 0, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(zip(*columns[:5]), *columns[5:]):
            if group and group[0][0] != row[0]:
                kept = _alike(group)
                waiting += kept
                size += sum(len(r[6]) for r in kept)
                group = []
            if size >= BATCH:
                yield solve(waiting)
                waiting, size = [], 0
            group.append(row)
    waiting += _alike(group)
    if waiting:
        yield solve(waiting)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids, _, texts, runs = (c.to_pylist() for c in batch.columns)
        rows = []
        for doc_id, text, found in zip(doc_ids, texts, runs):
            data = text.encode("utf-8", "surrogatepass")
            kept, at, removed, spans, end = hashlib.sha256(), 0, 0, 0, 0
            for start, n in sorted((r["start"], r["n"]) for r in found):
                if start > end or not spans:
                    kept.update(data[end:start])
                    spans += 1
                    end = start
                stop = max(end, start + n - 1 + LENGTH)
                removed += stop - end
                end = stop
            kept.update(data[end:])
            rows.append((doc_id, len(data), removed, spans, kept.hexdigest()))
        columns = list(zip(*rows)) if rows else [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, one row per input row."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    ddl = ", ".join(f"{c} long" for c in ("doc_id", "hash", "anchor", "context", "left", "right", "start", "n", "at"))
    runs = written(texts.where(F.octet_length("text") >= LENGTH).mapInArrow(_anchors, ddl), "repeat-runs")
    # aggregates that are joined back are written first: a join of two plain shuffles can split a frequent key
    often = written(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "repeat-often")
    shared = written(runs.join(often, "anchor"), "repeat-shared")
    one = F.min(F.struct("doc_id", "hash", "start", "n", "at", "left", "right"))
    classes = written(shared.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("copies"), one.alias("one")), "repeat-classes")
    whole = shared.join(classes.where("copies > 1").select("anchor", "context"), ["anchor", "context"]).select(
        "doc_id", "hash", "start", "n")

    sides = classes.select("anchor", "context", "copies", "one", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("one.left").alias("value")),
        F.struct(F.lit(1).alias("side"), F.col("one.right").alias("value")))).alias("s")).select(
        "anchor", "context", "copies", "one", "s.*").where("value is not null")
    keys = ["anchor", "side", "value"]
    met = written(sides.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.min("copies").alias("fewest")).where(
        "m > 1 and fewest = 1").drop("fewest"), "repeat-sides")
    met = written(sides.join(met, keys).select(
        *keys, "m", "context", "one.doc_id", "one.hash", "one.start", "one.n", "one.at"), "repeat-met")
    # an anchor with few contexts is one group; else those that agree on a side are
    crowded = written(met.groupBy("anchor").agg(F.count(F.lit(1)).alias("all")).where(F.col("all") > GROUP).select("anchor"), "repeat-crowded")
    few = met.join(crowded, "anchor", "left_anti").select(
        "anchor", F.lit(-1).alias("side"), F.lit(0).cast("long").alias("value"), F.lit(1).cast("long").alias("m"),
        "context", "doc_id", "hash", "start", "n", "at").distinct()
    blocks = F.ceil(F.col("m") / GROUP)
    asked = written(few.union(met.join(crowded, "anchor", "left_semi").select(few.columns)).select(
        *keys, "doc_id", "hash", "start", "n", "at", blocks.alias("blocks"),
        F.pmod(F.xxhash64("context"), blocks).alias("block")), "repeat-asked")

    spots = whole.select("doc_id", "hash", F.struct("start", "n").alias("run"), F.lit(None).cast(
        "struct<start:bigint,n:bigint>").alias("ask"))
    wanted = asked.select("doc_id", "hash", "start", "n").distinct().select(
        "doc_id", "hash", F.lit(None).cast("struct<start:bigint,n:bigint>").alias("run"), F.struct("start", "n").alias("ask"))
    noted = spots.union(wanted).groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(
        F.collect_list("run").alias("runs"), F.collect_list("ask").alias("asks"))
    on = texts["doc_id"].eqNullSafe(noted["d"]) & (texts["hash"] == noted["h"])
    body = F.coalesce("text", F.lit(""))
    table = written(texts.join(noted.hint("shuffle_hash"), on, "left").select(
        "doc_id", "hash", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("sha"),
        F.when(F.col("h").isNotNull(), F.col("text")).alias("text"), "runs", "asks"), "repeat-texts")

    touched = table.where("text is not null")
    cut = touched.where(F.size("asks") > 0).dropDuplicates(["doc_id", "hash"]).select("doc_id", "hash", F.explode("asks").alias("ask"), "text").select(
        "doc_id", "hash", F.col("ask.start").alias("start"),
        F.substring(F.encode("text", "UTF-8"), F.col("ask.start").cast("int") + 1, F.col("ask.n").cast("int") + LENGTH - 1).alias("bytes"))
    pairs = asked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumns({
        "low": F.least("block", "other"), "high": F.greatest("block", "other")})
    place = [pairs["doc_id"].eqNullSafe(cut["doc_id"]), pairs["hash"] == cut["hash"], pairs["start"] == cut["start"]]
    contexts = pairs.join(cut, place).select(
        "anchor", "side", "value", "low", "high", cut["doc_id"], cut["hash"], cut["start"], "n", "at", "bytes")
    group = ["anchor", "side", "value", "low", "high"]
    parts = contexts.repartition(*group).sortWithinPartitions(*group)
    found = written(parts.mapInArrow(_merged, "doc_id long, hash long, start long, n long").distinct(), "repeat-found")

    more = found.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(F.collect_list(F.struct("start", "n")).alias("more"))
    on = touched["doc_id"].eqNullSafe(more["d"]) & (touched["hash"] == more["h"])
    ready = touched.join(more.hint("shuffle_hash"), on, "left").select(
        "doc_id", "hash", "text", F.when(F.col("more").isNull(), F.col("runs")).otherwise(F.concat("runs", "more")).alias("runs"))
    clean = ready.mapInArrow(_cleaned, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    rest = table.where("text is null").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sha").alias("kept_sha256"))
    return clean.union(rest)
