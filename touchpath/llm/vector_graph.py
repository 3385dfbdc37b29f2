"""Near-duplicate vectors by robust-pruned graphs on overlapping cluster shards.

1. Exact copies collapse into classes; everything below works on distinct vectors.
2. Cluster centres are fitted on a bounded sample (``SAMPLE`` vectors); their number
   follows the number of vectors. Every vector goes to its ``overlap`` nearest clusters.
   A cluster beyond ``SHARD`` members is divided into blocks, and each pair of blocks is a
   shard, so no task holds more than two blocks and no pair is lost.
3. In each shard every vector gets its nearest others, robustly pruned (a candidate goes
   if a chosen neighbour is much closer to it than the vector is). The adjacency lists of
   a vector are united over all its shards.
4. Each vector is searched for in its shards: greedily with a beam along the united lists
   and their reverse links, from itself and from the medoid of every connected part of the
   lists, so a dense group cannot hide the rest. Then the range is widened along all links
   that stay within the cosine, until nothing new is found. A shard holds the cosines of
   all its vectors; where the search fell short of them, the exact comparison is taken.
   What is reported is verified in double precision.
5. Recall is audited against brute force for a bounded set of distinct vectors (those with
   an id divisible by 100, at most ``AUDIT``), as found over exact per vector, averaged over
   vectors with a link; copies do not count. If it is below ``RECALL`` the graph is built
   with more overlap, and after the last overlap every two blocks are compared.

A pair that several shards could find is counted in the first of them only, which is
complete by step 4. Shards return sums per vector and links to a local root, never pairs.

Vectors that are NULL, empty, zero or hold NULL, NaN or infinite components link with
nothing. Vectors of different length do not link. Rows with a NULL id link with nothing
and have a NULL component. Rows with equal ids are separate vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import components, written

COSINE, RECALL = 0.95, 0.97
SAMPLE, PER_CLUSTER, MAX_CLUSTERS, SHARD = 20_000, 400, 4096, 1200
CANDIDATES, DEGREE, ALPHA, BEAM = 48, 24, 1.2, 32
AUDIT, SLACK = 1000, 1e-9


def centres(sample: np.ndarray, k: int, seed: int = 0, rounds: int = 8) -> np.ndarray:
    """Spherical k-means centres of unit vectors."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        at = np.argmax(sample @ found.T, axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, at, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 0, sums / np.maximum(length, 1e-300), found)
    return found


def robust_prune(sims: np.ndarray) -> np.ndarray:
    """DEGREE neighbours of each vector, -1 where there are fewer, from all cosines."""
    n = len(sims)
    c = min(CANDIDATES, n - 1)
    if c < 1:
        return np.full((n, 1), -1)
    own = sims.copy()
    np.fill_diagonal(own, -np.inf)
    near = np.argpartition(-own, c - 1, axis=1)[:, :c]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(own, near, 1), axis=1, kind="stable"), 1)
    away = np.maximum(2 - 2 * np.take_along_axis(sims, near, 1), 0)
    alive = np.ones(near.shape, bool)
    rows = np.arange(n)
    chosen = np.full((n, DEGREE), -1)
    for r in range(min(DEGREE, c)):
        first = np.argmax(alive, axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        pick = near[rows, first]
        chosen[some, r] = pick[some]
        between = np.maximum(2 - 2 * sims[pick[:, None], near], 0)
        alive &= ~((ALPHA * ALPHA * between <= away) & some[:, None])
        alive[rows, first] = False
    return chosen


def _padded(lists: list[np.ndarray]) -> np.ndarray:
    width = max((len(x) for x in lists), default=0) or 1
    out = np.full((len(lists), width), -1)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _entries(sims: np.ndarray, link: np.ndarray) -> np.ndarray:
    """The medoid of each connected part of a symmetric graph."""
    n = len(sims)
    part = np.arange(n)
    i, j = np.nonzero(link)
    while True:
        low = part.copy()
        np.minimum.at(low, i, part[j])
        low = low[low]
        if (low == part).all():
            break
        part = low
    total = sims.sum(axis=1)
    order = np.lexsort((-total, part))
    return order[np.concatenate(([True], part[order][1:] != part[order][:-1]))]


def range_search(sims: np.ndarray, lists: np.ndarray, cosine: float) -> np.ndarray:
    """Which vectors each vector finds within the cosine, as a boolean matrix."""
    n = len(sims)
    rows = np.arange(n)
    link = np.zeros((n, n), np.float32)
    i, j = np.nonzero(lists >= 0)
    link[i, lists[i, j]] = 1
    link = np.maximum(link, link.T)
    entries = _entries(sims, link)
    lists = _padded([np.flatnonzero(x) for x in link])
    seen = np.eye(n, dtype=bool)
    seen[:, entries] = True
    beam = np.full((n, BEAM), -1)
    score = np.full((n, BEAM), -np.inf)
    best = entries[np.argsort(-sims[:, entries], axis=1, kind="stable")[:, :BEAM - 1]]
    best = np.where(best == rows[:, None], -1, best)
    beam[:, 0], beam[:, 1:1 + best.shape[1]] = rows, best
    score[:, 0], score[:, 1:1 + best.shape[1]] = sims[rows, rows], np.where(best >= 0, sims[rows[:, None], best], -np.inf)
    opened = np.zeros((n, BEAM), bool)
    while True:
        open_score = np.where(opened | (beam < 0), -np.inf, score)
        best = np.argmax(open_score, axis=1)
        active = open_score[rows, best] > -np.inf
        if not active.any():
            break
        opened[rows[active], best[active]] = True
        a = rows[active]
        next_ = lists[beam[a, best[a]]]
        new = (next_ >= 0) & ~seen[a[:, None], next_]
        seen[a[:, None].repeat(next_.shape[1], 1)[new], next_[new]] = True
        value = np.where(new, sims[a[:, None], next_], -np.inf)
        ids = np.concatenate((beam[a], np.where(new, next_, -1)), 1)
        values = np.concatenate((score[a], value), 1)
        flags = np.concatenate((opened[a], np.zeros(next_.shape, bool)), 1)
        top = np.argpartition(-values, BEAM - 1, axis=1)[:, :BEAM]
        beam[a], score[a], opened[a] = (np.take_along_axis(x, top, 1) for x in (ids, values, flags))
    within = sims >= cosine
    found = seen & within
    while True:
        more = (found.astype(np.float32) @ link > 0) & within & ~found
        if not more.any():
            break
        found |= more
    found |= found.T
    np.fill_diagonal(found, False)
    return found


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    x = _unit(part["vector"])
    lists = robust_prune(x @ x.T)
    ids = part["cid"].to_numpy()
    return pd.DataFrame({"cid": ids, "near": [ids[row[row >= 0]].tolist() for row in lists]})


def _search(cosine: float):
    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        cluster, low, high = key[1], key[2], key[3]
        x, ids, copies = _unit(part["vector"]), part["cid"].to_numpy(), part["copies"].to_numpy()
        order = np.argsort(ids)
        ordered = ids[order]

        def local(near) -> np.ndarray:
            near = np.unique(np.concatenate([np.asarray(n, np.int64) for n in near])) if len(near) else np.zeros(0, np.int64)
            at = np.minimum(np.searchsorted(ordered, near), len(ordered) - 1)
            return order[at[ordered[at] == near]]
        sims = x @ x.T
        found = range_search(sims, _padded([local(n) for n in part["near"]]), cosine - SLACK)
        within = sims >= cosine - SLACK
        if (within & ~found).sum() > len(ids):  # beyond the diagonal
            found = within
        a, b = np.nonzero(np.triu(found, 1))
        exact = np.einsum("ij,ij->i", x[a], x[b]) >= cosine - 1e-15
        a, b = a[exact], b[exact]
        # counted here if no earlier cluster has both, and by blocks
        clusters, block = _padded([np.asarray(c) for c in part["clusters"]]), part["block"].to_numpy()
        both = (clusters[a][:, :, None] == clusters[b][:, None, :]) & (clusters[a] >= 0)[:, :, None]
        common = np.where(both, clusters[a][:, :, None], np.iinfo(np.int64).max).min(axis=(1, 2)) if len(a) else a
        mine = (common == cluster) & ((block[a] != block[b]) if low != high else np.ones(len(a), bool))
        a, b = a[mine], b[mine]
        links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
        root = np.arange(len(ids))
        while True:
            low_root = root.copy()
            np.minimum.at(low_root, a, root[b])
            np.minimum.at(low_root, b, root[a])
            low_root = low_root[low_root]
            if (low_root == root).all():
                break
            root = low_root
        near = np.bincount(a, minlength=len(ids)) + np.bincount(b, minlength=len(ids))
        return pd.DataFrame({"cid": ids, "links": links.astype(np.int64), "near": near, "root": ids[root]})
    return search


def _prepared(embeddings: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    fine = F.coalesce(fine & F.col(vec_id).isNotNull(), F.lit(False))
    return written(embeddings.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.when(fine, v).alias("vector")), "vectors")


def _linked(classes: DataFrame, count: int, overlap: int | None, cosine: float) -> DataFrame:
    """(cid, links, near, root) partial results of all shards; without overlap, of all pairs of blocks."""
    spark = classes.sparkSession
    sample = classes.select("vector", F.xxhash64("cid").alias("h")).orderBy("h").limit(SAMPLE).toPandas()
    k = min(MAX_CLUSTERS, max(1, math.ceil(count / PER_CLUSTER))) if overlap else 1
    by_length = {}
    for length, part in sample.groupby(sample["vector"].map(len)):
        by_length[int(length)] = centres(_unit(part["vector"]), max(1, round(k * len(part) / len(sample))))
    shared = spark.sparkContext.broadcast(by_length)

    def place(parts):
        for part in parts:
            clusters = []
            for v in part["vector"]:
                c = shared.value.get(len(v))
                if c is None:  # a length the sample has not seen is one cluster
                    clusters.append([0])
                    continue
                s = c @ _unit(pd.Series([v]))[0]
                clusters.append(np.argsort(-s, kind="stable")[:overlap].tolist())
            yield part.assign(clusters=clusters)

    placed = written(classes.mapInPandas(place, "cid long, vector array<double>, copies long, clusters array<long>"), "vector-places")
    each = placed.select("*", F.size("vector").alias("length"), F.explode("clusters").alias("cluster"))
    sizes = each.groupBy("length", "cluster").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("blocks"))
    split = each.join(sizes, ["length", "cluster"]).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    members = written(split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "length", "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "cid", "copies", "clusters", "vector"), "vector-shards")
    shard = ["length", "cluster", "low", "high"]
    lists = members.groupBy(*shard).applyInPandas(_build, "cid long, near array<long>")
    united = lists.groupBy("cid").agg(F.collect_set("near").alias("near"))
    return members.join(united, "cid").groupBy(*shard).applyInPandas(_search(cosine), "cid long, links long, near long, root long")


def _result(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")), "vector-components")
    named = classes.select("cid", "least").join(joined, classes["cid"] == joined["node"], "left").withColumn(
        "component", F.coalesce("component", "cid"))
    names = named.groupBy("component").agg(F.min("least").alias("name"))
    known = named.join(names, "component").join(sums, "cid", "left").select("cid", "name", "links")
    full = classes.select("cid", "copies", "vector").join(known, "cid").select(
        "vector", "name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = rows.join(full, "vector", "left")
    component = F.coalesce("name", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def brute_links(classes: DataFrame, cosine: float = COSINE, limit: int = AUDIT) -> DataFrame:
    """(cid, exact) other distinct vectors within the cosine by brute force, for at most ``limit`` audited ones."""
    asked = classes.where("audited").select("cid", "vector").orderBy(F.xxhash64("cid")).limit(limit).toPandas()
    asked = asked.assign(length=asked["vector"].map(len)) if len(asked) else asked.assign(length=[])
    groups = {int(n): (g["cid"].to_numpy(), _unit(g["vector"])) for n, g in asked.groupby("length")}
    shared = classes.sparkSession.sparkContext.broadcast(groups)

    def count(parts):
        for part in parts:
            for length, some in part.groupby(part["vector"].map(len)):
                if length in shared.value:
                    own, x = shared.value[length]
                    hit = (x @ _unit(some["vector"]).T >= cosine) & (own[:, None] != some["cid"].to_numpy())
                    yield pd.DataFrame({"cid": own, "exact": hit.sum(axis=1)})

    counted = classes.select("cid", "vector").mapInPandas(count, "cid long, exact long")
    return counted.groupBy("cid").agg(F.sum("exact").alias("exact"))


def recall(exact: DataFrame, found: DataFrame) -> float | None:
    """Found over exact distinct neighbours, averaged over the audited vectors that have one."""
    near = exact.where("exact > 0").join(found.select("cid", "near"), "cid", "left").groupBy("cid", "exact").agg(
        F.coalesce(F.sum("near"), F.lit(0)).alias("near"))
    return near.agg(F.avg(F.least("near", "exact") / F.col("exact"))).first()[0]


def near_vectors(
    embeddings: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per input row."""
    rows = _prepared(embeddings, vec_id, vector)
    classes = written(rows.where("vector is not null").groupBy("vector").agg(
        F.min("row").alias("cid"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"),
        F.max(F.col("vec_id") % 100 == 0).alias("audited")), "vector-classes")
    count = classes.count()
    exact = written(brute_links(classes, cosine), "vector-audit")
    for overlap in (2, 4, 8, None):
        found = written(_linked(classes.select("cid", "vector", "copies"), count, overlap, cosine) if count else (
            classes.select("cid", F.col("copies").alias("links"), F.col("copies").alias("near"), F.col("cid").alias("root"))), "vector-links")
        share = recall(exact, found)
        if share is None or share >= RECALL:
            break
    return written(_result(rows, classes, found), "vector-result")
