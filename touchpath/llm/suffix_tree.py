"""Language-model scores from a probabilistic suffix tree.

The model reads a text as the bytes of its lower-cased words with one space between them,
between a start and an end mark. Next-symbol counts after every context of up to
``DEPTH`` symbols are gathered from all training texts. A context is a state of the tree if
it occurs at least ``min_count`` times and passes the divergence test: its next-symbol
distribution must differ from that of its suffix by more nats (times its count) than chance
gives for so many different next symbols. A state's distribution is smoothed with that of its
longest suffix that is a state, by Witten and Bell; the empty context, smoothed evenly over the
bytes, is always one. A text is scored symbol by symbol from the longest suffix of what was
read that is a state; the product over all symbols is the probability of its words and end.

Nothing else bounds the tree, which grows with the corpus, so it is a table that no task or
driver holds:

1. One pass over the texts makes chunks of at most ``CHUNK_KEYS`` distinct (context, symbol)
   keys (or one text), with each key once and its training count, and keeps the texts' symbols.
   Tasks of less than ``TASK_BYTES`` of text are joined as far as all cores stay busy, since
   fewer chunks repeat fewer keys. A chunk's keys are dealt to buckets by their context without
   its ``STEP`` earliest symbols; one row packs those of a chunk and bucket. There is a bucket
   for each ``BUCKET_BYTES`` of text, so it holds at most that many keys, or those of one
   context two symbols shorter, 256 ** 3 by construction.
2. Each bucket sums its keys over chunks; held-out ones come with count 0. Probabilities are
   found two symbols of context at a time. Those of shorter contexts are rows: keys of one context
   two symbols shorter are in one group, together with the probabilities after that context.
   Those of the longest contexts, the bulk, are found bucket by bucket.
3. Each bucket hands every chunk the probabilities of its keys, which meet the symbols of the
   chunk's texts. Logarithms travel there with 24 bits, which leaves a score its first seven
   digits.

Word counts of the baseline are looked up like token counts: words with at least
``WORD_SHARE`` of all occurrences in the task, all others by a join.

Training texts are those whose crc32 of the id as text is not 1 modulo 5; a NULL id counts
as the empty text. NULL and empty texts are the end alone. Equal rows count one by one.
With no training text every symbol has the same probability. U+0000 is a symbol like others.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import written

DEPTH, STEP, MIN_COUNT, WORD_SHARE = 6, 2, 2, 5e-7
FOLDS, HELD_FOLD = 5, 1
MARK = b"\n"  # start and end; no word contains it
PAD = 0xFF  # before the start; no byte of UTF-8
SYMBOLS = 256
CHUNK_KEYS, TASK_BYTES, BUCKET_BYTES = 1 << 22, 1 << 27, 1 << 24
_FOLD, _FLUSH, _ROWS, _SENT, _BLOCK = 1 << 21, 1 << 19, 1 << 20, 1 << 16, 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _stream(words: list[bytes]) -> bytes:
    return bytes([PAD]) * DEPTH + MARK + b" ".join(words) + MARK


def _keys(stream: np.ndarray) -> np.ndarray:
    """For each symbol: the DEPTH symbols before it, latest first, then itself, in one integer."""
    n = len(stream) - DEPTH
    keys = stream[DEPTH:].astype(np.int64)
    for d in range(1, DEPTH + 1):
        symbol = stream[DEPTH - d:DEPTH - d + n].astype(np.int64)
        symbol <<= 8 * (DEPTH + 1 - d)
        keys |= symbol
    return keys


def _predicted(keys: np.ndarray) -> np.ndarray:
    """Whether a key's symbol counts: it is no padding and has a symbol before it."""
    return ((keys & 255) != PAD) & (((keys >> 8 * DEPTH) & 255) != PAD)


def _mask(depth: int) -> int:
    return ((1 << 8 * depth) - 1) << (8 * (DEPTH + 1 - depth))


class _Counts:
    """The distinct keys of a chunk's texts and how often each occurs in training texts."""

    def __init__(self) -> None:
        self.parts: tuple[list[bytes], list[bytes]] = ([], [])
        self.size = 0
        self.keys, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, stream: bytes, train: bool) -> None:
        self.parts[train].append(stream)
        self.size += len(stream)
        if self.size > _FOLD:
            self.fold()

    def fold(self) -> None:
        for train, parts in enumerate(self.parts):
            stream = np.frombuffer(b"".join(parts), np.uint8)
            parts.clear()
            for at in range(0, len(stream) - DEPTH, _FOLD):
                keys = _keys(stream[at:at + _FOLD + DEPTH])
                new, n = np.unique(keys[_predicted(keys)], return_counts=True)
                self._merge(new, n * train)
        self.size = 0

    def _merge(self, new: np.ndarray, n: np.ndarray) -> None:
        at = np.searchsorted(self.keys, new)
        known = np.zeros(len(new), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == new[inside]
        self.n[at[known]] += n[known]
        self.keys, self.n = np.insert(self.keys, at[~known], new[~known]), np.insert(self.n, at[~known], n[~known])


def _firsts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, int)


def _pack(values: np.ndarray) -> bytes:
    """All first bytes, all second ones and so on, compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return _pack(np.diff(keys, prepend=0))


def _unpack_keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpack(packed, np.int64))


def _dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket and where its keys are; keys of one context of DEPTH - STEP symbols share one."""
    context = (keys >> (8 * (STEP + 1))).view(np.uint64)
    context *= _ODD
    context >>= np.uint64(32)
    bucket = (context % np.uint64(buckets)).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    first = _firsts(bucket[order])
    for a, b in zip(first, [*first[1:], len(keys)]):
        yield int(bucket[order[a]]), order[a:b]


def _fold() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


READ = "doc_id array<long>, held_out array<boolean>, row array<long>, length array<long>, chunk long, streams binary, word binary, n long, bucket long, keys binary, counts binary"
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64(),
          "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}


def _batch(schema: str, size: int, **columns) -> pa.RecordBatch:
    """A batch of ``schema``; columns not given are NULL."""
    fields = [f.split() for f in schema.split(", ")]
    def column(name: str, kind: pa.DataType) -> pa.Array:
        values = columns.get(name)
        if values is None:
            return pa.nulls(size, kind)
        return values if isinstance(values, pa.Array) else pa.array(values, kind)

    return pa.RecordBatch.from_arrays([column(name, _ARROW[kind]) for name, kind in fields], [name for name, _ in fields])


def read(docs: DataFrame, buckets: int, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """One table of three kinds of rows: blocks of texts as symbols (``streams``), training words, keys by chunk and bucket.

    A chunk is named by task and number; the table has to be written before it is used twice.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, words, counts = TaskContext.get().partitionId() << 32, Counter(), _Counts()

        def keys() -> Iterator[pa.RecordBatch]:
            counts.fold()
            rows = [(bucket, _pack_keys(counts.keys[at]), _pack(counts.n[at])) for bucket, at in _dealt(counts.keys, buckets)]
            for a in range(0, len(rows), _SENT):
                bucket, key, n = zip(*rows[a:a + _SENT])
                yield _batch(READ, len(key), chunk=[chunk] * len(key), bucket=bucket, keys=key, counts=n)

        def counted_words() -> Iterator[pa.RecordBatch]:
            found = list(words.items())
            for a in range(0, len(found), _SENT):
                word, n = zip(*found[a:a + _SENT])
                yield _batch(READ, len(word), word=word, n=n)

        for batch in batches:
            block, size = [], 0

            def texts() -> pa.RecordBatch:
                doc_id, held, row, streams = zip(*block)
                return _batch(READ, 1, doc_id=[doc_id], held_out=[held], row=[row], length=[[len(x) for x in streams]],
                              chunk=[chunk], streams=[zstandard.compress(b"".join(streams), 1)])

            for doc_id, text, held, row in zip(*batch.columns):
                found, held = _words(text.as_py()), held.as_py()
                if not held:
                    words.update(found)
                    words[MARK] += 1
                stream = _stream(found)
                block.append((doc_id.as_py(), held, row.as_py(), stream))
                size += len(stream)
                counts.add(stream, not held)
                full = len(counts.keys) > chunk_keys
                if full or size > _BLOCK:
                    yield texts()
                    block, size = [], 0
                if full:
                    yield from keys()
                    chunk, counts = chunk + 1, _Counts()
                if len(words) > _FLUSH:
                    yield from counted_words()
                    words.clear()
            if block:
                yield texts()
        yield from counted_words()
        yield from keys()

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (_fold() == HELD_FOLD).alias("held_out"),
        F.monotonically_increasing_id().alias("row"),
    ).mapInArrow(chunks, READ)


def _deepened(keys: np.ndarray, n: np.ndarray, above: np.ndarray, q: np.ndarray, p: np.ndarray, depth: int, min_count: int):
    """Sorted keys of ``depth`` with their raw and smoothed probabilities.

    ``above`` are the sorted keys STEP symbols shorter, with raw ``q`` and smoothed ``p``.
    """
    if not len(keys):
        return keys, np.zeros(0), np.zeros(0)
    for d in range(depth - STEP + 1, depth + 1):
        entries, entry_of = np.unique(keys & (_mask(d) | 255), return_inverse=True)
        times = np.bincount(entry_of, n)
        contexts = entries & _mask(d)
        first = _firsts(contexts)
        of = np.repeat(np.arange(len(first)), np.diff([*first, len(entries)]))
        total, kinds = np.add.reduceat(times, first), np.add.reduceat((times > 0).astype(float), first)
        at = np.searchsorted(above, entries & (_mask(d - 1) | 255))
        raw = times / np.maximum(total, 1)[of]
        seen = times > 0
        gain = np.zeros(len(entries))
        gain[seen] = times[seen] * np.log(raw[seen] / q[at][seen])
        whole = (contexts[first] >> (8 * (DEPTH + 1 - d))) & 255 != PAD
        state = whole & (total >= min_count) & (np.add.reduceat(gain, first) > kinds)
        smoothed = (times + kinds[of] * p[at]) / np.maximum(total + kinds, 1)[of]
        above, q, p = entries, raw, np.where(state[of], smoothed, p[at])
    return above, q, p


def probabilities(keys: DataFrame, min_count: int = MIN_COUNT, longest: int = DEPTH) -> DataFrame:
    """(key, q, p) for (key, n): p of each key's symbol after its longest context that is a state.

    q is the probability as counted. Keys have contexts of ``longest`` symbols; those with n = 0
    get a probability but take no part in the model.
    """
    symbol = F.col("key").bitwiseAND(F.lit(255))
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    level = keys.groupBy(symbol.alias("key")).agg(F.sum("n").alias("n")).select(
        "key", (F.col("n") / F.lit(float(max(total, 1)))).alias("q"),
        ((F.col("n") + 0.5) / F.lit(total + 0.5 * SYMBOLS)).alias("p"))
    for depth in range(STEP, longest + 1, STEP):
        longer = keys if depth == longest else keys.groupBy(
            F.col("key").bitwiseAND(F.lit(_mask(depth) | 255)).alias("key")).agg(F.sum("n").alias("n"))
        level = written(_longer(longer, level, depth, min_count), "tree-level", compression="zstd")
    return level


def _longer(keys: DataFrame, shorter: DataFrame, depth: int, min_count: int) -> DataFrame:
    group = _mask(depth - STEP)
    result = "key long, q double, p double"

    def deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def found(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            key, n, q, p = rows
            above = n < 0
            key, q, p = _deepened(key[~above], n[~above], key[above], q[above], p[above], depth, min_count)
            for a in range(0, len(key), _SENT):
                b = a + _SENT
                yield _batch(result, len(key[a:b]), key=key[a:b], q=q[a:b], p=p[a:b])

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size > _ROWS:
                rows = [np.concatenate(c) for c in zip(*held)]
                # all rows of a group go together: the last group waits for the next batch
                cut = np.searchsorted(rows[0], rows[0][-1] & group)
                if cut:
                    yield from found([c[:cut] for c in rows])
                held, size = [[c[cut:] for c in rows]], len(rows[0]) - cut
        if held:
            yield from found([np.concatenate(c) for c in zip(*held)])

    rows = keys.select("key", "n", F.lit(0.0).alias("q"), F.lit(0.0).alias("p")).unionByName(
        shorter.select("key", F.lit(-1).cast("long").alias("n"), "q", "p"))
    return rows.repartition(F.col("key").bitwiseAND(F.lit(group))).sortWithinPartitions("key").mapInArrow(deepen, result)


def _rows_of_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of one bucket after the other, of batches sorted by bucket."""
    held = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["bucket"] != held[0]["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _summed(chunks: list[np.ndarray], rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of several chunks, ascending, and their counts."""
    keys, n = np.concatenate(chunks), np.concatenate([_unpack(r["counts"], np.int64) for r in rows])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = _firsts(keys)
    return keys[first], np.add.reduceat(n, first)


def _shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) of contexts without their STEP earliest symbols; all of such a context is in one bucket."""
    for rows in _rows_of_buckets(batches):
        keys, n = _summed([_unpack_keys(r["keys"]) for r in rows], rows)
        short, of = np.unique(keys & (_mask(DEPTH - STEP) | 255), return_inverse=True)
        n = np.bincount(of, n).astype(np.int64)
        for a in range(0, len(short), _SENT):
            yield _batch("key long, n long", len(short[a:a + _SENT]), key=short[a:a + _SENT], n=n[a:a + _SENT])


LEVEL = "bucket long, keys binary, q binary, p binary"


def _level_by_bucket(level: DataFrame, buckets: int) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            key, q, p = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(key)
            key, q, p = key[order], q[order], p[order]
            bucket, keys, qs, ps = zip(*[(b, _pack_keys(key[at]), _pack(q[at]), _pack(p[at])) for b, at in _dealt(key, buckets)])
            return _batch(LEVEL, len(keys), bucket=bucket, keys=keys, q=qs, p=ps)

        for batch in batches:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
            if size > _ROWS:
                yield packed()
                held, size = [], 0
        if size:
            yield packed()

    return level.select("key", "q", "p").mapInArrow(deal, LEVEL)


TABLES = "chunk long, keys binary, logs binary"


def tables(keys: DataFrame, level: DataFrame, buckets: int, tasks: int, min_count: int = MIN_COUNT) -> DataFrame:
    """For each chunk and bucket of ``keys`` the logarithms of its probabilities; ``level`` holds those of shorter contexts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_of_buckets(batches):
            above, rows = [r for r in rows if r["counts"] is None], [r for r in rows if r["counts"] is not None]
            short = np.concatenate([_unpack_keys(r["keys"]) for r in above])
            q, p = (np.concatenate([_unpack(r[name], np.float64) for r in above]) for name in "qp")
            order = np.argsort(short)
            chunks = [_unpack_keys(r["keys"]) for r in rows]
            key, _, p = _deepened(*_summed(chunks, rows), short[order], q[order], p[order], DEPTH, min_count)
            log = np.log10(p).astype(np.float32)
            logs = [_pack(log[np.searchsorted(key, c)]) for c in chunks]
            yield _batch(TABLES, len(rows), chunk=[r["chunk"] for r in rows], keys=[r["keys"] for r in rows], logs=logs)

    both = keys.unionByName(_level_by_bucket(level, buckets), allowMissingColumns=True)
    return both.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(find, TABLES)


class _Table:
    """The log10 probabilities of a chunk's keys, in a hash table with linear probing."""

    def __init__(self, keys: list[bytes], logs: list[bytes]) -> None:
        size = sum(zstandard.frame_content_size(k) for k in keys) // 8
        bits = max(4, (2 * size).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.logs = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.float32)
        for key, log in zip(keys, logs):
            self._put(_unpack_keys(key), _unpack(log, np.float32))

    def _put(self, key: np.ndarray, log: np.ndarray) -> None:
        slot = self._slots(key)
        while len(key):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = key[free]
            placed = self.keys[slot] == key
            self.logs[slot[placed]] = log[placed]
            left = ~placed
            key, log, slot = key[left], log[left], (slot[left] + 1) & self.last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _ODD) >> self.shift).view(np.int64)

    def found(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        missed = np.flatnonzero(self.keys[slot] != keys)
        while len(missed):
            if (self.keys[slot[missed]] < 0).any():
                raise KeyError("a text holds a key that its chunk lacks")
            slot[missed] = (slot[missed] + 1) & self.last
            missed = missed[self.keys[slot[missed]] != keys[missed]]
        return self.logs[slot]

    def scores(self, streams: bytes, length: list[int]) -> np.ndarray:
        """The sum over each stream; blocks bound what a long text takes."""
        symbols = np.frombuffer(streams, np.uint8)
        starts = np.maximum(np.cumsum([0, *length[:-1]]) - DEPTH, 0)
        total = np.zeros(len(length))
        for at in range(0, len(symbols) - DEPTH, _BLOCK):
            keys = _keys(symbols[at:at + _BLOCK + DEPTH])
            counts, logs = _predicted(keys), np.zeros(len(keys))
            logs[counts] = self.found(keys[counts])
            first, last = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(keys))
            total[first:last] += np.add.reduceat(logs, np.maximum(starts[first:last] - at, 0))
        return total


def scored(docs: DataFrame, min_count: int = MIN_COUNT, word_share: float = WORD_SHARE, chunk_keys: int = CHUNK_KEYS,
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per input row."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))
    buckets = max(4 * spark.sparkContext.defaultParallelism, math.ceil(size / bucket_bytes))
    prepared = written(read(docs.coalesce(tasks), buckets, chunk_keys), "lm-read", compression="zstd")
    words = written(prepared.where("word is not null").groupBy("word").agg(F.sum("n").alias("c")), "lm-words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    whole = float(n + 0.5 * (v + 1))
    often = F.col("c") >= word_share * n
    common = spark.sparkContext.broadcast({bytes(r[0]): r[1] for r in words.where(often).collect()})

    keys = prepared.where("keys is not null").select("bucket", "chunk", "keys", "counts")
    dealt = math.ceil(buckets / 4)
    short = keys.repartition(dealt, "bucket").sortWithinPartitions("bucket").select("bucket", "keys", "counts").mapInArrow(_shorter, "key long, n long")
    level = probabilities(written(short, "lm-keys", compression="zstd"), min_count, DEPTH - STEP)
    found = tables(keys, level, buckets, dealt, min_count)
    texts = prepared.where("streams is not null").select("chunk", "doc_id", "row", "held_out", "length", "streams")
    result = "doc_id long, row long, held_out boolean, n_tokens long, known long, base double, score double, rare map<binary,long>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = {w: float(np.log10((c + 0.5) / whole)) for w, c in common.value.items()}
        long = pa.int64()
        kinds = [long, long, pa.bool_(), long, long, pa.float64(), pa.float64(), pa.map_(pa.binary(), long)]
        names = [f.split()[0] for f in result.split(", ")]

        def texts_of(doc_ids: list, row_ids: list, held_out: list, length: list, streams: bytes, lm: _Table) -> pa.RecordBatch:
            rows, at = [], 0
            for doc_id, row, held, size, value in zip(doc_ids, row_ids, held_out, length, lm.scores(streams, length)):
                words = streams[at + DEPTH + 1:at + size - 1].split()
                at += size
                counted = Counter(words)
                counted[MARK] += 1
                base, rare = 0.0, {}
                for word, times in counted.items():
                    log = logs.get(word)
                    if log is None:
                        rare[word] = times
                    else:
                        base += log * times
                rows.append((doc_id, row, held, len(words) + 1, len(words) + 1 - sum(rare.values()), base, float(value), list(rare.items())))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        current, keys, values, lm = None, [], [], None
        for batch in batches:
            columns = {name: batch.column(name) for name in batch.schema.names}
            for i in range(batch.num_rows):
                streams = columns["streams"][i].as_py()
                if streams is None:
                    if columns["chunk"][i].as_py() != current:
                        current, keys, values = columns["chunk"][i].as_py(), [], []
                    keys.append(columns["keys"][i].as_py())
                    values.append(columns["logs"][i].as_py())
                    lm = None
                    continue
                if lm is None:
                    lm = _Table(keys, values)
                    keys, values = [], []
                block = [columns[name][i].as_py() for name in ("doc_id", "row", "held_out", "length")]
                yield texts_of(*block, zstandard.decompress(streams), lm)

    # of a chunk, its keys come before its texts
    met = found.unionByName(texts, allowMissingColumns=True).repartition("chunk").sortWithinPartitions(
        "chunk", F.col("streams").isNotNull())
    rows = written(met.mapInArrow(score, result), "lm-rows")
    log = F.log10((F.coalesce("c", F.lit(0)) + 0.5) / F.lit(whole))
    extra = rows.select("row", F.explode("rare").alias("word", "times")).join(words.where(~often), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * log).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("seen"))
    return rows.drop("rare").join(extra, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")
