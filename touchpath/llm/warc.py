"""WARC archives with a Zstandard dictionary, and reading them back.

Every task writes archives of its own: a skippable frame that holds the dictionary, then
each record as a frame of its own, compressed with it, so that any record can be read
without its neighbours. The dictionary is trained on the first records of the archive
(at most ``SAMPLE`` of them and ``SAMPLE_BYTES`` bytes; too few for training: their bytes
serve as a raw dictionary). An archive ends at ``ARCHIVE_BYTES`` of records.

Payloads are hashed by SHA-256. Of pages with equal payloads of at least ``MIN_BYTES``
bytes the one with the smallest page id is stored, the others are revisit records that
name it and keep its length in their HTTP head. A NULL html is an empty payload. A NULL
page id is not stored in preference to another id; pages equal in id and payload are all
responses if that id is the smallest. A NULL url has no target header.

Archives are written through pyarrow's file systems under the folder all executors share;
a task names its archives in its output, so those of failed attempts are never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.llm.common import shared_path, written

MIN_BYTES = 100
SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES, ARCHIVE_BYTES = 1000, 4 << 20, 64 << 10, 64 << 20
SKIPPABLE = 0x184D2A5D  # fixed value: the frame number that WARC readers take for a dictionary
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def marked(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, refers_to (NULL: a response), one row per page."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        body.alias("html"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    shared = rows.where(F.col("size") >= MIN_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("digest").alias("d"), "first")
    joined = rows.join(shared.hint("shuffle_hash"), rows["digest"] == shared["d"], "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"))


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    name = f"page:{page_id}" if page_id is not None else f"unnumbered:{digest}:{url}"
    return f"<urn:uuid:{uuid.uuid5(_SPACE, name)}>"


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> bytes:
    payload = html.encode("utf-8", "surrogatepass")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, url)), ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest, None)),
                   ("X-Refers-To-Page", str(refers_to))]
        payload = b""
    fields.append(("Content-Length", str(len(head) + len(payload))))
    top = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + top.encode("utf-8", "surrogatepass") + b"\r\n" + head + payload + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        size = min(DICTIONARY_BYTES, max(256, sum(map(len, records)) // 8))
        return zstandard.train_dictionary(size, records)
    except zstandard.ZstdError:
        raw = b"".join(records)[-DICTIONARY_BYTES:].rjust(8, b" ")
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """One archive: waits for a sample of records, then writes the dictionary and the frames."""

    def __init__(self, path: str) -> None:
        self.path, self.size, self.count = path, 0, 0
        self.waiting: list[bytes] = []
        self.out = self.compressor = None

    def add(self, data: bytes) -> None:
        self.size += len(data)
        self.count += 1
        if self.compressor is not None:
            self.out.write(self.compressor.compress(data))
            return
        self.waiting.append(data)
        if len(self.waiting) >= SAMPLE or self.size >= SAMPLE_BYTES:
            self._start()

    def _start(self) -> None:
        made = dictionary(self.waiting)
        system, path = fs.FileSystem.from_uri(self.path)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = system.open_output_stream(path)
        content = made.as_bytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=made)
        for data in self.waiting:
            self.out.write(self.compressor.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.out.close()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(path, records) of the archives written; run once, as a written table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, done, writer = TaskContext.get(), [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{len(done):04d}"
                    writer = ArchiveWriter(f"{folder}/{name}.warc.zst")
                writer.add(record(*row))
                if writer.size >= archive_bytes:
                    writer.close()
                    done.append(writer)
                    writer = None
        if writer is not None:
            writer.close()
            done.append(writer)
        yield pa.RecordBatch.from_arrays([
            pa.array([w.path for w in done], pa.string()), pa.array([w.count for w in done], pa.int64())], ["path", "records"])

    return written(marked(pages).mapInArrow(write, "path string, records long"), "warc-list")


def records(data: bytes) -> Iterator[bytes]:
    """The records of one archive."""
    magic, size = struct.unpack_from("<II", data)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame at the start")
    content = data[8:8 + size]
    trained = content[:4] == b"\x37\xa4\x30\xec"  # fixed value: start of a trained dictionary
    made = zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    reader, rest = zstandard.ZstdDecompressor(dict_data=made), memoryview(data)[8 + size:]
    at = 0
    while at < len(rest):
        length = _frame_length(rest, at)
        yield reader.decompress(rest[at:at + length])
        at += length


def _frame_length(data: memoryview, at: int) -> int:
    """Bytes of the frame at a place: its header, its blocks by their lengths, its checksum."""
    start = at
    flags = zstandard.get_frame_parameters(data[at:at + 18])
    at += zstandard.frame_header_size(data[at:at + 18])
    while True:
        header = int.from_bytes(data[at:at + 3], "little")
        at += 3 + (1 if header >> 1 & 3 == 1 else header >> 3)
        if header & 1:
            return at - start + (4 if flags.has_checksum else 0)


def parsed(data: bytes) -> dict:
    """Headers of a record, and its payload after the HTTP head; the digest is verified."""
    top, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in top.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    head, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
    return {
        "page_id": int(page) if page else None, "url": fields.get("WARC-Target-URI"),
        "payload_bytes": int(http["Content-Length"]), "payload_digest": digest,
        "record_type": fields["WARC-Type"], "refers_to": int(refers) if refers else None, "payload": payload,
    }


_FIELDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
           "record_type": pa.string(), "refers_to": pa.int64()}


def read_archives(archives: DataFrame, payload: bool = False) -> DataFrame:
    """The records of the archives in ``path``: page_id, payload_bytes, payload_digest,
    record_type, refers_to, and with ``payload`` the bytes and url."""
    kinds = _FIELDS | ({"url": pa.string(), "payload": pa.binary()} if payload else {})
    schema = pa.schema(list(kinds.items()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_stream(name) as file:
                    data = file.read()
                rows = []
                for one in records(data):
                    found = parsed(one)
                    rows.append({k: found[k] for k in kinds})
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    ddl = ", ".join(f"{k} {names[t]}" for k, t in kinds.items())
    parts = max(1, archives.sparkSession.sparkContext.defaultParallelism)
    return archives.select("path").repartition(parts).mapInArrow(read, ddl)


def archived(pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder and return what is read back from them."""
    return read_archives(write_archives(pages, shared_path(pages.sparkSession, "warc")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS d FROM pages),
q AS (SELECT page_id, strlen(body) AS n, d, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM q
"""
