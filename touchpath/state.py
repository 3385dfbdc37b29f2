"""The first-login state as a stored table: buckets of (device, customer), versions, batches.

A version is one small file that names, for every bucket, the folder with its rows, and the
batches merged so far. A merge reads and rewrites only the buckets that its batch touches
and then publishes the next version by renaming that file into place. Readers see the old
version or the new one, never a mixture; a run that fails before the renaming leaves
unnamed folders and no change, and one that a faster run overtook fails without any. A
batch that has been merged already is not merged again, so a job may be repeated.

The number of buckets is fixed when the state is made; keys are spread over them by hash.
The driver handles bucket numbers and folder names only.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.plans import app
from touchpath.sources.tables import LOGIN_STATE

BUCKETS = 256
SCHEMA = (
    "deviceid string, custno string, chuxuguan_firsttime timestamp, zhangji_firsttime timestamp, flag int, ts timestamp"
)


@dataclass(frozen=True)
class Version:
    number: int = 0
    buckets: int = BUCKETS
    folders: dict[str, str] = field(default_factory=dict)
    batches: tuple[str, ...] = ()


class _Files:
    """The few file-system calls a version needs, on whatever file system ``root`` is."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def text(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Make the file appear with its whole text; fails if it is there."""
        draft = f"drafts/{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), False)
        stream.write(text.encode())
        stream.close()
        final = self.path(name)
        self.fs.mkdirs(final.getParent())
        if self.fs.exists(final) or not self.fs.rename(self.path(draft), final):
            raise RuntimeError(f"{name} was published by another run; run again")


def current(spark: SparkSession, root: str) -> Version | None:
    """The newest version, None where there is no state yet."""
    files = _Files(spark, root)
    names = [name for name in files.names("versions") if name.endswith(".json")]
    if not names:
        return None
    stored = json.loads(files.text(f"versions/{max(names)}"))
    return Version(**stored | {"batches": tuple(stored["batches"])})


def read(spark: SparkSession, root: str, version: Version | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The state, or some of its buckets."""
    version = version or current(spark, root) or Version()
    wanted = version.folders if buckets is None else [str(b) for b in buckets]
    folders = [f"{root.rstrip('/')}/{version.folders[b]}" for b in wanted if b in version.folders]
    return spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)


def merge(spark: SparkSession, root: str, new: DataFrame, batch: str, buckets: int = BUCKETS) -> Version:
    """Merge the first logins ``new`` (one row per device and customer) as ``batch``; the version after it.

    Stored times win and complete rows stay as they are (`touchpath.plans.app.upsert_state`).
    """
    held = current(spark, root) or Version(buckets=buckets)
    if batch in held.batches:
        return held
    root = root.rstrip("/")
    name = f"{held.number + 1:08d}-{uuid.uuid4().hex}"
    bucket = F.pmod(F.xxhash64("deviceid", "custno"), F.lit(held.buckets)).cast("int").alias("bucket")
    # written once: the logs are read for the touched buckets and for the merge only one time
    new.select("*", bucket).write.parquet(f"{root}/arrived/{name}")
    arrived = spark.read.parquet(f"{root}/arrived/{name}")
    touched = [row["bucket"] for row in arrived.select("bucket").distinct().collect()]  # at most ``buckets``
    merged = app.upsert_state(arrived.drop("bucket"), read(spark, root, held, touched)).drop("change")
    merged.select("*", bucket).repartition("bucket").write.partitionBy("bucket").parquet(f"{root}/data/{name}")
    folders = held.folders | {str(b): f"data/{name}/bucket={b}" for b in touched}
    after = Version(held.number + 1, held.buckets, folders, (*held.batches, batch))
    _Files(spark, root).publish(f"versions/{after.number:08d}.json", json.dumps(asdict(after)))
    return after


assert tuple(column.split()[0] for column in SCHEMA.split(", ")) == LOGIN_STATE
