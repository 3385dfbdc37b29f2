"""News pages per hour as a stream that reports an hour once and loses no late row.

`news_windows` keeps the views of open hours, per hour, page and visitor. When the
watermark, the latest time of earlier batches less ``delay``, has passed an hour's end, the
hour is reported with exact pv and uv, once. Rows that come after that go to the
corrections: what they add to pv and, for visitors not seen on that page in that hour, to
uv. Report and corrections together are the counts over all rows, whatever the batches.

Everything is stored per batch, so a repeated batch replaces what it wrote, and nothing but
the watermark comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from touchpath.streaming.hourly import HOUR_MS, news_of_visits, news_visits

VISITS = "hour_ms bigint, page_id string, guid string, n bigint, batch bigint"
COUNTS = "hour_ms bigint, page_id string, pv bigint, uv bigint, batch bigint"
MARKS = "latest_ms bigint, batch bigint"
_PAGE = ["hour_ms", "page_id"]


class NewsWindows:
    """The stored tables under ``path``; views whose time cannot be read count as late at once."""

    def __init__(self, spark: SparkSession, path: str, delay_ms: int = 600_000) -> None:
        self.spark, self.path, self.delay_ms = spark, path.rstrip("/"), delay_ms

    def table(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        """What the batches (before ``before``) have stored."""
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except Exception as error:  # nothing stored yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)
        return rows if before is None else rows.where(F.col("batch") < before)

    def _store(self, rows: DataFrame, name: str, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")

    def _closed(self, batch: int) -> int | None:
        """Hours that end at or before this time are closed when the batch starts."""
        latest = self.table("marks", MARKS, batch).agg(F.max("latest_ms")).first()[0]
        return None if latest is None else (latest - self.delay_ms) // HOUR_MS * HOUR_MS

    def apply(self, rows: DataFrame, batch: int) -> None:
        closed, before = self._closed(batch), self._closed(batch - 1)
        self._store(news_visits(rows), "arrived", batch)
        arrived = self.spark.read.parquet(f"{self.path}/arrived/batch={batch}")
        late = F.col("hour_ms").isNull() if closed is None else F.coalesce(F.col("hour_ms") < closed, F.lit(True))
        if closed is not None:
            due = F.col("hour_ms") < closed
            due = due if before is None else due & (F.col("hour_ms") >= before)
            self._store(news_of_visits(self.table("visits", VISITS, batch).where(due)), "report", batch)
        self._store(arrived.where(~late), "visits", batch)
        self._store(arrived.where(late), "late", batch)
        self._store(self._corrections(arrived.where(late), batch), "corrections", batch)
        hours = arrived.agg(F.max("hour_ms").alias("latest_ms")).where("latest_ms is not null")
        self._store(hours, "marks", batch)

    def _corrections(self, late: DataFrame, batch: int) -> DataFrame:
        """pv and uv that late views add; visitors already counted for the page and hour add no uv."""
        seen = self.table("visits", VISITS, batch).union(self.table("late", VISITS, batch)).select(*_PAGE, "guid").distinct()
        seen = seen.withColumnsRenamed({name: f"seen_{name}" for name in seen.columns})
        same = [F.col(name).eqNullSafe(F.col(f"seen_{name}")) for name in (*_PAGE, "guid")]
        new = late.join(seen, same[0] & same[1] & same[2], "left")
        return new.groupBy(*_PAGE).agg(F.sum("n").alias("pv"), F.count_if(F.col("seen_guid").isNull()).alias("uv"))

    def reported(self) -> DataFrame:
        """Closed hours, as they were reported."""
        return self.table("report", COUNTS).drop("batch")

    def corrections(self) -> DataFrame:
        return self.table("corrections", COUNTS).drop("batch")

    def still_open(self) -> DataFrame:
        """Counts so far of the hours not reported yet."""
        visits = self.table("visits", VISITS)
        reported = self.reported().select("hour_ms").distinct()
        return news_of_visits(visits.join(reported, "hour_ms", "left_anti"))

    def totals(self) -> DataFrame:
        """Report, corrections and open hours together: pv and uv over all rows."""
        parts = self.reported().union(self.corrections()).union(self.still_open())
        return parts.groupBy(*_PAGE).agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))


def news_windows(rows: DataFrame, windows: NewsWindows) -> DataStreamWriter:
    """The stream of `NewsWindows` over parsed page views."""
    return rows.writeStream.foreachBatch(windows.apply)
