"""The hourly news report and the login-state merge as Structured Streaming jobs.

Both jobs run on files that arrive during the day. The report expressions are the ones of
the batch plans.

`store_batches` with `news_visits` or `login_summary` loses no row and does not depend on how
files fall into batches: every micro-batch stores its own exact partial counts, whatever
their time, and the report adds up what is stored. `news_per_hour` and `merge_logins` are
the forms for jobs that need each hour once, or each batch applied at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from touchpath.functions.text import to_long
from touchpath.operators import quality as q
from touchpath.plans import app
from touchpath.plans.pages import check_news
from touchpath.sources.logs import LogLayout, parse


HOUR_MS = 3_600_000


def stream_log(spark: SparkSession, path: str, layout: LogLayout, **options: str) -> DataFrame:
    """A log directory as a stream of parsed rows."""
    return parse(spark.readStream.options(**options).text(path), layout)


def news_per_hour(rows: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """pv and exact uv per news page and hour.

    Streams have no exact distinct count. Two chained window counts give it: per visitor
    first, which also keeps a hot page out of a single task, then per page. An hour is
    complete when the watermark (latest view minus ``delay``) has passed its end.
    """
    views = q.accepted(check_news(rows)).select(
        F.timestamp_millis(to_long(F.col("ts"))).alias("time"), "pageid", "guid"
    )
    per_visitor = (
        views.where("time IS NOT NULL").withWatermark("time", delay)
        .groupBy(F.window("time", "1 hour"), "pageid", "guid")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_visitor.groupBy(F.window(F.window_time("window"), "1 hour"), "pageid")
        .agg(F.sum("n").alias("pv"), F.count("guid").alias("uv"))
        .select(
            F.col("window.start").alias("hour"), F.col("pageid").alias("page_id"), "pv", "uv"
        )
    )


def store_batches(
    rows: DataFrame, path: str, summarize: Callable[[DataFrame], DataFrame]
) -> DataStreamWriter:
    """Write ``summarize(batch)`` under the id of each micro-batch; a repeated batch replaces itself."""
    def store(batch: DataFrame, batch_id: int) -> None:
        summarize(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return rows.writeStream.foreachBatch(store)


def news_visits(rows: DataFrame) -> DataFrame:
    """Views per hour, news page and visitor; the hour is NULL where the time cannot be read."""
    ts = to_long(F.col("ts"))
    hour = F.when(~q.no_time(ts), ts - F.pmod(ts, F.lit(HOUR_MS)))
    views = q.accepted(check_news(rows)).select(
        hour.alias("hour_ms"), F.col("pageid").alias("page_id"), "guid"
    )
    return views.groupBy("hour_ms", "page_id", "guid").agg(F.count(F.lit(1)).alias("n"))


def news_of_visits(visits: DataFrame) -> DataFrame:
    """pv and exact uv per hour and news page from the stored `news_visits` of all batches."""
    per_visitor = visits.groupBy("hour_ms", "page_id", "guid").agg(F.sum("n").alias("n"))
    return per_visitor.groupBy("hour_ms", "page_id").agg(
        F.sum("n").alias("pv"), F.count("guid").alias("uv")
    )


def login_summary(rows: DataFrame, decrypt=None) -> DataFrame:
    """Earliest login per device, customer, product and platform.

    `app.first_logins` of the stored summaries of all batches is that of all logins.
    """
    logins = app.logins(rows, decrypt)
    return logins.groupBy("deviceid", "custno", "proid", "flag").agg(F.min("ts").alias("ts"))


def merge_logins(
    rows: DataFrame,
    read_state: Callable[[], DataFrame],
    apply: Callable[[DataFrame, int], None],
    decrypt=None,
) -> DataStreamWriter:
    """Merge each micro-batch of app logins into the stored state.

    ``apply(changes, batch_id)`` must be idempotent per batch id, as a batch may run again
    after a failure; the MERGE of `upsert_jdbc` is.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        new = app.first_logins(app.logins(batch, decrypt))
        apply(app.state_changes(new, read_state()), batch_id)

    return rows.writeStream.foreachBatch(merge)
