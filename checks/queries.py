"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.logs import DT, LOGS, OTHER_DT, STATE_CUT_MS, spark_lines, spark_log
from touchpath import config as c
from touchpath import jobs
from touchpath import state as login_state
from touchpath.functions import channels as ch
from touchpath.functions import text
from touchpath.functions.pages import funnel_step, news_page_parts
from touchpath.operators import report as r
from touchpath.plans import app, h5, misc, pages, pc, trade
from touchpath.sources import logs as src
from touchpath.sources import tables
from touchpath.streaming.hourly import (
    login_summary,
    news_of_visits,
    news_visits,
    store_batches,
    stream_log,
)
from touchpath.streaming.logins import earliest_logins, login_table, store_updates
from touchpath.streaming.windows import NewsWindows, news_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def shared_path(spark: SparkSession, name: str) -> str:
    """New path in the folder all executors share; a temporary one in local tests only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="touchpath-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def parsed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lines = spark_lines(spark, sf_dir, name)
    return src.parse(lines, LOGS[name][1], keep=("event_id",))


# --- sources -----------------------------------------------------------------

@query
def scan_delimited(spark, sf_dir):
    path = shared_path(spark, "scan_delimited")
    spark_lines(spark, sf_dir, "pv_log").select("value").write.text(path)
    fields = src.split_fields(src.read_lines(spark, path))
    return fields.select(
        F.size("fields").cast("bigint").alias("n_fields"),
        F.array_join("fields", "|").alias("joined"),
    )


def _scan(name: str) -> Query:
    def scan(spark, sf_dir):
        rows = parsed(spark, sf_dir, name)
        return src.complete(rows, LOGS[name][1])
    return scan


for _log in LOGS:
    QUERIES[f"scan_{_log}"] = _scan(_log)


# --- page views: filters and expressions -------------------------------------

@query
def pv_valid(spark, sf_dir):
    return pc.valid(parsed(spark, sf_dir, "pv_log"))


@query
def pv_rejects(spark, sf_dir):
    return pc.rejects(parsed(spark, sf_dir, "pv_log"))


@query
def landing_filter(spark, sf_dir):
    log = spark_log(spark, sf_dir, "pv_log")
    landing = F.col("desturl").rlike(c.DEFAULT_SITE.landing)
    return log.select("event_id", "desturl", landing.alias("is_landing"))


@query
def isempty_variants(spark, sf_dir):
    guid = F.col("guid")
    return spark_log(spark, sf_dir, "trade_log").select(
        "event_id", "guid", text.is_blank(guid).alias("blank_exact"),
        text.is_blank(guid, ignore_case=True).alias("blank_any_case"),
    )


@query
def referrer_channel(spark, sf_dir):
    log = spark_log(spark, sf_dir, "pv_log")
    return log.select("event_id", ch.referrer_channel(F.col("srcurl")).alias("channel"))


@query
def referrer_class(spark, sf_dir):
    url = F.col("srcurl")
    rows = spark_log(spark, sf_dir, "pv_log").select(
        "event_id", "srcurl", ch.host(url).alias("ref_host")
    ).withColumn("code", ch.channel_of_host(F.col("ref_host")))
    code = F.col("code")
    kind = F.when(ch.is_search(code), "search").when(ch.is_portal(code), "portal")
    return rows.select(
        "event_id",
        url.rlike(c.DEFAULT_SITE.internal).alias("internal"),
        ch.is_uri(url).alias("uri_ok"),
        F.coalesce(kind, F.lit("none")).alias("class"),
    )


@query
def htag_parts(spark, sf_dir):
    parts = ch.htag_parts(F.col("htag"))
    return spark_log(spark, sf_dir, "pv_log").select(
        "event_id", "htag", *[parts[name].alias(name) for name in ("valid", "level", "body")]
    )


@query
def promo_levels(spark, sf_dir):
    body = ch.htag_parts(F.col("htag"))["body"]
    tags = spark_log(spark, sf_dir, "pv_log").select("event_id", body.alias("tag"))
    promo = tags.where(ch.is_promo_tag(F.col("tag")))
    return promo.select("event_id", F.explode(ch.channel_levels(F.col("tag"))).alias("code"))


@query
def channel_dim(spark, sf_dir):
    codes = pc.measures(spark_log(spark, sf_dir, "pv_log")).select("channel")
    dims = r.with_dimensions(codes)
    h5_parent = ch.channel_parent(F.col("channel"), "-1").alias("h5_parent")
    return dims.select("*", h5_parent)


@query
def news_pageid_parts(spark, sf_dir):
    log = spark_log(spark, sf_dir, "pv_log").where(F.col("pageid").rlike(c.NEWS_PAGE))
    parts = news_page_parts(F.col("pageid"))
    names = ("zid", "newstype", "subtype", "author_id")
    return log.select("event_id", "pageid", *[parts[n].alias(n) for n in names])


# --- PC report ---------------------------------------------------------------

def _pc(spark, sf_dir):
    return pc.measures(spark_log(spark, sf_dir, "pv_log"))


@query
def pc_attribution(spark, sf_dir):
    views = pc.valid(spark_log(spark, sf_dir, "pv_log"))
    return pc.attribute(views, keep=("event_id",))


@query
def pc_enter(spark, sf_dir):
    return pc.entries(_pc(spark, sf_dir))


@query
def pc_simu_uv(spark, sf_dir):
    return pc.private_fund_visitors(_pc(spark, sf_dir))


@query
def pc_channel_view(spark, sf_dir):
    return r.details(pc.reported(_pc(spark, sf_dir)))


@query
def pc_group_view(spark, sf_dir):
    return r.groups(_pc(spark, sf_dir))


@query
def pc_total_view(spark, sf_dir):
    return r.total(_pc(spark, sf_dir))


@query
def pc_channel_report(spark, sf_dir):
    return pc.channel_report(spark_log(spark, sf_dir, "pv_log"), DT)


@query
def pc_anomalies(spark, sf_dir):
    return pc.anomalies(pc.valid(spark_log(spark, sf_dir, "pv_log")))


# --- H5 reports --------------------------------------------------------------

def _h5(spark, sf_dir):
    return h5.measures(spark_log(spark, sf_dir, "pv_log"))


@query
def h5_pv_valid(spark, sf_dir):
    return h5.valid(parsed(spark, sf_dir, "pv_log"))


@query
def h5_rejects(spark, sf_dir):
    return h5.rejects(parsed(spark, sf_dir, "pv_log"))


@query
def h5_attribution(spark, sf_dir):
    views = h5.valid(spark_log(spark, sf_dir, "pv_log"))
    return h5.attribute(views, keep=("event_id",))


@query
def h5_funnel(spark, sf_dir):
    log = spark_log(spark, sf_dir, "pv_log")
    return log.select("event_id", "pageid", funnel_step(F.col("pageid")).alias("step"))


@query
def h5_enter(spark, sf_dir):
    return h5.entries(_h5(spark, sf_dir))


@query
def h5_channel_view(spark, sf_dir):
    return r.details(_h5(spark, sf_dir))


@query
def h5_group_view(spark, sf_dir):
    return _h5(spark, sf_dir).where(ch.is_summary(F.col("channel")))


@query
def h5_view_report(spark, sf_dir):
    return h5.view_report(spark_log(spark, sf_dir, "pv_log"), DT)


@query
def h5_openacct(spark, sf_dir):
    return h5.opening_report(parsed(spark, sf_dir, "h5_event_log"), DT)


@query
def h5_channel_merged(spark, sf_dir):
    views, events = (spark_log(spark, sf_dir, n) for n in ("pv_log", "h5_event_log"))
    return h5.merged_report(views, events, DT)


@query
def h5_merge_coverage(spark, sf_dir):
    views, events = (spark_log(spark, sf_dir, n) for n in ("pv_log", "h5_event_log"))
    return h5.merge_coverage(views, events)


# --- news, private fund, ads -------------------------------------------------

@query
def news_pv_daily(spark, sf_dir):
    return pages.news_report(spark_log(spark, sf_dir, "pv_log"), DT)


@query
def news_pv_hourly(spark, sf_dir):
    root = shared_path(spark, "news_pv_hourly")
    # one file per hour of the day, named <dt>.<hour>
    hour_file = F.expr(f"concat('{DT}.', (CAST(ts AS BIGINT) div 3600000) % 24)")
    lines = spark_lines(spark, sf_dir, "pv_log").withColumn("log", hour_file)
    (lines.repartitionByRange("log", "event_id").select("log", "value")
     .write.partitionBy("log").text(root))
    stored = spark.read.schema("value string, log string").text(root)
    rows = src.parse(stored, src.PAGE_VIEW, keep=("log",))
    return pages.news_report(rows, DT, by=("log",))


def _streamed(spark, sf_dir, name, summarize):
    """What a stream over the log's lines stores, all batches."""
    lines, out = shared_path(spark, "stream_lines"), shared_path(spark, "stream_stored")
    spark_lines(spark, sf_dir, name).select("value").write.text(lines)
    job = (
        store_batches(stream_log(spark, lines, LOGS[name][1]), out, summarize)
        .option("checkpointLocation", shared_path(spark, "stream_progress"))
        .trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return spark.read.parquet(out)


@query
def news_pv_stream(spark, sf_dir):
    """The streaming report over the whole log, all hours."""
    return news_of_visits(_streamed(spark, sf_dir, "pv_log", news_visits))


def _in_files(spark, sf_dir, name, files):
    """The log's lines as files that arrive one after the other, with times of all hours in each."""
    path = shared_path(spark, "arriving")
    lines = spark_lines(spark, sf_dir, name).withColumn("file", F.pmod(F.col("event_id"), F.lit(files)))
    lines.repartition("file").select("file", "value").write.partitionBy("file").text(path)
    return f"{path}/*"


@query
def news_windows_late(spark, sf_dir):
    """Hours reported once, corrections by late files and open hours: together all rows."""
    rows = stream_log(spark, _in_files(spark, sf_dir, "pv_log", 3), src.PAGE_VIEW, maxFilesPerTrigger="1")
    windows = NewsWindows(spark, shared_path(spark, "news_windows"))
    job = news_windows(rows, windows).option("checkpointLocation", shared_path(spark, "stream_progress"))
    job.trigger(availableNow=True).start().awaitTermination()
    return windows.totals()


@query
def app_first_login_keyed(spark, sf_dir):
    """First logins from the stream's keyed state."""
    rows = stream_log(spark, _in_files(spark, sf_dir, "app_log", 3), src.APP_LOGIN, maxFilesPerTrigger="1")
    out = shared_path(spark, "login_updates")
    job = store_updates(earliest_logins(rows), out).option("checkpointLocation", shared_path(spark, "stream_progress"))
    job.trigger(availableNow=True).start().awaitTermination()
    return login_table(spark, out)


@query
def news_pv_total(spark, sf_dir):
    return pages.news_total(spark_log(spark, sf_dir, "pv_log"), DT)


@query
def news_uv_sketch(spark, sf_dir):
    """Pages of the day and the whole section from stored hourly sketches, against the exact uv."""
    path, rows = shared_path(spark, "news_sketches"), spark_log(spark, sf_dir, "pv_log")
    pages.news_sketches(rows).write.parquet(path)
    sketches = spark.read.parquet(path)
    estimated = pages.news_report_estimated(sketches, DT).unionByName(pages.news_total_estimated(sketches, DT))
    exact = pages.news_report(rows, DT).unionByName(pages.news_total(rows, DT))
    near = F.abs(F.col("estimate") - F.col("uv")) <= pages.SKETCH_ERROR * F.col("uv")
    uv = exact.select("page_id", "uv")
    return estimated.withColumnRenamed("uv", "estimate").join(uv, "page_id").select(
        *exact.columns, near.alias("uv_near"))


@query
def news_rejects(spark, sf_dir):
    return pages.news_rejects(parsed(spark, sf_dir, "pv_log"))


@query
def simu_rejects(spark, sf_dir):
    return pages.private_fund_rejects(parsed(spark, sf_dir, "pv_log"))


@query
def simu_page_pv(spark, sf_dir):
    return pages.private_fund_report(spark_log(spark, sf_dir, "pv_log"), DT)


@query
def ad_rejects(spark, sf_dir):
    return pages.ad_rejects(parsed(spark, sf_dir, "ad_log"))


@query
def ad_click_daily(spark, sf_dir):
    return pages.ad_report(spark_log(spark, sf_dir, "ad_log"), DT)


# --- trades ------------------------------------------------------------------

def _trade(spark, sf_dir):
    return trade.measures(spark_log(spark, sf_dir, "trade_log"))


@query
def trade_valid(spark, sf_dir):
    return trade.valid(parsed(spark, sf_dir, "trade_log"))


@query
def trade_rejects(spark, sf_dir):
    return trade.rejects(parsed(spark, sf_dir, "trade_log"))


@query
def trade_failures(spark, sf_dir):
    return trade.failures(parsed(spark, sf_dir, "trade_log"))


@query
def otrack_channel(spark, sf_dir):
    log = spark_log(spark, sf_dir, "trade_log")
    return log.select("event_id", "otrack", ch.otrack_channel(F.col("otrack")).alias("channel"))


@query
def trade_attribution(spark, sf_dir):
    events = trade.valid(spark_log(spark, sf_dir, "trade_log"))
    return trade.attribute(events, keep=("event_id",))


@query
def trade_by_channel(spark, sf_dir):
    return r.details(_trade(spark, sf_dir))


@query
def trade_group(spark, sf_dir):
    return r.groups(_trade(spark, sf_dir))


@query
def trade_total(spark, sf_dir):
    return r.total(_trade(spark, sf_dir))


@query
def trade_report(spark, sf_dir):
    return trade.trade_report(spark_log(spark, sf_dir, "trade_log"), DT)


@query
def event_total_amount(spark, sf_dir):
    return trade.amount_totals(parsed(spark, sf_dir, "trade_log"))


@query
def trade_anomalies(spark, sf_dir):
    return trade.anomalies(trade.valid(spark_log(spark, sf_dir, "trade_log")))


@query
def action_dim(spark, sf_dir):
    return misc.count_by_action(spark_log(spark, sf_dir, "trade_log"))


@query
def module_dim(spark, sf_dir):
    return misc.count_by_module(pages.ad_report(spark_log(spark, sf_dir, "ad_log"), DT))


# --- app logins --------------------------------------------------------------

def _state_and_batch(spark, sf_dir):
    """Stored state (logins before the cut day) and the logins of the following days."""
    log = spark_log(spark, sf_dir, "app_log")
    ms = text.to_long(F.col("ts"))
    before = app.first_logins(app.logins(log.where(ms < STATE_CUT_MS)))
    state = before.withColumn("ts", F.timestamp_millis(F.lit(STATE_CUT_MS)))
    return state, app.first_logins(app.logins(log.where(ms >= STATE_CUT_MS)))


@query
def app_logins_valid(spark, sf_dir):
    rows = app.logins(spark_log(spark, sf_dir, "app_log"))
    return rows


@query
def app_rejects(spark, sf_dir):
    return app.rejects(parsed(spark, sf_dir, "app_log"))


@query
def app_first_login(spark, sf_dir):
    return app.first_logins(app.logins(spark_log(spark, sf_dir, "app_log")))


@query
def app_first_login_stream(spark, sf_dir):
    return app.first_logins(_streamed(spark, sf_dir, "app_log", login_summary))


@query
def app_first_login_upsert(spark, sf_dir):
    state, batch = _state_and_batch(spark, sf_dir)
    return app.upsert_state(batch, state).drop("ts")


@query
def app_login_state(spark, sf_dir):
    """The stored state after two runs and a repeated one."""
    log = spark_log(spark, sf_dir, "app_log")
    ms, root = text.to_long(F.col("ts")), shared_path(spark, "login_state")
    for batch, rows in (("before", ms < STATE_CUT_MS), ("after", ms >= STATE_CUT_MS), ("after", ms >= STATE_CUT_MS)):
        version = login_state.merge(spark, root, app.first_logins(app.logins(log.where(rows))), batch, buckets=16)
    return login_state.read(spark, root).drop("ts").withColumn("version", F.lit(version.number))


@query
def table_count(spark, sf_dir):
    state, batch = _state_and_batch(spark, sf_dir)
    path = shared_path(spark, "login_state")
    app.upsert_state(batch, state).write.parquet(path)
    stored = spark.read.parquet(path)
    return tables.count_rows(stored, F.col("zhangji_firsttime").isNotNull())


# --- sinks -------------------------------------------------------------------

@query
def sink_delimited(spark, sf_dir):
    path = shared_path(spark, "sink_delimited")
    tables.append_delimited(ad_click_daily(spark, sf_dir), path)
    return src.read_lines(spark, path)


@query
def sink_report_table(spark, sf_dir):
    root = shared_path(spark, "sink_report_table")
    tables.append_parquet(trade_report(spark, sf_dir), "channel_trade_stat", root)
    stored = spark.read.parquet(f"{root}/channel_trade_stat").drop("createtime")
    return stored.withColumn("dt", F.col("dt").cast("date"))


@query
def report_day_twice(spark, sf_dir):
    """Two days of a report, the first of them written twice."""
    root, rows = shared_path(spark, "report_day_twice"), spark_log(spark, sf_dir, "trade_log")
    for day in (DT, OTHER_DT, DT):
        tables.replace_days_parquet(trade.trade_report(rows, day), "channel_trade_stat", root)
    stored = spark.read.parquet(f"{root}/channel_trade_stat").drop("createtime")
    return stored.withColumn("dt", F.col("dt").cast("date"))


# --- jobs from text files to tables -------------------------------------------

@query
def observed_rejects(spark, sf_dir):
    """Outcomes per log, counted by the jobs while their reports were written."""
    found = []

    def write(report, table):
        report.write.format("noop").mode("overwrite").save()

    def lines(name):
        path = shared_path(spark, "observed")
        spark_lines(spark, sf_dir, name).select("value").write.text(path)
        return path

    views, keep = lines("pv_log"), lambda outcomes, log: found.append(outcomes)
    jobs.pc_channels(spark, views, write, DT, rejects=keep)
    jobs.h5_channels(spark, views, lines("h5_event_log"), write, DT, rejects=keep)
    jobs.trade_channels(spark, lines("trade_log"), write, DT, rejects=keep)
    jobs.news_daily(spark, views, write, DT, rejects=keep)
    jobs.private_fund_pages(spark, views, write, DT, rejects=keep)
    jobs.ad_clicks(spark, lines("ad_log"), write, DT, rejects=keep)
    jobs.app_login_state(spark, lines("app_log"), shared_path(spark, "state"), "day", rejects=keep)
    return reduce(DataFrame.union, found).where("log <> 'H5 events'").drop("dt")


@query
def news_hourly_files(spark, sf_dir):
    """Two hours from files named by hour, and the day, read back from the tables of both jobs."""
    root, out = shared_path(spark, "news_files"), shared_path(spark, "news_tables")
    hour_file = F.expr(f"concat('{DT}.', (CAST(ts AS BIGINT) div 3600000) % 24)")
    lines = spark_lines(spark, sf_dir, "pv_log").withColumn("log", hour_file)
    lines.repartition("log").select("log", "value").write.partitionBy("log").text(root)
    write = partial(tables.append_parquet, root=out)
    for hour in (1, 14):
        jobs.news_hourly(spark, root, write, DT, hour)
    jobs.news_daily(spark, f"{root}/*", write, DT)
    stored = [
        spark.read.parquet(f"{out}/{tables.news_table(hourly)}").select("*", F.lit(name).alias("name"))
        for name, hourly in (("today", True), ("his", False))
    ]
    return stored[0].unionByName(stored[1]).drop("create_time").withColumn("dt", F.col("dt").cast("date"))


@query
def several_inputs(spark, sf_dir):
    """Reject counts over a folder and a glob of folders, read as one log."""
    path = shared_path(spark, "several")
    lines = spark_lines(spark, sf_dir, "pv_log").withColumn("file", F.pmod(F.col("event_id"), F.lit(4)))
    lines.select("file", "value").write.partitionBy("file").text(path)
    return pc.rejects(src.read_log(spark, [f"{path}/file=0", f"{path}/file=[1-3]"], src.PAGE_VIEW))


# --- small text jobs ---------------------------------------------------------

@query
def word_count(spark, sf_dir):
    return misc.word_count(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text")


@query
def word_count_text(spark, sf_dir):
    """The written word counts, read back."""
    path = shared_path(spark, "word_count")
    misc.write_word_count(word_count(spark, sf_dir), path)
    fields = F.split("value", "\t")
    return src.read_lines(spark, path).select(
        F.get(fields, F.lit(0)).alias("word"), F.get(fields, F.lit(1)).cast("bigint").alias("n"))


def _pair_lines(spark, sf_dir):
    """Customer and order keys; some lines are blank, some hold no 32-bit integers."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(
        "CASE o_orderkey % 101 WHEN 0 THEN concat('x ', o_orderkey) WHEN 1 THEN concat(o_custkey, ' 99999999999') "
        "WHEN 2 THEN '' ELSE concat(o_custkey, ' ', o_orderkey) END AS value")


@query
def secondary_sort(spark, sf_dir):
    return misc.secondary_sort(src.read_int_pairs(_pair_lines(spark, sf_dir)))


@query
def secondary_sort_rejects(spark, sf_dir):
    return src.int_pair_outcomes(_pair_lines(spark, sf_dir))


@query
def signature(spark, sf_dir):
    body = F.col("text")
    signed = text.sign(body)
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        signed.alias("signature"),
        text.sign_matches(body, signed).alias("verified"),
        text.sign_matches(F.concat(body, F.lit("!")), signed).alias("verified_changed"),
        (text.decode_base64(text.encode_base64(body)) == body).alias("base64_round_trip"),
    )
