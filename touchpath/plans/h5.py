"""Mobile (H5) page views and account openings per channel, and their merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.channels import (
    channel_of_host,
    host,
    htag_parts,
    is_promo_tag,
    is_summary,
    otrack_channel,
)
from touchpath.functions.pages import funnel_step
from touchpath.functions.text import is_blank, to_long
from touchpath.operators import quality as q
from touchpath.operators import report as r
from touchpath.operators.carry import SLOT_MS, attribute_rows, attributed
from touchpath.plans.pc import bad_htag, visitor_invalid
from touchpath.sources.logs import H5_EVENT, PAGE_VIEW

STEPS = tuple(c.FUNNEL_SUFFIXES)
VIEW_METRICS = ("pv", "uv", "enter", *STEPS)


# --- page views --------------------------------------------------------------

def check(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return q.with_reason(
        rows,
        *q.incomplete(rows, PAGE_VIEW.arity),
        (visitor_invalid(ignore_case=True), q.INVALID_DATA),
        (F.coalesce(F.col("proid") != c.PRODUCT_H5, F.lit(True)), "OTHER_PRODUCT"),
        (~F.col("desturl").rlike(site.landing), q.INVALID_URL),
        (to_long(F.col("ts")).isNull(), q.INVALID_TIME),
    )


def valid(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return q.accepted(check(rows, site)).withColumn("ts", to_long(F.col("ts")))


def rejects(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    kept_bad = F.count_if(F.col("reject").isNull() & bad_htag(True)).alias("bad_htag")
    return q.count_outcomes(check(rows, site), kept_bad)


def classify(views: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Add ``assigned`` (channel the row assigns, NULL for a carry) and ``step``."""
    col = F.col
    parts = htag_parts(col("htag"))
    rows = views.withColumns({
        "htag_valid": ~is_blank(col("htag"), True) & parts["valid"],
        "level0": F.coalesce(parts["level"] == "0", F.lit(False)),
        "body": parts["body"],
        "no_ref": is_blank(col("srcurl"), True),
    })
    level0 = col("htag_valid") & col("level0")
    by_ref = ~level0 & ~col("no_ref") & (
        col("htag_valid") | ~col("srcurl").rlike(site.internal)
    )
    rows = rows.withColumn("by_ref", by_ref).withColumn(
        "ref_host", F.when(col("by_ref"), host(col("srcurl")))
    )
    assigned = (
        F.when(level0 & is_promo_tag(col("body")), col("body"))
        .when(level0, F.lit(None).cast("string"))
        .when(col("no_ref"), c.DIRECT)
        .when(col("by_ref"), F.coalesce(channel_of_host(col("ref_host")), F.lit(c.OTHER)))
    )
    step = F.when(~is_blank(col("pageid"), True), funnel_step(col("pageid")))
    return rows.withColumns({"assigned": assigned, "step": step})


def attribute(views: DataFrame, site: c.Site = c.DEFAULT_SITE, keep: tuple[str, ...] = (),
              slot_ms: int = SLOT_MS) -> DataFrame:
    """Channel of every H5 page view, with the ``keep`` columns."""
    return attribute_rows(_assigning(classify(views, site)), keep, slot_ms)


def _assigning(rows: DataFrame) -> DataFrame:
    """No row is a direct candidate: rows without referrer assign DIRECT."""
    return rows.withColumn("direct", F.lit(False))


def visitor_channels(views: DataFrame, site: c.Site = c.DEFAULT_SITE,
                     slot_ms: int = SLOT_MS) -> DataFrame:
    """Page views, entries and funnel steps per visitor and channel, to be added up."""
    rows = _assigning(classify(views, site)).select(
        "guid", "ts", "assigned", "direct", F.lit(1).cast("bigint").alias("n"),
        F.col("assigned").isNotNull().cast("bigint").alias("entered"),
        *[F.coalesce(F.col("step") == step, F.lit(False)).cast("bigint").alias(step) for step in STEPS],
    )
    names = ("n", "entered", *STEPS)
    found = attributed(rows, dict.fromkeys(names, "bigint"), slot_ms=slot_ms)
    # the visitor's very first view enters by DIRECT when it assigns nothing
    entered = (F.col("entered") + F.col("falls_back").cast("bigint")).alias("entered")
    return found.select("guid", "channel", "n", entered, *STEPS)


def view_measures(visits: DataFrame) -> DataFrame:
    """pv, uv, entries and visitors per funnel step, per code: details, groups, total."""
    code = F.explode(r.reported_codes(F.col("channel"))).alias("code")
    per_visitor = (
        visits.select("guid", code, "n", "entered", *STEPS)
        .groupBy("guid", "code")
        .agg(*[F.sum(name).alias(name) for name in ("n", "entered", *STEPS)])
    )
    return (
        r.add_zero_summaries(per_visitor.drop("guid"))
        .groupBy(F.col("code").alias("channel"))
        .agg(
            r.total_or_zero("n").alias("pv"),
            F.count_if(F.col("n") > 0).alias("uv"),
            r.total_or_zero("entered").alias("enter"),
            *[F.count_if(F.col(step) > 0).alias(step) for step in STEPS],
        )
    )


def measures(rows: DataFrame, site: c.Site = c.DEFAULT_SITE, slot_ms: int = SLOT_MS) -> DataFrame:
    return view_measures(visitor_channels(valid(rows, site), site, slot_ms))


def entries(found: DataFrame) -> DataFrame:
    return found.where(F.col("enter") > 0).select("channel", "enter")


def view_report(rows: DataFrame, dt: str | None = None,
                site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """The stand-alone H5 view table."""
    return r.with_date(r.with_dimensions(measures(rows, site), "-1", True), dt)


# --- account openings --------------------------------------------------------

def check_events(rows: DataFrame) -> DataFrame:
    other = (F.col("productid") != c.PRODUCT_H5) | (F.col("type") != c.ACTION_OPEN_ACCOUNT)
    return q.with_reason(
        rows,
        *q.incomplete(rows, H5_EVENT.arity),
        (F.coalesce(other, F.lit(True)), "OTHER_EVENT"),
    )


def openings(rows: DataFrame) -> DataFrame:
    """Account-opening events with their channel; each event stands on its own."""
    opened = q.accepted(check_events(rows))
    return opened.withColumn(
        "channel", F.coalesce(otrack_channel(F.col("otrack")), F.lit(c.DIRECT))
    )


def opening_measures(rows: DataFrame) -> DataFrame:
    """Openings per code: details, groups, total. Only the channels found are spread out."""
    per_channel = openings(rows).groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
    codes = per_channel.select(F.explode(r.reported_codes(F.col("channel"))).alias("code"), "n")
    return (
        r.add_zero_summaries(codes)
        .groupBy(F.col("code").alias("channel"))
        .agg(r.total_or_zero("n").alias("openacct_num"))
    )


def opening_report(rows: DataFrame, dt: str | None = None) -> DataFrame:
    """The stand-alone H5 account-opening table."""
    return r.with_date(r.with_dimensions(opening_measures(rows), "-1", True), dt)


# --- merge -------------------------------------------------------------------

def join_by_channel(views: DataFrame, opened: DataFrame) -> DataFrame:
    """Full outer join of both results, with the side(s) a channel came from."""
    both = views.withColumn("in_views", F.lit(True)).join(
        opened.withColumn("in_events", F.lit(True)), "channel", "full_outer"
    )
    side = (
        F.when(F.col("in_views") & F.col("in_events"), "pairs")
        .when(F.col("in_views"), "pv copy")
        .otherwise("event copy")
    )
    return both.withColumn("side", side).drop("in_views", "in_events")


def merged_report(view_rows: DataFrame, event_rows: DataFrame, dt: str | None = None,
                  site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """H5 page views and account openings per channel in one table."""
    both = join_by_channel(measures(view_rows, site), opening_measures(event_rows))
    filled = both.select("channel", *[
        F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
        for name in (*VIEW_METRICS, "openacct_num")
    ])
    return r.with_date(r.with_dimensions(filled, "-1", True), dt)


def merge_coverage(view_rows: DataFrame, event_rows: DataFrame,
                   site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Channels found on both sides, in page views only, in events only."""
    both = join_by_channel(measures(view_rows, site), opening_measures(event_rows))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n"))
