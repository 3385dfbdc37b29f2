"""PC page views per channel.

A page view is one of four kinds, which depend on the row alone:

* ``A`` assigns a channel (referrer or promotion tag);
* ``D`` direct candidate: a tag without referrer. The first one of a visitor assigns
  DIRECT unless the visitor already fell back to DIRECT; a later one counts a DIRECT
  page view but leaves the current channel alone;
* ``C`` carries the current channel on. When a visitor starts with a carry, that row is
  the fallback entry: the visitor is direct from there on, and no ``D`` row assigns;
* ``S`` is ignored (level-0 tag that is no promotion).

The rest follows from the carry-forward of `touchpath.operators.carry`: ``A`` and ``D`` rows
know their channel, ``C`` rows get theirs from the last ``A`` before them, or DIRECT if the
visitor's first ``D`` assigned in between. Rows of one time count in the order of their kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.channels import (
    channel_group,
    channel_of_host,
    host,
    htag_parts,
    is_portal,
    is_promo_tag,
    is_summary,
    is_uri,
)
from touchpath.functions.pages import is_private_fund_page
from touchpath.functions.text import is_blank, to_long
from touchpath.operators import quality as q
from touchpath.operators import report as r
from touchpath.operators.carry import SLOT_MS, attribute_rows, attributed
from touchpath.sources.logs import PAGE_VIEW


FULL, CODE, GROUP, PORTAL = "full", "code", "group", "portal"


def visitor_invalid(ignore_case: bool = False) -> Column:
    """Visitor id and time must be there, the id must start with ``0x``."""
    guid, ts = F.col("guid"), F.col("ts")
    return (
        is_blank(guid, ignore_case)
        | is_blank(ts, ignore_case)
        | ~guid.startswith(c.VISITOR_PREFIX)
    )


def check(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Page-view rows with their ``reject`` reason."""
    return q.with_reason(
        rows,
        *q.incomplete(rows, PAGE_VIEW.arity),
        (visitor_invalid(), q.INVALID_DATA),
        (F.coalesce(F.col("proid") == c.PRODUCT_EXCLUDED_ON_PC, F.lit(False)), "EXCLUDED_PRODUCT"),
        (~F.col("desturl").rlike(site.landing), q.INVALID_URL),
        (to_long(F.col("ts")).isNull(), q.INVALID_TIME),
    )


def valid(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return q.accepted(check(rows, site)).withColumn("ts", to_long(F.col("ts")))


def bad_htag(ignore_case: bool = False) -> Column:
    htag = F.col("htag")
    return ~is_blank(htag, ignore_case) & ~htag.rlike(c.HTAG)


def rejects(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Rows per reject reason; accepted rows with an invalid tag are counted, not dropped."""
    kept_bad = F.count_if(F.col("reject").isNull() & bad_htag()).alias("bad_htag")
    return q.count_outcomes(check(rows, site), kept_bad)


def classify(views: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Add ``kind``, ``assigned`` (channel of ``A`` rows), ``entry`` and ``simu``.

    ``entry`` tells which entry counters a row raises: ``full`` the channel levels and the
    group, ``code`` the channel only, ``group`` the group only. Referrers are parsed only
    where they decide the channel, once per row.
    """
    col, src, htag = F.col, F.col("srcurl"), F.col("htag")
    parts = htag_parts(htag)
    rows = views.withColumns({
        "has_htag": ~is_blank(htag),
        "htag_valid": parts["valid"] & ~is_blank(htag),
        "level0": F.coalesce(parts["level"] == "0", F.lit(False)),
        "body": parts["body"],
        "no_ref": is_blank(src),
    }).withColumns({
        "internal": ~col("no_ref") & src.rlike(site.internal),
        "promo": col("htag_valid") & col("level0") & is_promo_tag(col("body")),
    })
    kind = (
        F.when(col("htag_valid") & col("internal"), "C")
        .when(col("promo"), "A")
        .when(col("htag_valid") & col("level0"), "S")
        .when(col("has_htag") & col("no_ref"), "D")
        .when(col("no_ref") | col("internal"), "C")
        .otherwise("A")
    )
    rows = rows.withColumn("kind", kind).withColumn(
        "by_ref", (col("kind") == "A") & ~col("promo")
    ).withColumn("ref_host", F.when(col("by_ref"), host(src)))
    ref_ok = col("ref_host").isNotNull() | F.when(col("by_ref"), is_uri(src))
    refchan = F.coalesce(channel_of_host(col("ref_host")), F.lit(c.OTHER))
    rows = rows.withColumn("ref_ok", ref_ok)
    return rows.withColumns({
        "assigned": F.when(col("by_ref"), refchan).when(col("kind") == "A", col("body")),
        "entry": (
            F.when((col("kind") == "D") | (col("kind") == "A") & col("promo"), FULL)
            .when(~col("by_ref"), F.lit(None).cast("string"))
            .when(col("ref_ok"), FULL)
            .when(col("has_htag") & ~col("htag_valid"), CODE)
            .otherwise(GROUP)
        ),
        "simu": ~is_blank(col("pageid")) & is_private_fund_page(col("pageid")),
    })


def anomalies(views: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Counts of odd rows among the valid page views, in one pass."""
    rows = classify(views, site)
    col = F.col
    return rows.agg(
        F.count_if(col("has_htag") & ~col("htag_valid")).alias("bad_htag"),
        F.count_if(col("by_ref") & ~col("ref_ok")).alias("bad_referrer"),
        F.count_if(col("htag_valid") & ~col("level0") & col("no_ref")).alias("htag_without_ref"),
        F.count_if(col("kind") == "S").alias("level0_not_promo"),
    )


def _counting(classified: DataFrame) -> DataFrame:
    """Rows that change or use the visitor's state."""
    return classified.where(F.col("kind") != "S").withColumn("direct", F.col("kind") == "D")


def attribute(views: DataFrame, site: c.Site = c.DEFAULT_SITE, keep: tuple[str, ...] = (),
              slot_ms: int = SLOT_MS) -> DataFrame:
    """Channel of every page view (ignored rows left out), with the ``keep`` columns."""
    rows = _counting(classify(views, site)).select("guid", "ts", "kind", "direct", "assigned", *keep)
    found = attribute_rows(rows, (*keep, "kind"), slot_ms, assigns_first=True)
    return found.select("guid", "ts", *keep, "kind", "channel")


def visitor_channels(views: DataFrame, site: c.Site = c.DEFAULT_SITE,
                     slot_ms: int = SLOT_MS) -> DataFrame:
    """Page views, private-fund views and entries per visitor, channel and scope, to be added up.

    The scope tells which codes a count goes to: ``full`` the channel's levels, its group
    and the total, ``code`` the channel only, ``group`` the group and the total,
    ``portal`` views that only count on request.
    """
    rows = _counting(classify(views, site)).select(
        "guid", "ts", "direct", "assigned", "entry",
        F.lit(1).cast("bigint").alias("n"), F.col("simu").cast("bigint").alias("simu"),
    )
    found = attributed(rows, {"n": "bigint", "simu": "bigint"}, ("entry",), slot_ms, assigns_first=True)
    col, zero = F.col, F.lit(0).cast("bigint")

    def count(channel: Column, scope: Column, pv: Column, simu: Column, enter: Column) -> Column:
        return F.struct(
            channel.alias("channel"), scope.alias("scope"), pv.alias("pv"), simu.alias("simu"),
            enter.alias("enter"),
        )

    view_scope = F.when(is_portal(col("channel")), PORTAL).otherwise(FULL)
    viewed = count(col("channel"), view_scope, col("n"), col("simu"), zero)
    entered = count(col("channel"), col("entry"), zero, zero, col("n"))
    fallback = count(F.lit(c.DIRECT), F.lit(FULL), zero, zero, F.lit(1).cast("bigint"))
    counts = (
        F.when(col("falls_back"), F.array(viewed, fallback))
        .when(col("entry").isNotNull(), F.array(viewed, entered)).otherwise(F.array(viewed))
    )
    return found.select("guid", F.inline(counts))


def channel_measures(visits: DataFrame, count_portals: bool = False) -> DataFrame:
    """pv, uv, valid uv, entries and private-fund uv per code: details, groups and total."""
    channel, scope = F.col("channel"), F.col("scope")
    if not count_portals:
        visits = visits.where(scope != PORTAL)
    codes = (
        F.when(scope == CODE, F.array(channel))
        .when(scope == GROUP, F.array(channel_group(channel), F.lit(c.ALL)))
        .otherwise(r.reported_codes(channel))
    )
    per_visitor = (
        visits.select("guid", "pv", "simu", "enter", F.explode(codes).alias("code"))
        .groupBy("guid", "code")
        .agg(*[F.sum(name).alias(name) for name in ("pv", "simu", "enter")])
    )
    return (
        r.add_zero_summaries(per_visitor.drop("guid"))
        .groupBy(F.col("code").alias("channel"))
        .agg(
            r.total_or_zero("pv").alias("pv"),
            F.count_if(F.col("pv") > 0).alias("uv"),
            F.count_if(F.col("pv") > 1).alias("validuv"),
            r.total_or_zero("enter").alias("enter"),
            F.lit(0).cast("bigint").alias("gmuv"),
            F.count_if(F.col("simu") > 0).alias("simuuv"),
        )
    )


def entries(found: DataFrame) -> DataFrame:
    """Entry counts per code."""
    return found.where(F.col("enter") > 0).select("channel", "enter")


def private_fund_visitors(found: DataFrame) -> DataFrame:
    """Visitors with at least one private-fund page, per reported channel."""
    return r.details(found).where(F.col("simuuv") > 0).select("channel", "simuuv")


def measures(rows: DataFrame, site: c.Site = c.DEFAULT_SITE, slot_ms: int = SLOT_MS,
             count_portals: bool = False) -> DataFrame:
    return channel_measures(visitor_channels(valid(rows, site), site, slot_ms), count_portals)


def reported(found: DataFrame) -> DataFrame:
    """Channels with page views, and all summaries."""
    return found.where((F.col("pv") > 0) | is_summary(F.col("channel")))


def channel_report(rows: DataFrame, dt: str | None = None, site: c.Site = c.DEFAULT_SITE,
                   slot_ms: int = SLOT_MS, count_portals: bool = False) -> DataFrame:
    """The channel view table: visited channels at all levels, four groups, grand total."""
    found = measures(rows, site, slot_ms, count_portals)
    return r.with_date(r.with_dimensions(reported(found)), dt)
