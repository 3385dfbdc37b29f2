"""Page traffic of the news and private-fund sections, and ad-slot clicks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.pages import module_accepts, news_page_parts, private_fund_page_type
from touchpath.functions.text import is_blank
from touchpath.operators import quality as q
from touchpath.operators import report as r
from touchpath.plans.pc import visitor_invalid
from touchpath.sources.logs import AD_CLICK, PAGE_VIEW

INVALID_PAGE = "INVALID_PAGEID"
HOUR_MS = 3_600_000
SKETCH_LOG2 = 12  # 4,096 registers a sketch
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LOG2 / 2)  # three standard errors of united sketches: 4.9 %


def _check_section(rows: DataFrame, module: str, page_pattern: str, *more) -> DataFrame:
    wrong_module = ~module_accepts(module, F.coalesce("proid", F.lit("")))
    return q.with_reason(
        rows,
        *q.incomplete(rows, PAGE_VIEW.arity),
        (visitor_invalid() | wrong_module, q.INVALID_DATA),
        (~F.col("pageid").rlike(page_pattern), INVALID_PAGE),
        *more,
    )


def check_news(rows: DataFrame) -> DataFrame:
    return _check_section(rows, c.MODULE_NEWS, c.NEWS_PAGE)


def check_private_fund(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    wrong_url = (~F.col("desturl").rlike(site.private_fund), q.INVALID_URL)
    return _check_section(rows, c.MODULE_PRIVATE_FUND, c.PRIVATE_FUND_PAGE, wrong_url)


def news_rejects(rows: DataFrame) -> DataFrame:
    return q.count_outcomes(check_news(rows))


def private_fund_rejects(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return q.count_outcomes(check_private_fund(rows, site))


def _traffic(rows: DataFrame, *keys: str) -> DataFrame:
    """Page views and distinct visitors per key.

    Counting per (key, visitor) first spreads a hot page over all tasks; the second
    step only adds up partial sums.
    """
    per_visitor = rows.groupBy(*keys, "guid").agg(F.count(F.lit(1)).alias("n"))
    return per_visitor.groupBy(*keys).agg(
        r.total_or_zero("n").alias("pv"), F.count("guid").alias("uv")
    )


def news_report(rows: DataFrame, dt: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """pv and uv per news page; hourly or daily, depending on the input files.

    ``by`` names further columns to report by, for example the hourly file of each row.
    """
    pages = _traffic(q.accepted(check_news(rows)), *by, "pageid")
    parts = news_page_parts(F.col("pageid"))
    report = pages.select(
        *by,
        F.lit(int(c.MODULE_NEWS)).alias("proid"),
        F.col("pageid").alias("page_id"),
        *[parts[name].alias(name) for name in ("zid", "newstype", "subtype", "author_id")],
        "pv", "uv",
    )
    return r.with_date(report, dt)


def news_total(rows: DataFrame, dt: str | None = None) -> DataFrame:
    """pv and uv of the whole news section in one row, also without any view."""
    traffic = _traffic(q.accepted(check_news(rows)))
    text = [F.lit("-1").alias(name) for name in ("newstype", "subtype", "author_id")]
    report = traffic.select(
        F.lit(int(c.MODULE_NEWS)).alias("proid"), F.lit("-1").alias("page_id"),
        F.lit(-1).cast(c.ID_TYPE).alias("zid"), *text, "pv", "uv",
    )
    return r.with_date(report, dt)


def news_sketches(rows: DataFrame) -> DataFrame:
    """Per page and hour: pv and a HyperLogLog sketch of the visitors, for `united_sketches`.

    Sketches have a fixed size and are built before the shuffle, which moves one of them per
    page, hour and task instead of every visitor. Rows of times no number can hold are under
    the hour NULL.
    """
    hour = F.floor(F.col("ts").try_cast("long") / HOUR_MS)
    views = q.accepted(check_news(rows)).select("pageid", hour.alias("hour"), "guid")
    return views.groupBy("pageid", "hour").agg(
        F.count(F.lit(1)).alias("pv"), F.hll_sketch_agg("guid", SKETCH_LOG2).alias("visitors"))


def united_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    """pv and estimated uv per key (none: of all rows), from stored sketches of any hours.

    ``uv`` is within `SKETCH_ERROR` of the exact count in 997 of 1,000 cases; up to a few
    hundred visitors it is practically exact. No sketch at all means no visitor.
    """
    united = sketches.groupBy(*keys).agg(
        r.total_or_zero("pv").alias("pv"), F.hll_union_agg("visitors").alias("visitors"))
    return united.withColumn("uv", F.coalesce(F.hll_sketch_estimate("visitors"), F.lit(0))).drop("visitors")


def news_report_estimated(sketches: DataFrame, dt: str | None = None) -> DataFrame:
    """The columns of `news_report` with ``uv`` estimated from stored sketches."""
    parts = news_page_parts(F.col("pageid"))
    report = united_sketches(sketches, "pageid").select(
        F.lit(int(c.MODULE_NEWS)).alias("proid"), F.col("pageid").alias("page_id"),
        *[parts[name].alias(name) for name in ("zid", "newstype", "subtype", "author_id")], "pv", "uv",
    )
    return r.with_date(report, dt)


def news_total_estimated(sketches: DataFrame, dt: str | None = None) -> DataFrame:
    """The columns of `news_total` with ``uv`` estimated from stored sketches."""
    text = [F.lit("-1").alias(name) for name in ("newstype", "subtype", "author_id")]
    report = united_sketches(sketches).select(
        F.lit(int(c.MODULE_NEWS)).alias("proid"), F.lit("-1").alias("page_id"),
        F.lit(-1).cast(c.ID_TYPE).alias("zid"), *text, "pv", "uv",
    )
    return r.with_date(report, dt)


def private_fund_report(rows: DataFrame, dt: str | None = None,
                        site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """pv and uv per private-fund page."""
    pages = _traffic(q.accepted(check_private_fund(rows, site)), "pageid")
    report = pages.select(
        F.lit(int(c.MODULE_PRIVATE_FUND)).alias("proid"),
        F.col("pageid").try_cast(c.ID_TYPE).alias("page_id"),
        private_fund_page_type(F.col("pageid")).alias("page_type"),
        "pv", "uv",
    )
    return r.with_date(report, dt)


def check_ads(rows: DataFrame) -> DataFrame:
    tag = F.col("tag")
    return q.with_reason(
        rows,
        *q.incomplete(rows, AD_CLICK.arity),
        (visitor_invalid(), q.INVALID_DATA),
        (is_blank(tag), "NO_TAG"),
        ((tag == c.AD_TAG_RESERVED) | ~tag.rlike(c.AD_TAG), "INVALID_TAG"),
    )


def ad_rejects(rows: DataFrame) -> DataFrame:
    return q.count_outcomes(check_ads(rows))


def ad_report(rows: DataFrame, dt: str | None = None) -> DataFrame:
    """Clicks per ad slot, product and page, in this order.

    A blank product means the site's own ads.
    """
    clicks = q.accepted(check_ads(rows)).select(
        "tag",
        F.when(is_blank(F.col("proid")), c.MODULE_AD).otherwise(F.col("proid")).alias("proid"),
        F.when(is_blank(F.col("pageid")), "").otherwise(F.col("pageid")).alias("page_id"),
    )
    key = ("tag", "proid", "page_id")
    counted = clicks.groupBy(*key).agg(F.count(F.lit(1)).alias("click_num"))
    return r.with_date(counted, dt).orderBy(*key)
