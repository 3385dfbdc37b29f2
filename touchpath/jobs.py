"""One function per daily or hourly job: read the logs, build the report, hand it on.

Jobs with ``rejects`` count the outcome of every row of their logs while the report runs, in
the same scan, and hand ``rejects(outcomes, log)`` the columns dt, log, reason and n.

``write(report, table)`` receives the finished report and the name of its table, for
example ``partial(append_jdbc, options=...)`` or ``partial(append_parquet, root=...)``
from `touchpath.sources.tables`. ``dt`` is the statistic date; without one it is today.
"""

from __future__ import annotations

import datetime as dt_
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from touchpath import state
from touchpath.config import DEFAULT_SITE, Site
from touchpath.functions.crypto import decrypt_column
from touchpath.operators import quality
from touchpath.operators.report import statistic_date
from touchpath.plans import app, h5, misc, pages, pc, trade
from touchpath.sources import logs
from touchpath.sources.tables import news_table

Paths = str | Sequence[str]
Write = Callable[[DataFrame, str], None]
Rejects = Callable[[DataFrame, str], None]


class _Watch:
    """Observes the checks of a job's logs, and hands on the counts once the job has run."""

    def __init__(self, rejects: Rejects | None, dt: str | None) -> None:
        self.rejects, self.dt, self.logs = rejects, dt, []

    def __call__(self, checked: DataFrame, log: str) -> DataFrame:
        if self.rejects is None:
            return checked
        self.logs.append((log, Observation(), checked.sparkSession))
        return quality.observe_checks(checked, self.logs[-1][1])

    def report(self) -> None:
        for log, observation, spark in self.logs:
            found = quality.observed_outcomes(spark, observation)
            self.rejects(found.select(statistic_date(self.dt).alias("dt"), F.lit(log).alias("log"), "reason", "n"), log)


def pc_channels(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
                site: Site = DEFAULT_SITE, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(pc.check(logs.read_log(spark, paths, logs.PAGE_VIEW), site), "page views")
    write(pc.channel_report(rows, dt, site), "channel_view_stat")
    watch.report()


def trade_channels(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
                   site: Site = DEFAULT_SITE, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(trade.check(logs.read_log(spark, paths, logs.TRADE), site), "trades")
    write(trade.trade_report(rows, dt, site), "channel_trade_stat")
    watch.report()


def h5_channels(spark: SparkSession, view_paths: Paths, event_paths: Paths, write: Write,
                dt: str | None = None, site: Site = DEFAULT_SITE, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    views = watch(h5.check(logs.read_log(spark, view_paths, logs.PAGE_VIEW), site), "H5 page views")
    events = watch(h5.check_events(logs.read_log(spark, event_paths, logs.H5_EVENT)), "H5 events")
    write(h5.merged_report(views, events, dt, site), "channel_view_trade_stat_h5")
    watch.report()


def h5_views(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
             site: Site = DEFAULT_SITE, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(h5.check(logs.read_log(spark, paths, logs.PAGE_VIEW), site), "H5 page views")
    write(h5.view_report(rows, dt, site), "channel_view_stat_h5")
    watch.report()


def h5_openings(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
                rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(h5.check_events(logs.read_log(spark, paths, logs.H5_EVENT)), "H5 events")
    write(h5.opening_report(rows, dt), "channel_trade_stat_h5")
    watch.report()


def previous_hour(now: dt_.datetime | None = None) -> int:
    return ((now or dt_.datetime.now()).hour - 1) % 24


def news_hourly(spark: SparkSession, root: str, write: Write, dt: str,
                hour: int | str | None = None, rejects: Rejects | None = None) -> None:
    """News pages of one hour (the previous one by default), from the files ``*<dt>.<hour>``."""
    hour = previous_hour() if hour in (None, "") else hour
    if not str(hour).isdigit():
        raise ValueError(f"hour must be a number, not {hour!r}")
    path = logs.hourly_glob(root, dt, int(hour))
    watch = _Watch(rejects, dt)
    rows = watch(pages.check_news(logs.read_log(spark, path, logs.PAGE_VIEW)), "news page views")
    write(pages.news_report(rows, dt), news_table(hourly=True))
    watch.report()


def news_daily(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
               rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(pages.check_news(logs.read_log(spark, paths, logs.PAGE_VIEW)), "news page views")
    write(pages.news_report(rows, dt), news_table(hourly=False))
    watch.report()


def news_section(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
                 hourly: bool = False, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(pages.check_news(logs.read_log(spark, paths, logs.PAGE_VIEW)), "news page views")
    write(pages.news_total(rows, dt), news_table(hourly))
    watch.report()


def private_fund_pages(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
                       site: Site = DEFAULT_SITE, rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(pages.check_private_fund(logs.read_log(spark, paths, logs.PAGE_VIEW), site), "private-fund page views")
    write(pages.private_fund_report(rows, dt, site), "channel_page_pv_uv_simu")
    watch.report()


def ad_clicks(spark: SparkSession, paths: Paths, write: Write, dt: str | None = None,
              rejects: Rejects | None = None) -> None:
    watch = _Watch(rejects, dt)
    rows = watch(pages.check_ads(logs.read_log(spark, paths, logs.AD_CLICK)), "ad clicks")
    write(pages.ad_report(rows, dt), "channel_ad_click")
    watch.report()


def app_first_logins(spark: SparkSession, paths: Paths, state: DataFrame, key: str) -> DataFrame:
    """Rows of the login state to insert or update (column ``change``).

    ``state`` is the stored table, from `read_jdbc` or Parquet; apply the result with
    `upsert_jdbc`, or write `touchpath.plans.app.upsert_state` as a new table version.
    """
    rows = logs.read_log(spark, paths, logs.APP_LOGIN)
    valid = app.logins(rows, lambda custno: decrypt_column(custno, key))
    return app.state_changes(app.first_logins(valid), state)


def app_login_state(spark: SparkSession, paths: Paths, root: str, batch: str,
                    decrypt: Callable | None = None, rejects: Rejects | None = None) -> state.Version:
    """Merge the first logins of the logs into the stored state under ``root``, once per ``batch``.

    ``decrypt`` turns the customer number column into the plain one; without it numbers are
    plain. A batch that is merged already is not read again and reports no rejects.
    """
    watch = _Watch(rejects, None)
    rows = watch(app.check(logs.read_log(spark, paths, logs.APP_LOGIN), decrypt), "app logins")
    held = state.current(spark, root)
    if held and batch in held.batches:
        return held
    version = state.merge(spark, root, app.first_logins(app.logins(rows, decrypt)), batch)
    watch.report()
    return version


def amount_totals(spark: SparkSession, paths: Paths, out: str) -> None:
    """The one-line total as a text file."""
    totals = trade.amount_totals(logs.read_log(spark, paths, logs.TRADE))
    totals.select(F.col("line").alias("value")).write.text(out)


def word_count(spark: SparkSession, paths: Paths, out: str) -> None:
    misc.write_word_count(misc.word_count(logs.read_lines(spark, paths)), out)


def secondary_sort(spark: SparkSession, paths: Paths, out: str) -> None:
    pairs = logs.read_int_pairs(logs.read_lines(spark, paths))
    misc.write_secondary_sort(misc.secondary_sort(pairs), out)
