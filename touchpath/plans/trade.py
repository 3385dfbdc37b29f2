"""Trades, card bindings and account openings per channel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.channels import (
    channel_group,
    channel_levels,
    is_summary,
    otrack_channel,
)
from touchpath.functions.labels import is_trade_action
from touchpath.functions.text import is_blank, to_long
from touchpath.operators import quality as q
from touchpath.operators import report as r
from touchpath.operators.carry import SLOT_MS, attribute_rows, attributed
from touchpath.sources.logs import TRADE

_SUMS = {"bills": "bigint", "amt": c.AMOUNT_TYPE, "bind_card": "bigint", "open_acct": "bigint"}


def amount(name: str = "amt"):
    """Exact amount; NULL where the text is none, or would have to be rounded."""
    text = F.trim(F.col(name).cast("string"))
    value = text.try_cast(c.AMOUNT_TYPE)
    return F.when(text.rlike(c.AMOUNT_TEXT) & (F.abs(value) < F.lit(c.AMOUNT_LIMIT)), value)


def check(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    """Trade events with their ``reject`` reason.

    The amount matters for trades only; other actions may carry anything there.
    """
    kind = F.col("type")
    blank_key = is_blank(F.col("guid"), True) | is_blank(F.col("ts"), True)
    return q.with_reason(
        rows,
        *q.incomplete(rows, TRADE.arity),
        (~F.coalesce(kind.isin(*c.REPORTED_ACTIONS), F.lit(False)), "OTHER_ACTION"),
        (F.coalesce(F.col("tx_rslt") == "0", F.lit(False)), "FAILED"),
        (~F.col("url").rlike(site.landing), q.INVALID_URL),
        (blank_key, q.INVALID_DATA),
        (to_long(F.col("ts")).isNull(), q.INVALID_TIME),
        (is_trade_action(kind) & amount().isNull(), "INVALID_AMOUNT"),
    )


def valid(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return (
        q.accepted(check(rows, site))
        .withColumn("ts", to_long(F.col("ts")))
        .withColumn("amt", amount())
    )


def rejects(rows: DataFrame, site: c.Site = c.DEFAULT_SITE) -> DataFrame:
    return q.count_outcomes(check(rows, site))


def failures(rows: DataFrame) -> DataFrame:
    """Failed trades per action."""
    counters = [F.when(F.col("type") == code, name) for code, name in c.FAILURE_COUNTERS.items()]
    failed = check(rows).where(F.col("reject") == "FAILED")
    named = failed.select(F.coalesce(*counters).alias("failure"))
    return named.where("failure IS NOT NULL").groupBy("failure").agg(F.count(F.lit(1)).alias("n"))


def anomalies(events: DataFrame) -> DataFrame:
    """Accepted trade events whose otrack is there but badly formed."""
    otrack = F.col("otrack")
    bad = ~is_blank(otrack, True) & ~otrack.rlike(c.OTRACK)
    return events.agg(F.count_if(bad).alias("bad_otrack"))


def _sums():
    return [F.sum(name).cast(kind).alias(name) for name, kind in _SUMS.items()]


def _assign(events: DataFrame) -> DataFrame:
    return events.withColumns({"assigned": otrack_channel(F.col("otrack")), "direct": F.lit(False)})


def attribute(events: DataFrame, keep: tuple[str, ...] = (), slot_ms: int = SLOT_MS) -> DataFrame:
    """Channel of every trade event, with the ``keep`` columns."""
    return attribute_rows(_assign(events), keep, slot_ms)


def visitor_channels(events: DataFrame, slot_ms: int = SLOT_MS) -> DataFrame:
    """Trades, amount, bindings and openings per visitor and channel, to be added up."""
    kind = F.col("type")
    is_trade = is_trade_action(kind)
    rows = _assign(events).select(
        "guid", "ts", "assigned", "direct", is_trade.cast("bigint").alias("bills"),
        F.when(is_trade, F.col("amt")).cast(c.AMOUNT_TYPE).alias("amt"),
        (kind == c.ACTION_BIND_CARD).cast("bigint").alias("bind_card"),
        (kind == c.ACTION_OPEN_ACCOUNT).cast("bigint").alias("open_acct"),
    )
    return attributed(rows, _SUMS, slot_ms=slot_ms).drop("falls_back")


def channel_measures(visits: DataFrame) -> DataFrame:
    """Persons, bills, amount, bindings, openings per code: details, groups, total.

    A person counts for a channel with any trade, for a group with a positive amount in
    the group. The grand total adds up only the positive group amounts of each visitor
    and counts the visitors where they are positive.
    """
    codes = channel_levels(F.col("channel"))
    with_group = F.concat(codes, F.array(channel_group(F.col("channel"))))
    per_code = (
        visits.select("guid", F.explode(with_group).alias("code"), *_SUMS)
        .groupBy("guid", "code")
        .agg(*_sums())
    )
    # both steps stay in the visitor's partition
    positive = F.greatest(F.col("amt"), F.lit(0).cast(c.AMOUNT_TYPE))
    zero = F.lit(0).cast(c.AMOUNT_TYPE)
    row = [F.col(name) for name in ("bills", "bind_card", "open_acct")]
    as_is = F.struct(F.col("code"), F.coalesce("amt", zero).alias("amt"), *row)
    in_total = F.struct(F.lit(c.ALL).alias("code"), F.coalesce(positive, zero).alias("amt"), *row)
    is_group = F.col("code").isin(*c.GROUPS)
    per_visitor = (
        per_code.select(
            "guid", F.inline(F.when(is_group, F.array(as_is, in_total)).otherwise(F.array(as_is)))
        )
        .groupBy("guid", "code")
        .agg(*_sums())
    )
    by_amount = F.count_if(F.col("amt") > 0)
    by_bills = F.count_if(F.col("bills") > 0)
    return (
        r.add_zero_summaries(per_visitor.drop("guid"))
        .groupBy(F.col("code").alias("channel"))
        .agg(
            F.when(is_summary(F.col("code")), by_amount).otherwise(by_bills).alias("persons"),
            r.total_or_zero("bills").alias("bills"),
            F.coalesce(F.sum("amt"), zero).cast(c.AMOUNT_TYPE).alias("amt"),
            r.total_or_zero("bind_card").alias("bind_card"),
            r.total_or_zero("open_acct").alias("open_acct"),
        )
    )


def measures(rows: DataFrame, site: c.Site = c.DEFAULT_SITE, slot_ms: int = SLOT_MS) -> DataFrame:
    return channel_measures(visitor_channels(valid(rows, site), slot_ms))


def trade_report(rows: DataFrame, dt: str | None = None, site: c.Site = c.DEFAULT_SITE,
                 slot_ms: int = SLOT_MS) -> DataFrame:
    """The channel trade table."""
    return r.with_date(r.with_dimensions(measures(rows, site, slot_ms)), dt)


def amount_totals(rows: DataFrame) -> DataFrame:
    """Total saved and bought amounts, and the one-line text of the totals job.

    No validity test besides completeness. Text amounts keep the largest scale found in
    the input. ``other`` is always 0: only the two actions are read. ``n_rejected`` counts
    their rows whose amount cannot be read exactly.
    """
    complete = rows.where(F.col("n_fields") == TRADE.arity) if "n_fields" in rows.columns else rows
    wanted = complete.where(F.col("type").isin(c.ACTION_SAVE, c.ACTION_BUY_FUND))
    value = amount()
    digits = F.when(value.isNotNull(), F.length(F.regexp_extract("amt", r"\.(\d+)$", 1)))

    def of(action: str):
        is_action = F.col("type") == action
        return (
            F.coalesce(F.sum(F.when(is_action, value)), F.lit(0)).cast(c.AMOUNT_TYPE),
            F.coalesce(F.max(F.when(is_action, digits)), F.lit(0)),
        )

    (pig, pig_scale), (buy, buy_scale) = of(c.ACTION_SAVE), of(c.ACTION_BUY_FUND)
    sums = wanted.agg(
        pig.alias("pigamt"), buy.alias("buyamt"), pig_scale.alias("pig_scale"),
        buy_scale.alias("buy_scale"), F.lit(0).cast(c.AMOUNT_TYPE).alias("other"),
        F.count_if(value.isNull()).alias("n_rejected"),
    )

    def text(name: str, scale: str):
        plain = F.col(name).cast("string")
        more = F.repeat(F.lit("0"), F.greatest(F.col(scale) - c.AMOUNT_SCALE, F.lit(0)))
        cut = F.length(plain) - c.AMOUNT_SCALE + F.col(scale)
        return F.left(F.concat(plain, more), F.when(F.col(scale) == 0, cut - 1).otherwise(cut))

    line = F.concat(
        F.lit("pigamt:"), text("pigamt", "pig_scale"), F.lit(",buyamt:"),
        text("buyamt", "buy_scale"), F.lit(",other:0"),
    )
    return sums.select("pigamt", "buyamt", "other", "n_rejected", line.alias("line"))
