"""Channel expressions: referrers, tags, levels, groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.text import is_blank


def host(url: Column) -> Column:
    """Host of a URL; NULL when there is none or the URL is malformed."""
    return F.try_parse_url(url, F.lit("HOST"))


def is_uri(url: Column) -> Column:
    """True when the text follows the URI syntax (even without a host)."""
    return F.coalesce(
        F.try_parse_url(url, F.lit("PROTOCOL")),
        F.try_parse_url(url, F.lit("PATH")),
    ).isNotNull()


def channel_of_host(name: Column) -> Column:
    """Channel code of the first listed domain the host contains, else NULL."""
    (domain, code), *rest = c.REFERRER_DOMAINS
    first = F.when(name.contains(domain), code)
    return reduce(lambda case, row: case.when(name.contains(row[0]), row[1]), rest, first)


def referrer_channel(url: Column) -> Column:
    return channel_of_host(host(url))


def is_search(code: Column) -> Column:
    return code.isin(*c.SEARCH_CODES)


def is_portal(code: Column) -> Column:
    return code.isin(*c.PORTAL_CODES)


def is_promo_tag(code: Column) -> Column:
    return code.rlike(c.PROMO)


def htag_parts(htag: Column) -> Column:
    """Struct (valid, level, body); level and body are NULL for an invalid tag."""
    valid = htag.rlike(c.HTAG)
    return F.struct(
        valid.alias("valid"),
        F.when(valid, F.split_part(htag, F.lit("."), F.lit(1))).alias("level"),
        F.when(valid, F.split_part(htag, F.lit("."), F.lit(2))).alias("body"),
    )


def channel_levels(code: Column) -> Column:
    """Codes a channel is reported under: three prefixes of a promotion tag, else itself."""
    prefixes = F.array(*[F.substring(code, 1, n) for n in c.PROMO_LENGTHS])
    return F.when(is_promo_tag(code), prefixes).otherwise(F.array(code))


def channel_group(code: Column) -> Column:
    """Summary group of a channel; NULL for codes outside the known set."""
    return (
        F.when(code == c.DIRECT, c.ALL_DIRECT)
        .when((code == c.OTHER) | is_portal(code), c.ALL_OTHER)
        .when(is_search(code), c.ALL_SEARCH)
        .when(is_promo_tag(code), c.ALL_PROMO)
    )


def otrack_channel(otrack: Column) -> Column:
    """Channel named by an otrack value; NULL when the value is blank."""
    body = F.split_part(otrack, F.lit("-"), F.lit(1))
    known = is_promo_tag(body) | body.rlike(c.SEARCH) | body.isin(c.DIRECT, c.OTHER)
    return (
        F.when(is_blank(otrack, ignore_case=True), F.lit(None).cast("string"))
        .when(~otrack.rlike(c.OTRACK), c.OTHER)
        .when(body == "0", c.DIRECT)
        .when(known, body)
        .otherwise(c.OTHER)
    )


def is_summary(code: Column) -> Column:
    return code.isin(c.ALL, *c.GROUPS)


def channel_type(code: Column) -> Column:
    """1 direct, 2 other, 3 search, 4 promotion, 5 summary, -1 unknown."""
    return (
        F.when(is_summary(code), 5)
        .when(code == c.DIRECT, 1)
        .when(code == c.OTHER, 2)
        .when(code.rlike(c.PROMO_CODE), 4)
        .when(is_search(code), 3)
        .when(is_portal(code), 2)
        .otherwise(-1)
    )


def channel_level(code: Column) -> Column:
    kind = channel_type(code)
    return (
        F.when(kind == -1, "-1")
        .when(kind != 4, "1")
        .when(F.length(code) == 3, "1")
        .when(F.length(code) == 6, "2")
        .otherwise("3")
    )


def channel_parent(code: Column, top: str | None = None) -> Column:
    """Parent code; ``top`` is what top-level channels carry (NULL or ``-1``)."""
    kind = channel_type(code)
    return (
        F.when(kind == -1, "-1")
        .when((kind == 4) & (F.length(code) == 6), F.substring(code, 1, 3))
        .when((kind == 4) & (F.length(code) == 10), F.substring(code, 1, 6))
        .otherwise(F.lit(top).cast("string"))
    )
