"""Page-id expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpath import config as c


def news_page_parts(page_id: Column) -> Column:
    """News page id = item id, 3 digits news type, 4 digits subtype, 5 digits author, 3."""
    tail = F.right(page_id, F.lit(13))
    return F.struct(
        F.left(page_id, F.length(page_id) - 13).try_cast(c.ID_TYPE).alias("zid"),
        F.substring(tail, 1, 3).alias("newstype"),
        F.substring(tail, 4, 4).alias("subtype"),
        F.substring(tail, 8, 5).alias("author_id"),
    )


def private_fund_page_type(page_id: Column) -> Column:
    return F.right(page_id, F.lit(2)).try_cast("int")


def is_private_fund_page(page_id: Column) -> Column:
    return page_id.endswith("2")


def funnel_step(page_id: Column) -> Column:
    """Name of the account-opening step a page belongs to, else NULL."""
    cases = [F.when(page_id.endswith(end), step) for step, end in c.FUNNEL_SUFFIXES.items()]
    return F.coalesce(*cases)


def module_accepts(module: str, product: Column) -> Column:
    """The product id is a prefix of the module id; an empty product id passes."""
    return F.lit(module).startswith(product)
