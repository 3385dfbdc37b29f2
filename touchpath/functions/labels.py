"""Code-to-label lookups for actions and modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchpath import config as c


def _lookup(code: Column, labels: dict[str, str], default: Column) -> Column:
    pairs = [F.lit(x) for item in labels.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), default)


def action_label(code: Column, default: str | None = None) -> Column:
    return _lookup(code, c.ACTIONS, F.lit(default).cast("string"))


def module_label(code: Column, default: str | None = None) -> Column:
    return _lookup(code, c.MODULES, F.lit(default).cast("string"))


def is_trade_action(code: Column) -> Column:
    return code.isin(*c.TRADE_ACTIONS)
