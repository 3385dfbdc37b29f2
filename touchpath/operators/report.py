"""Pieces shared by the channel reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.channels import (
    channel_group,
    channel_level,
    channel_levels,
    channel_parent,
    channel_type,
    is_summary,
)


def statistic_date(dt: str | None) -> Column:
    """Date of the report: the job argument, today when it is empty."""
    return F.lit(dt).cast("date") if dt else F.current_date()


def reported_codes(channel: Column) -> Column:
    """Codes one event counts for: its channel levels, its group and the grand total."""
    return F.concat(
        channel_levels(channel), F.array(channel_group(channel)), F.array(F.lit(c.ALL))
    )


def add_zero_summaries(measures: DataFrame, key: str = "code") -> DataFrame:
    """Add an all-NULL row for each group and the total, so that empty ones appear too.

    The rows carry no visitor, therefore they must be added after the per-visitor step.
    """
    spark = measures.sparkSession
    codes = F.explode(F.array(*[F.lit(code) for code in (*c.GROUPS, c.ALL)])).alias(key)
    zeros = spark.range(0, 1, 1, 1).select(codes)
    return measures.unionByName(zeros, allowMissingColumns=True)


def details(report: DataFrame) -> DataFrame:
    return report.where(~is_summary(F.col("channel")))


def groups(report: DataFrame) -> DataFrame:
    return report.where(F.col("channel").isin(*c.GROUPS))


def total(report: DataFrame) -> DataFrame:
    return report.where(F.col("channel") == c.ALL)


def with_dimensions(report: DataFrame, top_parent: str | None = None,
                    type_as_text: bool = False) -> DataFrame:
    """Add channel type, parent and level. H5 tables keep the type as text, parent ``-1``."""
    code = F.col("channel")
    kind = channel_type(code)
    return report.select(
        "*",
        (kind.cast("string") if type_as_text else kind).alias("channel_type"),
        channel_parent(code, top_parent).alias("channel_parent"),
        channel_level(code).alias("channel_level"),
    )


def with_date(report: DataFrame, dt: str | None) -> DataFrame:
    return report.select(statistic_date(dt).alias("dt"), "*")


def total_or_zero(value: str | Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
