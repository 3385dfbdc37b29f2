"""Relational tables: report targets, state lookups, counts.

JDBC options (url, user, password, driver, partitioning) always come from the
caller; nothing about a concrete database is stored here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import FIELD_SEPARATOR

# --- fixed values: report tables and their columns ---------------------------
_NEWS = (
    "dt", "proid", "page_id", "zid", "newstype", "subtype", "author_id", "pv", "uv",
    "create_time",
)
_CHANNEL = ("channel_type", "channel_parent", "channel_level")
_H5_VIEW = (
    "dt", "channel", "pv", "uv", "enter", "huodong_index", "openacct_index", "auth_index",
    "open_result_index",
)
REPORT_TABLES: dict[str, tuple[str, ...]] = {
    "channel_view_stat": (
        "dt", "channel", "pv", "uv", "validuv", "enter", "gmuv", "simuuv", *_CHANNEL,
        "createtime",
    ),
    "channel_trade_stat": (
        "dt", "channel", "persons", "bills", "amt", "bind_card", "open_acct", *_CHANNEL,
        "createtime",
    ),
    "channel_page_pv_uv_news_today": _NEWS,
    "channel_page_pv_uv_news_his": _NEWS,
    "channel_page_pv_uv_simu": (
        "dt", "proid", "page_id", "page_type", "pv", "uv", "create_time",
    ),
    "channel_ad_click": ("dt", "tag", "proid", "page_id", "click_num", "create_time"),
    "channel_view_trade_stat_h5": (*_H5_VIEW, "openacct_num", *_CHANNEL, "create_time"),
    "channel_view_stat_h5": (*_H5_VIEW, *_CHANNEL, "create_time"),
    "channel_trade_stat_h5": ("dt", "channel", "openacct_num", *_CHANNEL, "create_time"),
}
LOGIN_STATE = (
    "deviceid", "custno", "chuxuguan_firsttime", "zhangji_firsttime", "flag", "ts",
)


def news_table(hourly: bool) -> str:
    return f"channel_page_pv_uv_news_{'today' if hourly else 'his'}"


def for_table(report: DataFrame, table: str) -> DataFrame:
    """The report in the column order of its table, with the creation time filled in."""
    columns = REPORT_TABLES[table]
    return report.withColumn(columns[-1], F.current_timestamp()).select(*columns)


def append_jdbc(report: DataFrame, table: str, options: Mapping[str, str]) -> None:
    """Append a report to its database table."""
    (for_table(report, table).write.format("jdbc").options(**options)
     .option("dbtable", table).mode("append").save())


def append_parquet(report: DataFrame, table: str, root: str) -> None:
    """Append a report to its Parquet table, one directory per statistic date."""
    for_table(report, table).write.partitionBy("dt").mode("append").parquet(f"{root}/{table}")


def replace_days_parquet(report: DataFrame, table: str, root: str) -> None:
    """Write a report to its Parquet table in place of what the table holds for its dates.

    Other dates stay as they are, so a job may be repeated for its day.
    """
    (for_table(report, table).write.partitionBy("dt").option("partitionOverwriteMode", "dynamic")
     .mode("overwrite").parquet(f"{root}/{table}"))


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    """A database table as one distributed scan.

    Pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` for
    large tables; filters, projections and counts are pushed to the database.
    """
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def count_rows(table: DataFrame, condition: Column | None = None) -> DataFrame:
    """Row count under a condition; JDBC and Parquet scans evaluate it at the source."""
    rows = table if condition is None else table.where(condition)
    return rows.agg(F.count(F.lit(1)).alias("n"))


def append_delimited(rows: DataFrame, path: str) -> None:
    """Append rows as control-A separated text; NULL becomes an empty field."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in rows.columns]
    rows.select(F.concat_ws(FIELD_SEPARATOR, *fields).alias("value")).write.mode("append").text(path)


def merge_statement(table: str, staging: str) -> str:
    """MERGE that applies staged login-state changes to the state table.

    Staged rows are made distinct first: a retried write task may stage a row twice.
    """
    source = f"SELECT DISTINCT {', '.join(LOGIN_STATE)} FROM {staging}"
    updated = ", ".join(f"{col} = s.{col}" for col in LOGIN_STATE[2:])
    inserted = ", ".join(LOGIN_STATE)
    values = ", ".join(f"s.{col}" for col in LOGIN_STATE)
    return (
        f"MERGE INTO {table} t USING ({source}) s "
        "ON t.deviceid = s.deviceid AND t.custno = s.custno "
        f"WHEN MATCHED THEN UPDATE SET {updated} "
        f"WHEN NOT MATCHED THEN INSERT ({inserted}) VALUES ({values})"
    )


def upsert_jdbc(
    changes: DataFrame,
    table: str,
    staging: str,
    options: Mapping[str, str],
    execute: Callable[[str], None],
) -> None:
    """Stage the changed rows in bulk, then apply them with one MERGE.

    ``execute`` runs one statement on the caller's database connection.
    """
    (changes.select(*LOGIN_STATE).write.format("jdbc").options(**options)
     .option("dbtable", staging).mode("overwrite").save())
    execute(merge_statement(table, staging))
