"""First login per device and customer, and its merge into the stored state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions.text import to_long
from touchpath.operators import quality as q
from touchpath.sources.logs import APP_LOGIN
from touchpath.sources.tables import LOGIN_STATE

_TIMES = ("chuxuguan_firsttime", "zhangji_firsttime")


def _custno(decrypt: Callable[[Column], Column] | None) -> Column:
    """Customer number: blank stays blank, ``0`` stays ``0``, undecodable becomes ``0``."""
    raw = F.col("custno")
    if decrypt is None:
        return F.coalesce(raw, F.lit("0"))
    return F.when(raw.isin("", "0"), raw).otherwise(F.coalesce(decrypt(raw), F.lit("0")))


def check(rows: DataFrame, decrypt: Callable[[Column], Column] | None = None) -> DataFrame:
    """App records with device id, platform flag and ``reject`` reason.

    Android apps are identified by IMEI (flag 1), iOS apps by their own id (flag 2).
    """
    if "reject" in rows.columns:
        return rows
    product = F.col("proid")
    android, ios = product.isin(*c.APP_ANDROID), product.isin(*c.APP_IOS)
    rows = rows.withColumns({
        "custno": _custno(decrypt),
        "deviceid": F.when(android, F.col("imei")).when(ios, F.col("ios_guid")).otherwise(""),
        "flag": F.when(android, 1).when(ios, 2).otherwise(-1),
    })
    known = F.coalesce(android | ios, F.lit(False))
    unusable = F.col("deviceid").rlike(c.DEVICE_ID_UNUSABLE) & (F.col("custno") == "0")
    return q.with_reason(
        rows,
        *q.incomplete(rows, APP_LOGIN.arity),
        (q.no_time(to_long(F.col("ts"))), q.INVALID_TIME),
        (F.col("type").try_cast("int").isNull(), "INVALID_TYPE"),
        (unusable, "INVALID_DEVICE"),
        (~known, "UNKNOWN_PRODUCT"),
    )


def rejects(rows: DataFrame) -> DataFrame:
    return q.count_outcomes(check(rows))


def logins(rows: DataFrame, decrypt: Callable[[Column], Column] | None = None) -> DataFrame:
    return q.accepted(check(rows, decrypt)).select(
        "deviceid", "custno", "proid", to_long(F.col("ts")).alias("ts"),
        F.col("type").try_cast("int").alias("type"), "flag",
    )


def first_logins(valid: DataFrame) -> DataFrame:
    """First time per app family, and the platform of the earliest record."""
    def first_time(products: tuple[str, ...]) -> Column:
        return F.timestamp_millis(F.min(F.when(F.col("proid").isin(*products), F.col("ts"))))

    return valid.groupBy("deviceid", "custno").agg(
        first_time(c.APP_SAVINGS).alias("chuxuguan_firsttime"),
        first_time(c.APP_FUND).alias("zhangji_firsttime"),
        F.min(F.struct("ts", "flag"))["flag"].alias("flag"),
    )


def _matched(new: DataFrame, state: DataFrame, how: str) -> DataFrame:
    stored = state.select(
        "deviceid", "custno",
        *[F.col(name).alias(f"old_{name}") for name in (*_TIMES, "flag", "ts")],
        F.lit(True).alias("stored"),
    )
    rows = new.withColumn("seen", F.lit(True)).join(stored, ["deviceid", "custno"], how)
    complete = F.col("old_chuxuguan_firsttime").isNotNull() & F.col(
        "old_zhangji_firsttime"
    ).isNotNull()
    change = (
        F.when(F.col("stored").isNull(), "insert")
        .when(F.col("seen") & ~complete, "update")
        .otherwise("keep")
    )
    changed = F.col("change") != "keep"
    return rows.withColumn("change", change).select(
        "deviceid",
        "custno",
        *[F.coalesce(f"old_{name}", name).alias(name) for name in _TIMES],
        F.when(changed, F.col("flag")).otherwise(F.col("old_flag")).alias("flag"),
        F.when(changed, F.current_timestamp()).otherwise(F.col("old_ts")).alias("ts"),
        "change",
    )


def state_changes(new: DataFrame, state: DataFrame) -> DataFrame:
    """Rows to insert or update: stored times win, complete rows are left alone."""
    return _matched(new, state, "left").where(F.col("change") != "keep")


def upsert_state(new: DataFrame, state: DataFrame) -> DataFrame:
    """The whole state after the merge; write it to a new version of the state table."""
    return _matched(new, state, "full_outer").select(*LOGIN_STATE, "change")
