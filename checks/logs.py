"""Logs derived from the ``events`` table.

Each log is a dict of column -> SQL expression. The expressions are valid both in Spark
SQL and in DuckDB, so that both sides of a comparison see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchpath.config import DEFAULT_SITE, FIELD_SEPARATOR
from touchpath.sources import logs as layouts

SITE = DEFAULT_SITE.labels[0]
DT, OTHER_DT = "2024-01-31", "2024-02-01"
# logins before this day are already in the stored state
STATE_CUT_MS = 1_704_844_800_000

# independent of the session time zone
SPARK_MS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) div 1000"
DUCKDB_MS = "epoch_us(ts) // 1000"

PROMO = (
    "concat(lpad(CAST(user_id % 3 + 1 AS STRING), 3, '0'), "
    "lpad(CAST(event_id % 2 AS STRING), 3, '0'), "
    "lpad(CAST(event_id % 5 AS STRING), 4, '0'), '900000')"
)

# some page ids have 25 digits and more
WIDE = "CASE WHEN event_id % 5 = 0 THEN '9000000000000000000000' ELSE '' END"

PV_LOG = {
    "event_id": "event_id",
    "guid": "CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 "
            "THEN concat('x', user_id) ELSE concat('0x', user_id) END",
    "ts": "CAST(ms AS STRING)",
    "srcurl": "CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN 'null' "
              "WHEN 2 THEN concat('http://www.baidu.com/s?wd=', event_id) "
              "WHEN 3 THEN 'https://www.google.com/' WHEN 4 THEN 'http://news.qq.com/a' "
              "WHEN 5 THEN 'http://blog.example.com/x' "
              "WHEN 6 THEN 'http://www.baidu.com/s?wd=a b' "
              f"ELSE 'http://www.{SITE}.com/fund/' END",
    "htag": "CASE (event_id * 7 + user_id) % 9 WHEN 4 THEN concat('0.', promo) "
            "WHEN 5 THEN '1.0012345' WHEN 6 THEN 'bad' WHEN 7 THEN '0.123456' "
            "WHEN 8 THEN 'null' ELSE '' END",
    "desturl": f"CASE event_id % 13 WHEN 0 THEN 'http://m.{SITE}.com/' "
               f"WHEN 1 THEN 'http://simu.{SITE}.com/p' WHEN 2 THEN 'http://www.other.org/' "
               f"ELSE 'https://www.{SITE}.com/' END",
    "pageid": "CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN concat(wide, user_id % 50, '12') "
              "WHEN 2 THEN concat(wide, user_id % 9 + 1, '001', '0002', '00003', '3') "
              "WHEN 3 THEN concat(user_id, '21000') WHEN 4 THEN concat(user_id, '21010') "
              "WHEN 5 THEN concat(user_id, '21020') ELSE concat(user_id, '6') END",
    "proid": "CASE event_type WHEN 'error' THEN '5001' WHEN 'signup' THEN '5002' "
             "WHEN 'view' THEN '1001' WHEN 'click' THEN '' ELSE '1' END",
}
TRADE_LOG = {
    "event_id": "event_id",
    "ts": "CAST(ms AS STRING)",
    "type": "CASE event_type WHEN 'purchase' THEN CASE event_id % 3 WHEN 0 THEN '6' "
            "WHEN 1 THEN '8' ELSE '10' END WHEN 'signup' THEN '4' WHEN 'click' THEN '5' "
            "WHEN 'view' THEN '1' ELSE '7' END",
    "url": f"CASE event_id % 13 WHEN 0 THEN 'http://m.{SITE}.com/' "
           f"ELSE 'https://trade.{SITE}.com/' END",
    "amt": "CASE event_id % 97 WHEN 3 THEN 'x' WHEN 4 THEN '1.0000001' WHEN 5 THEN '1.00006' "
           "WHEN 6 THEN '' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS STRING) END",
    "tx_rslt": "CASE WHEN event_id % 17 = 0 THEN '0' ELSE '1' END",
    "guid": "CASE WHEN event_id % 97 = 0 THEN 'NULL' ELSE concat('0x', user_id) END",
    "otrack": "CASE (event_id * 5 + user_id) % 8 WHEN 0 THEN concat(promo, '-1-2-3.0') "
              "WHEN 1 THEN '0-1-2-3.1' WHEN 2 THEN '2800000-1-2-3.0' "
              "WHEN 3 THEN '7800000-1-2-3.0' WHEN 4 THEN 'garbage' WHEN 5 THEN 'null' "
              "ELSE '' END",
}
AD_LOG = {
    "event_id": "event_id",
    "guid": "CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('0x', user_id) END",
    "ts": "CAST(ms AS STRING)",
    "pageid": "CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat('p', user_id % 4) END",
    "tag": "CASE event_id % 9 WHEN 0 THEN '10000' WHEN 1 THEN '' WHEN 2 THEN '20001' "
           "ELSE concat('1', lpad(CAST(user_id % 20 + 1 AS STRING), 4, '0')) END",
    "proid": "CASE WHEN event_id % 3 = 0 THEN '' ELSE '10012' END",
}
H5_EVENT_LOG = {
    "event_id": "event_id",
    "type": "CASE event_type WHEN 'signup' THEN '4' WHEN 'purchase' THEN '4' ELSE '1' END",
    "productid": "CASE WHEN event_id % 4 = 0 THEN '1001' ELSE '5002' END",
    "otrack": "CASE (event_id * 5 + user_id) % 8 WHEN 0 THEN concat(promo, '-1-2-3.0') "
              "WHEN 1 THEN '0-1-2-3.1' WHEN 2 THEN '2800000-1-2-3.0' "
              "WHEN 3 THEN '7800000-1-2-3.0' WHEN 4 THEN 'garbage' ELSE '' END",
}
APP_LOG = {
    "event_id": "event_id",
    "ts": "CASE WHEN event_id % 53 = 0 THEN 'oops' ELSE CAST(ms AS STRING) END",
    "proid": "CASE event_type WHEN 'view' THEN '2001' WHEN 'click' THEN '2002' "
             "WHEN 'signup' THEN '3001' WHEN 'purchase' THEN '3002' ELSE '9999' END",
    "imei": "CASE WHEN user_id % 10 = 0 THEN '000000' ELSE concat('imei', user_id % 40) END",
    "ios_guid": "CASE WHEN user_id % 10 = 1 THEN '----' ELSE concat('idfa', user_id % 40) END",
    "type": "CAST(event_id % 3 + 1 AS STRING)",
    "custno": "CASE event_id % 3 WHEN 0 THEN '0' ELSE CAST(1000 + user_id AS STRING) END",
}
LOGS = {
    "pv_log": (PV_LOG, layouts.PAGE_VIEW),
    "trade_log": (TRADE_LOG, layouts.TRADE),
    "ad_log": (AD_LOG, layouts.AD_CLICK),
    "h5_event_log": (H5_EVENT_LOG, layouts.H5_EVENT),
    "app_log": (APP_LOG, layouts.APP_LOGIN),
}


def base_columns(ms: str) -> dict[str, str]:
    kept = ("event_id", "user_id", "event_type", "value")
    return {**{name: name for name in kept}, "ms": ms, "promo": PROMO, "wide": WIDE}


def line_expression(name: str) -> str:
    """SQL of one delimited line of a log: some fields padded, every 89th line too short."""
    _, layout = LOGS[name]
    by_position = {i: column for column, i in layout.positions.items()}
    fields = [by_position.get(i, "''") for i in range(layout.arity)]
    first = by_position[min(by_position)]
    last = by_position[max(by_position)]
    fields[min(by_position)] = (
        f"CASE event_id % 17 WHEN 1 THEN concat(' ', {first}, '\t ') "
        f"WHEN 2 THEN concat('　', {first}) ELSE {first} END"
    )
    fields[max(by_position)] = (
        f"CASE event_id % 19 WHEN 3 THEN concat({last}, '　 ') ELSE {last} END"
    )
    whole = f"concat_ws('{FIELD_SEPARATOR}', {', '.join(fields)})"
    short = f"concat_ws('{FIELD_SEPARATOR}', {', '.join(fields[:-1])})"
    return f"CASE WHEN event_id % 89 = 0 THEN {short} ELSE {whole} END"


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def spark_log(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A log as named columns."""
    columns, _ = LOGS[name]
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.selectExpr(*_select(base_columns(SPARK_MS)))
    return base.selectExpr(*_select(columns))


def spark_lines(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A log as text lines (with the event id and time alongside)."""
    log = spark_log(spark, sf_dir, name)
    return log.selectExpr("event_id", *(["ts"] if "ts" in log.columns else []),
                          f"{line_expression(name)} AS value")


def duckdb_logs(*names: str) -> str:
    """CTEs of the given logs for DuckDB, without the leading WITH."""
    ctes = ["base AS (SELECT " + ", ".join(_select(base_columns(DUCKDB_MS))) + " FROM events)"]
    for name in names:
        columns, _ = LOGS[name]
        ctes.append(f"{name} AS (SELECT " + ", ".join(_select(columns)) + " FROM base)")
    return ",\n".join(ctes)
