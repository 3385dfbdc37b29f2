"""Compare registered queries with their SQL: ``python -m checks.compare [sf_dir] [names...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def normal(value):
    """Comparable form of a value; integers and booleans stay apart."""
    if isinstance(value, decimal.Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value if value is None else f"{type(value).__name__}:{value}"


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def kind(type_name: str) -> str:
    """Common name of a Spark or DuckDB type."""
    name = str(type_name).lower()
    names = {"varchar": "string", "integer": "int", "timestamp with time zone": "timestamp"}
    return names.get(name, name)


def duckdb_result(sf_dir: str, sql: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con.sql(sql)


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list]:
    result = duckdb_result(sf_dir, sql)
    return result.columns, result.fetchall()


def difference(df: DataFrame, sf_dir: str, name: str) -> str | None:
    """None when the query equals its SQL, else what differs."""
    result = duckdb_result(sf_dir, ORACLE_SQL[name])
    columns, rows = result.columns, result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wanted_types = {n: kind(t) for n, t in zip(columns, result.types)}
    types = {n: kind(t) for n, t in df.dtypes}
    if types != wanted_types:
        return f"types {set(types.items()) ^ set(wanted_types.items())}"
    got, want = sorted_rows(df.columns, df.collect()), sorted_rows(columns, rows)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}; e.g. {got[:2]} / {want[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, e.g. {wrong[:2]}" if wrong else None


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").appName("compare")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, sf_dir, name) if name in ORACLE_SQL else None
            if name not in ORACLE_SQL:
                print(f"rows only {name}: {df.count()}")
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
