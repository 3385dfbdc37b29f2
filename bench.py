"""Time the headline reports and print one JSON line.

The derived logs are written to Parquet once (not timed). Each query then runs once to
warm up and five times into the ``noop`` sink; the median wall time counts, the fastest and the
slowest run are given as ``spread``. ``value`` is the sum over the queries.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from checks.logs import DT, LOGS, spark_lines, spark_log
from touchpath.plans import app, h5, misc, pages, pc, trade
from touchpath.sources import logs as src

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    folder = tempfile.mkdtemp(prefix="bench-")
    for name in LOGS:
        # several files per log, as a real log directory has
        spark_log(spark, SF_DIR, name).repartition(int(CPUS)).write.parquet(f"{folder}/{name}")
    spark_lines(spark, SF_DIR, "pv_log").select("value").write.text(f"{folder}/pv_text")

    def log(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}")

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{SF_DIR}/{name}.parquet")

    work = {
        "ad_click_daily": lambda: pages.ad_report(log("ad_log"), DT),
        "pc_channel_report": lambda: pc.channel_report(log("pv_log"), DT),
        "pc_channel_report_from_text": lambda: pc.channel_report(
            src.read_log(spark, f"{folder}/pv_text", src.PAGE_VIEW), DT
        ),
        "trade_report": lambda: trade.trade_report(log("trade_log"), DT),
        "h5_channel_merged": lambda: h5.merged_report(log("pv_log"), log("h5_event_log"), DT),
        "news_pv_daily": lambda: pages.news_report(log("pv_log"), DT),
        "app_first_login": lambda: app.first_logins(app.logins(log("app_log"))),
        "word_count": lambda: misc.word_count(table("documents"), "text"),
    }
    seconds, spread = {}, {}
    for name, build in work.items():
        run(build())
        runs = [run(build()) for _ in range(RUNS)]
        seconds[name] = round(statistics.median(runs), 4)
        spread[name] = [round(min(runs), 4), round(max(runs), 4)]
    print(json.dumps({
        "metric": "sum of median report seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "spread": spread,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
