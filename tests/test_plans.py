"""Physical plans: shuffles, pruning, no Python and no cross joins in the reports."""

import re

import pytest

from checks.queries import QUERIES
from touchpath.plans import h5, pages, pc, trade

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+\(.*?)(?:, \d+\))", plan_of(df))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from checks.logs import LOGS, spark_log

    root = tmp_path_factory.mktemp("parquet")
    for name in LOGS:
        spark_log(spark, SF_DIR, name).write.parquet(str(root / name))
    return {name: spark.read.parquet(str(root / name)) for name in LOGS}


def keys(df):
    return [re.sub(r"#\d+L?", "", x) for x in exchanges(df)]


def test_channel_report_shuffles(stored):
    """Copies are counted first; slots and visitors are put in order away from
    what is certain by channel; codes get partial sums."""
    expected = ["hashpartitioning(code", "hashpartitioning(guid, code", "hashpartitioning(guid, to", "hashpartitioning(guid, slot, to"]
    counted = "hashpartitioning(guid, ts, channel"  # then by codes
    assert keys(pc.channel_report(stored["pv_log"])) == [*expected, counted + ", entry"]
    assert keys(h5.view_report(stored["pv_log"])) == [*expected, counted]
    assert keys(trade.trade_report(stored["trade_log"])) == [*expected[:2], "hashpartitioning(guid, code", *expected[2:], counted]


def test_page_reports_combine_before_each_shuffle(stored):
    report = pages.news_report(stored["pv_log"])
    assert keys(report) == ["hashpartitioning(pageid", "hashpartitioning(pageid, guid"]
    assert plan_of(report).count("partial_") >= 2


def test_scans_read_only_needed_columns(stored):
    scan = re.search(r"ReadSchema: struct<(.*?)>", plan_of(pages.ad_report(stored["ad_log"])))
    assert {x.split(":")[0] for x in scan.group(1).split(",")} == {"guid", "ts", "pageid", "tag", "proid"}


def test_no_python_and_no_cross_joins(spark):
    written = {"scan_delimited", "news_pv_hourly", "sink_delimited", "sink_report_table", "table_count",
               "news_pv_stream"}
    for name in set(QUERIES) - written:
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert "EvalPython" not in plan, name
