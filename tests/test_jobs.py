"""Jobs from text files to report tables."""

from functools import partial

import pytest
from pyspark.sql import functions as F

from checks.compare import duckdb_rows, sorted_rows
from checks.logs import DT, spark_lines
from checks.oracle import ORACLE_SQL
from touchpath import jobs
from touchpath.functions.crypto import encrypt_column
from touchpath.operators import quality
from touchpath.plans import app, h5, pages
from touchpath.sources import logs, tables

SF_DIR = "/root/testdata/sf0.001"
KEY = "0123456789abcdefFEDCBA98 and more"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """All logs as delimited text, complete lines only; the trailing fields are padded."""
    root = tmp_path_factory.mktemp("logs")
    for name in ("pv_log", "trade_log", "ad_log", "h5_event_log"):
        lines = spark_lines(spark, SF_DIR, name).where("event_id % 89 <> 0")
        lines.select("value").write.text(str(root / name))
    return root


def check(stored, name, complete="event_id % 89 <> 0"):
    """The stored report equals the SQL over the complete rows of the log."""
    sql = ORACLE_SQL[name].replace(" FROM base)", f" FROM base WHERE {complete})")
    columns, rows = duckdb_rows(SF_DIR, sql)
    got = stored.select(*columns)
    assert sorted_rows(got.columns, got.collect()) == sorted_rows(columns, rows)


@pytest.mark.parametrize("job,inputs,table,name", [
    (jobs.pc_channels, ["pv_log"], "channel_view_stat", "pc_channel_report"),
    (jobs.trade_channels, ["trade_log"], "channel_trade_stat", "trade_report"),
    (jobs.h5_channels, ["pv_log", "h5_event_log"], "channel_view_trade_stat_h5", "h5_channel_merged"),
    (jobs.h5_views, ["pv_log"], "channel_view_stat_h5", "h5_view_report"),
    (jobs.h5_openings, ["h5_event_log"], "channel_trade_stat_h5", "h5_openacct"),
    (jobs.news_daily, ["pv_log"], "channel_page_pv_uv_news_his", "news_pv_daily"),
    (jobs.news_section, ["pv_log"], "channel_page_pv_uv_news_his", "news_pv_total"),
    (jobs.private_fund_pages, ["pv_log"], "channel_page_pv_uv_simu", "simu_page_pv"),
    (jobs.ad_clicks, ["ad_log"], "channel_ad_click", "ad_click_daily"),
])
def test_job_writes_its_table(spark, files, tmp_path, job, inputs, table, name):
    paths = [str(files / x) for x in inputs]
    job(spark, *paths, write=partial(tables.append_parquet, root=str(tmp_path)), dt=DT)
    stored = spark.read.parquet(str(tmp_path / table))
    assert set(stored.columns) == set(tables.REPORT_TABLES[table])
    check(stored, name)


@pytest.mark.parametrize("job,name,layout,outcomes", [
    (jobs.h5_views, "pv_log", logs.PAGE_VIEW, h5.rejects),
    (jobs.h5_openings, "h5_event_log", logs.H5_EVENT, lambda rows: quality.count_outcomes(h5.check_events(rows))),
    (jobs.news_section, "pv_log", logs.PAGE_VIEW, pages.news_rejects),
    (jobs.news_daily, "pv_log", logs.PAGE_VIEW, pages.news_rejects),
])
def test_job_counts_the_outcome_of_every_row_once(spark, files, tmp_path, job, name, layout, outcomes):
    path, found = str(files / name), []
    job(spark, path, partial(tables.append_parquet, root=str(tmp_path)), dt=DT, rejects=lambda o, log: found.append(o))
    expected = {(r.reason, r.n) for r in outcomes(logs.read_log(spark, path, layout)).collect()}
    got = {(r.reason, r.n) for r in found[0].collect()}
    assert len(found) == 1 and got == expected


def test_hourly_job_counts_the_rows_of_its_hour_only(spark, files, tmp_path):
    for hour in (3, 4):
        (tmp_path / f"pv.{DT}.{hour}").write_bytes(b"".join(p.read_bytes() for p in (files / "pv_log").glob("part-*")))
    found = []
    jobs.news_hourly(spark, str(tmp_path), partial(tables.append_parquet, root=str(tmp_path / "out")), DT, 3,
                     rejects=lambda o, log: found.append(o))
    expected = pages.news_rejects(logs.read_log(spark, str(files / "pv_log"), logs.PAGE_VIEW))
    assert {(r.reason, r.n) for r in found[0].collect()} == {(r.reason, r.n) for r in expected.collect()}


def test_several_paths_are_one_input(spark, files):
    whole = logs.read_log(spark, str(files / "ad_log"), logs.AD_CLICK)
    twice = logs.read_log(spark, [str(files / "ad_log")] * 2, logs.AD_CLICK)
    assert twice.count() == 2 * whole.count()


def test_hourly_job_reads_only_its_hour(spark, tmp_path):
    def line(page):
        fields = [""] * 27
        fields[0], fields[1], fields[18] = "0xa", "1", page
        return "\u0001".join(fields)

    for name, page in [("web_pv.1.2024-01-31.9", "10010002000033"), ("web_pv.1.2024-01-31.19", "20010002000033"),
                       ("web_pv.2.2024-01-31.9", "10010002000033"), ("web_pv.1.2024-01-30.9", "30010002000033")]:
        (tmp_path / name).write_text(line(page) + "\n", encoding="utf-8")
    got = {}
    jobs.news_hourly(spark, str(tmp_path), lambda report, table: got.update({table: report.collect()}), DT, 9)
    [(table, rows)] = got.items()
    assert table == "channel_page_pv_uv_news_today"
    assert [(x["page_id"], x["pv"], x["uv"]) for x in rows] == [("10010002000033", 2, 1)]
    with pytest.raises(ValueError):
        jobs.news_hourly(spark, str(tmp_path), print, DT, "x")


def test_previous_hour_wraps_at_midnight():
    import datetime as dt

    assert jobs.previous_hour(dt.datetime(2024, 1, 1, 0, 5)) == 23
    assert jobs.previous_hour(dt.datetime(2024, 1, 1, 10, 5)) == 9


def test_app_job_decrypts_and_merges(spark, tmp_path):
    frame = spark.createDataFrame([("5", "2002", "imei", "77"), ("8", "3002", "imei", "77")],
                                  "ts string, proid string, imei string, custno string")
    code = encrypt_column(F.col("custno"), KEY, wrap=True)
    fields = [F.col("ts"), F.col("proid"), F.col("imei"), F.lit(""), F.lit(""), F.lit("1"), code]
    fields += [F.lit("")] * 6
    frame.select(F.concat_ws("\u0001", *fields).alias("value")).write.text(str(tmp_path / "app"))
    state = spark.createDataFrame([], "deviceid string, custno string, chuxuguan_firsttime timestamp, "
                                      "zhangji_firsttime timestamp, flag int, ts timestamp")
    changes = jobs.app_first_logins(spark, str(tmp_path / "app"), state, KEY)
    assert changes.select("deviceid", "custno", "flag", "change").collect() == [("imei", "77", 1, "insert")]
    # state kept as table versions: the next run reads version 1 and writes version 2
    merged = app.upsert_state(changes.drop("ts", "change"), state)
    merged.drop("change").write.parquet(str(tmp_path / "state-1"))
    again = jobs.app_first_logins(spark, str(tmp_path / "app"), spark.read.parquet(str(tmp_path / "state-1")), KEY)
    assert again.count() == 0


def test_merge_statement_names_every_column_once():
    sql = tables.merge_statement("state", "staging")
    assert sql.startswith("MERGE INTO state t USING (SELECT DISTINCT deviceid, custno,")
    assert "UPDATE SET chuxuguan_firsttime = s.chuxuguan_firsttime" in sql
    assert sql.count("INSERT (") == 1 and "deviceid = s.deviceid AND" in sql


def test_text_outputs(spark, files, tmp_path):
    (tmp_path / "in.txt").write_text("3 1\n25 2\n3 0\n", encoding="utf-8")
    jobs.secondary_sort(spark, str(tmp_path / "in.txt"), str(tmp_path / "sorted"))
    small = spark.read.text(str(tmp_path / "sorted" / "bucket=0")).collect()
    assert [x["value"] for x in small] == ["-" * 48, "3\t0", "3\t1"]
    jobs.word_count(spark, str(tmp_path / "in.txt"), str(tmp_path / "words"))
    words = {x["value"] for x in spark.read.text(str(tmp_path / "words")).collect()}
    assert words == {"3\t2", "1\t1", "25\t1", "2\t1", "0\t1"}
    jobs.amount_totals(spark, str(files / "trade_log"), str(tmp_path / "total"))
    [line] = spark.read.text(str(tmp_path / "total")).collect()
    assert line["value"].startswith("pigamt:") and line["value"].endswith(",other:0")


def test_delimited_append(spark, tmp_path):
    frame = spark.createDataFrame([("a", None, 1)], "x string, y string, n int")
    for _ in range(2):
        tables.append_delimited(frame, str(tmp_path / "out"))
    lines = [x["value"] for x in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == ["a\u0001\u00011"] * 2
