"""Hand-written cases of the reports: rejects, defaults, empty inputs, state merge."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.operators import report as r
from touchpath.plans import app, h5, misc, pages, pc, trade

LANDING = "https://www.fundhub.com/"
PV = "guid string, ts string, srcurl string, htag string, desturl string, pageid string, proid string"
TRADE = "guid string, ts string, type string, url string, amt string, tx_rslt string, otrack string"
AD = "guid string, ts string, pageid string, tag string, proid string"
APP = "ts string, proid string, imei string, ios_guid string, type string, custno string"


def outcomes(frame):
    return {row["reason"]: row["n"] for row in frame.collect()}


def test_page_view_rejects_in_order(spark):
    rows = [
        (26, "0xa", "1", "", "", LANDING, "", "1"),
        (27, "null", "1", "", "", LANDING, "", "5001"),
        (27, "xa", "1", "", "", LANDING, "", "1"),
        (27, "0xa", "1", "", "", "http://m.fundhub.com/", "", "5001"),
        (27, "0xa", "1", "", "", "http://m.fundhub.com/", "", "1"),
        (27, "0xa", "soon", "", "", LANDING, "", "1"),
        (27, "0xa", "1", "", "bad", LANDING, "", "1"),
    ]
    frame = spark.createDataFrame(rows, "n_fields int, " + PV)
    assert outcomes(pc.rejects(frame)) == {
        "NO_COMPLETE": 1, "INVALID_DATA": 2, "EXCLUDED_PRODUCT": 1, "INVALID_URL": 1,
        "INVALID_TIME": 1, "ACCEPTED": 1,
    }
    accepted = pc.rejects(frame).where("reason = 'ACCEPTED'").first()
    assert accepted["bad_htag"] == 1


def test_null_test_is_case_sensitive_on_pc_only(spark):
    frame = spark.createDataFrame([("0xa", "NULL", "", "", LANDING, "", "5002")], PV)
    assert outcomes(pc.rejects(frame)) == {"INVALID_TIME": 1}
    assert outcomes(h5.rejects(frame)) == {"INVALID_DATA": 1}


def test_h5_views_are_also_in_the_pc_report(spark):
    frame = spark.createDataFrame([("0xa", "1", "", "", LANDING, "6", "5002")], PV)
    assert r.total(pc.measures(frame)).first()["pv"] == 1
    assert r.total(h5.measures(frame)).first()["huodong_index"] == 1


def test_reports_show_empty_groups(spark):
    none = spark.createDataFrame([], PV)
    assert {row["channel"]: row["pv"] for row in pc.channel_report(none).collect()} == dict.fromkeys(
        (*c.GROUPS, c.ALL), 0)
    found = h5.view_report(none, "2024-02-03").collect()
    assert {(row["channel"], row["uv"], row["channel_type"], row["channel_parent"], row["dt"])
            for row in found} == {
        (code, 0, "5", "-1", dt.date(2024, 2, 3)) for code in (*c.GROUPS, c.ALL)}
    total = pages.news_total(none).collect()
    assert [(t["page_id"], t["pv"], t["uv"]) for t in total] == [("-1", 0, 0)]
    trades = trade.trade_report(spark.createDataFrame([], TRADE)).collect()
    assert {t["channel"] for t in trades} == {*c.GROUPS, c.ALL} and {t["amt"] for t in trades} == {0}


def test_trade_persons_and_amounts(spark):
    search, other = "2800000-1-1-1.0", "junk"
    rows = [
        ("0xa", "1", "6", LANDING, "-5.50", "1", search),   # negative group amount
        ("0xa", "2", "8", LANDING, "2", "1", other),
        ("0xb", "1", "10", LANDING, "0", "1", search),      # zero: a person in detail only
        ("0xc", "1", "5", LANDING, "n/a", "1", search),     # amount of a binding is not read
        ("0xc", "2", "5", LANDING, "", "1", ""),
        ("0xd", "1", "6", LANDING, "n/a", "1", search),     # rejected
        ("0xe", "1", "6", LANDING, "9", "0", search),       # failed
    ]
    frame = spark.createDataFrame(rows, TRADE)
    got = {t["channel"]: t for t in trade.measures(frame).collect()}
    detail, group, total = got["2800000"], got[c.ALL_SEARCH], got[c.ALL]
    assert (detail["persons"], detail["bills"], detail["amt"]) == (2, 2, Decimal("-5.5"))
    assert (group["persons"], group["bills"], group["amt"]) == (0, 2, Decimal("-5.5"))
    # the total adds positive group amounts only, all bills and bindings
    assert (total["persons"], total["bills"], total["amt"]) == (1, 3, Decimal("2"))
    assert (detail["bind_card"], total["bind_card"]) == (2, 2)  # events, not persons
    assert outcomes(trade.rejects(frame)) == {"ACCEPTED": 5, "INVALID_AMOUNT": 1, "FAILED": 1}
    assert [tuple(x) for x in trade.failures(frame).collect()] == [("BUY_FAILED", 1)]


@pytest.mark.parametrize("amounts,line", [
    ([("8", "1.5"), ("8", "2.25"), ("6", "7"), ("10", "9")], "pigamt:3.75,buyamt:7,other:0"),
    ([], "pigamt:0,buyamt:0,other:0"),
])
def test_total_amount_line(spark, amounts, line):
    frame = spark.createDataFrame([("0xa", "1", t, "", a, "1", "") for t, a in amounts], TRADE)
    assert trade.amount_totals(frame).first()["line"] == line


def test_ads(spark):
    rows = [("0xa", "1", "null", "10001", ""), ("0xa", "1", "p", "10001", "10012"),
            ("0xa", "1", "", "10001", "null"), ("0xa", "1", "p", "10000", ""), ("0xa", "1", "p", "", ""),
            ("0xa", "1", "p", "1000", ""), ("", "1", "p", "10001", "")]
    frame = spark.createDataFrame(rows, AD)
    got = {(x["tag"], x["proid"], x["page_id"], x["click_num"]) for x in pages.ad_report(frame).collect()}
    assert got == {("10001", "10013", "", 2), ("10001", "10012", "p", 1)}
    assert outcomes(pages.ad_rejects(frame)) == {
        "ACCEPTED": 3, "INVALID_TAG": 2, "NO_TAG": 1, "INVALID_DATA": 1}


def test_private_fund_pages_need_the_section_host(spark):
    url = "http://simu.fundhub.com/p"
    rows = [("0xa", "1", "", "", url, "5512", ""), ("0xb", "1", "", "", url, "5512", "1001"),
            ("0xa", "1", "", "", LANDING, "5512", ""), ("0xa", "1", "", "", url, "5542", ""),
            ("0xa", "1", "", "", url, "5512", "10012")]
    got = pages.private_fund_report(spark.createDataFrame(rows, PV), "2024-01-01").collect()
    assert [(g["page_id"], g["page_type"], g["pv"], g["uv"]) for g in got] == [(5512, 12, 2, 2)]


def millis(n):
    return dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=n)


def test_app_login_rules(spark):
    rows = [
        ("5", "2002", "imei", "x", "1", "77"),
        ("9", "3001", "x", "imei", "2", "77"),     # same device id on iOS, later
        ("3", "2001", "x", "----", "1", "77"),     # unusable id but a real customer: kept
        ("3", "2001", "x", "----", "1", "0"),
        ("3", "2001", "x", "ok", "1", ""),         # blank customer stays blank
        ("soon", "2001", "x", "ok", "1", "1"),
        ("3", "2001", "x", "ok", "one", "1"),
        ("3", "9999", "x", "ok", "1", "1"),
        ("3", "9999", "x", "ok", "1", "0"),        # no device id at all
    ]
    frame = spark.createDataFrame(rows, APP)
    got = {(x["deviceid"], x["custno"]): tuple(x)[2:] for x in app.first_logins(app.logins(frame)).collect()}
    assert got == {
        ("imei", "77"): (millis(5), millis(9), 1),
        ("----", "77"): (millis(3), None, 2),
        ("ok", ""): (millis(3), None, 2),
    }
    assert outcomes(app.rejects(frame)) == {
        "ACCEPTED": 4, "INVALID_DEVICE": 2, "INVALID_TIME": 1, "INVALID_TYPE": 1, "UNKNOWN_PRODUCT": 1}


def test_undecodable_customer_becomes_zero(spark):
    frame = spark.createDataFrame([("1", "2002", "i", "", "1", "enc"), ("1", "2002", "i", "", "1", "bad")], APP)
    decrypt = lambda x: F.when(x == "enc", "42")
    assert {x["custno"] for x in app.logins(frame, decrypt).collect()} == {"42", "0"}


def test_state_merge_fills_gaps_once(spark):
    logins = "deviceid string, custno string, chuxuguan_firsttime timestamp, " \
             "zhangji_firsttime timestamp, flag int"
    new = spark.createDataFrame([
        ("new", "1", millis(5), None, 1), ("gap", "1", millis(1), millis(7), 2),
        ("full", "1", millis(1), millis(1), 2),
    ], logins)
    state = spark.createDataFrame([
        ("gap", "1", millis(3), None, 1, millis(0)), ("full", "1", millis(3), millis(4), 1, millis(0)),
        ("idle", "1", millis(3), None, 1, millis(0)),
    ], logins + ", ts timestamp")
    merged = {x["deviceid"]: x for x in app.upsert_state(new, state).collect()}
    assert {d: x["change"] for d, x in merged.items()} == {
        "new": "insert", "gap": "update", "full": "keep", "idle": "keep"}
    # a stored first time is never replaced, not even by an earlier one
    assert tuple(merged["gap"])[2:5] == (millis(3), millis(7), 2)
    assert tuple(merged["full"])[2:6] == (millis(3), millis(4), 1, millis(0))
    assert tuple(merged["idle"])[2:6] == (millis(3), None, 1, millis(0))
    changed = {x["deviceid"] for x in app.state_changes(new, state).collect()}
    assert changed == {"new", "gap"}
    # merging the same logins again fills nothing new
    again = app.upsert_state(new, app.upsert_state(new, state).drop("change"))
    times = ["deviceid", "chuxuguan_firsttime", "zhangji_firsttime", "flag"]
    once = {tuple(merged[d][t] for t in times) for d in merged}
    assert {tuple(x) for x in again.select(*times).collect()} == once


def test_observation_counts_while_the_report_runs(spark):
    from pyspark.sql import Observation

    from touchpath.operators.quality import accepted, observe_outcomes

    rows = [("0xa", "1", "", "", LANDING, "", "1"), ("", "1", "", "", LANDING, "", "1")]
    seen = Observation("views")
    checked = observe_outcomes(pc.check(spark.createDataFrame(rows, PV)), seen, "INVALID_DATA")
    assert accepted(checked).count() == 1
    assert seen.get == {"ALL": 2, "INVALID_DATA": 1}


def test_secondary_sort_listing(spark):
    pairs = spark.createDataFrame([(25, 1), (3, 9), (3, -2), (15, 4), (3, 9)], "first int, second int")
    got = [(x["bucket"], x["line"]) for x in misc.secondary_sort(pairs).collect()]
    line = misc.GROUP_SEPARATOR
    assert got == [(0, line), (0, "3\t-2"), (0, "3\t9"), (0, "3\t9"), (1, line), (1, "15\t4"),
                   (2, line), (2, "25\t1")]


def test_word_count(spark):
    frame = spark.createDataFrame([("a b\ta\n",), (" b　b ",), ("",)], "value string")
    assert {x["word"]: x["n"] for x in misc.word_count(frame).collect()} == {"a": 2, "b": 1, "b　b": 1}
