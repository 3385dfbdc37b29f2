"""Rows with missing fields or impossible times are rejected, never passed or fatal."""

from pyspark.sql import functions as F

from touchpath.operators import quality as q
from touchpath.plans import app, h5, pages, pc, trade
from touchpath.sources import logs as src


def frame(spark, layout, **values):
    names = list(layout.positions)
    rows = [[values.get(n) for n in names]]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))


def test_unknown_tests_reject(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("a", "y")], "k string, v string")
    got = df.select("v", q.first_failure((F.col("v") != "x", "NO")).alias("r")).collect()
    assert {r["v"]: r["r"] for r in got} == {None: "NO", "x": None, "y": "NO"}


def test_missing_urls_and_pages_are_rejected(spark):
    pv = {"guid": "g", "ts": "1700000000000"}
    h5_row = frame(spark, src.PAGE_VIEW, **pv, proid="5001")
    assert pc.check(frame(spark, src.PAGE_VIEW, **pv)).first()["reject"] is not None
    assert h5.check(h5_row).first()["reject"] is not None
    assert pages.check_news(frame(spark, src.PAGE_VIEW, **pv)).first()["reject"] is not None
    assert trade.check(frame(spark, src.TRADE, **pv, type="1")).first()["reject"] is not None


def test_time_beyond_a_timestamp_is_rejected(spark):
    row = {"ts": "99999999999999999", "type": "1", "proid": "x", "custno": "7"}
    checked = app.check(frame(spark, src.APP_LOGIN, **row))
    assert checked.first()["reject"] == q.INVALID_TIME
    assert app.first_logins(app.logins(frame(spark, src.APP_LOGIN, **row))).count() == 0
