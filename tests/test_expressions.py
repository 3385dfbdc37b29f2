"""Hand-written cases of the expressions and filters."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.functions import channels, labels, pages, text
from touchpath.functions.text import trim_field
from touchpath.sources import logs


def apply(spark, expression, values):
    """Value -> result of a Column function over one text column."""
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    return {r["x"]: r["y"] for r in frame.select("x", expression(F.col("x")).alias("y")).collect()}


def test_landing_pages(spark):
    got = apply(spark, lambda x: x.rlike(c.DEFAULT_SITE.landing), [
        "https://www.fundhub.com/", "http://m.fundhub.com/", "http://mzt.fundhub.com/",
        "http://zt.fundhub.com/", "https://data.fundhub.com/hws/", "http://mall.fundhub.com/",
        "http://simu.efundhub.com/", "http://www.other.org/", "http://www.other.org/?u=x.fundhub.com",
        "http://m.x.org/?u=http://www.fundhub.com/", "",
    ])
    accepted = {url for url, ok in got.items() if ok}
    assert accepted == {
        "https://www.fundhub.com/", "http://simu.efundhub.com/",
        # the address may stand in the query of another site
        "http://www.other.org/?u=x.fundhub.com", "http://m.x.org/?u=http://www.fundhub.com/",
    }


def test_site_is_a_parameter(spark):
    site = c.Site(("shop.x",))
    got = apply(spark, lambda x: x.rlike(site.landing), ["http://www.shop.x.com", "http://www.shopYx.com"])
    assert got == {"http://www.shop.x.com": True, "http://www.shopYx.com": False}
    own = apply(spark, lambda x: x.rlike(site.private_fund), ["http://simu.shop.x.com/a", "http://a.shop.x.com/"])
    assert list(own.values()) == [True, False]


def test_referrer_channel(spark):
    got = apply(spark, channels.referrer_channel, [
        "http://www.baidu.com/s?wd=1", "http://www.so.com/", "https://hao123.com.baidu.com/",
        "http://x.sina.com.cn/qq.com", "http://a_b.baidu.com/", "http://www.baidu.com/a b",
        "//www.google.com/x", "baidu.com", "mailto:a@baidu.com", "http://m.sm.cn/",
    ])
    assert got == {
        "http://www.baidu.com/s?wd=1": "2800000", "http://www.so.com/": None,
        "https://hao123.com.baidu.com/": "10800000",  # two listed domains: fixed priority
        "http://x.sina.com.cn/qq.com": "11800000", "http://a_b.baidu.com/": None,
        "http://www.baidu.com/a b": None, "//www.google.com/x": "3800000", "baidu.com": None,
        "mailto:a@baidu.com": None, "http://m.sm.cn/": "6800000",
    }


def test_uri_syntax(spark):
    got = apply(spark, channels.is_uri, [
        "http://a.com", "a/b", "mailto:x@y", "http://a_b.com/", "http://a.com/x y",
        "http://[bad", "http://a.com/%zz", "http://a.com/|", "http://a.com/^",
    ])
    assert {u for u, ok in got.items() if ok} == {"http://a.com", "a/b", "mailto:x@y", "http://a_b.com/"}


def test_htag_parts(spark):
    got = apply(spark, channels.htag_parts, ["0.0010020003900000", "3.123456", "4.123456", "1.12345", ""])
    assert got["0.0010020003900000"] == (True, "0", "0010020003900000")
    assert got["3.123456"] == (True, "3", "123456")
    assert all(got[x] == (False, None, None) for x in ("4.123456", "1.12345", ""))


def test_otrack_channel(spark):
    promo = "0010020003900000"
    got = apply(spark, channels.otrack_channel, [
        f"{promo}-1-2-3.0", "0-1-2-3.3", "0-1-2-3.4", "6800000-1-1-1.0", "7800000-1-1-1.0",
        "9999999998-1-1-1.0", "garbage", "", "null", "NULL", "12-1-1-1.1",
    ])
    assert got == {
        f"{promo}-1-2-3.0": promo, "0-1-2-3.3": c.DIRECT, "0-1-2-3.4": c.OTHER,
        "6800000-1-1-1.0": "6800000", "7800000-1-1-1.0": c.OTHER, "9999999998-1-1-1.0": c.OTHER,
        "garbage": c.OTHER, "": None, "null": None, "NULL": None, "12-1-1-1.1": c.OTHER,
    }


def test_channel_dimensions(spark):
    codes = [c.DIRECT, c.OTHER, "2800000", "13800000", "001", "001002", "0010020003", c.ALL_PROMO, "12"]
    frame = spark.createDataFrame([(x,) for x in codes], "x string")
    x = F.col("x")
    rows = frame.select(
        channels.channel_type(x), channels.channel_level(x), channels.channel_parent(x),
        channels.channel_parent(x, "-1"),
    ).collect()
    assert [tuple(r) for r in rows] == [
        (1, "1", None, "-1"), (2, "1", None, "-1"), (3, "1", None, "-1"), (2, "1", None, "-1"),
        (4, "1", None, "-1"), (4, "2", "001", "001"), (4, "3", "001002", "001002"),
        (5, "1", None, "-1"), (-1, "-1", "-1", "-1"),
    ]


def test_blank_variants(spark):
    values = ["", "null", "NULL", "Null", " ", "0"]
    exact = apply(spark, text.is_blank, values)
    any_case = apply(spark, lambda x: text.is_blank(x, ignore_case=True), values)
    assert {v for v in values if exact[v]} == {"", "null"}
    assert {v for v in values if any_case[v]} == {"", "null", "NULL", "Null"}


def test_trim_strips_unicode_white_space(spark):
    padded = ["\t a b　", " x ", "\r\ny", "z"]
    assert list(apply(spark, trim_field, padded).values()) == ["a b", "x", "y", "z"]


def test_pages(spark):
    step = apply(spark, pages.funnel_step, ["76", "121000", "121010", "121020", "12", ""])
    assert list(step.values()) == [
        "huodong_index", "openacct_index", "auth_index", "open_result_index", None, None]
    parts = apply(spark, pages.news_page_parts, ["420010002000033", "99999999999999999999" + "0010002000033"])
    assert tuple(parts["420010002000033"]) == (42, "001", "0002", "00003")
    assert parts["99999999999999999999" + "0010002000033"]["zid"] == Decimal("99999999999999999999")
    accepts = apply(spark, lambda x: pages.module_accepts("10012", x), ["", "1", "1001", "10012", "10013", "100123"])
    assert [p for p, ok in accepts.items() if ok] == ["", "1", "1001", "10012"]


def test_labels(spark):
    got = apply(spark, lambda x: labels.action_label(x, "?"), ["4", "12", "99"])
    assert got == {"4": "开户", "12": "撤单", "99": "?"}
    assert apply(spark, labels.module_label, ["10011", "1"]) == {"10011": "私募", "1": None}


@pytest.mark.parametrize("body", ["abc", "x" * 200, "汉字"])
def test_signature_and_base64(spark, body):
    import base64
    import hashlib

    want = base64.b64encode(hashlib.md5(body.encode()).hexdigest().encode()).decode()
    frame = spark.createDataFrame([(body,)], "x string")
    x = F.col("x")
    row = frame.select(
        text.sign(x).alias("s"), text.sign_matches(x, F.lit(want)).alias("ok"),
        text.encode_base64(x).alias("e"), text.decode_base64(text.encode_base64(x)).alias("d"),
    ).first()
    assert row["s"] == want and row["ok"] and row["d"] == body
    assert row["e"] == base64.b64encode(body.encode()).decode()


def test_parse_keeps_empty_fields_and_counts_them(spark):
    line = "\u0001".join(["0xa ", "5"] + [""] * 25)
    frame = spark.createDataFrame([(line,), ("a\u0001b",), ("",)], "value string")
    rows = logs.parse(frame, logs.PAGE_VIEW).collect()
    assert [r["n_fields"] for r in rows] == [27, 2, 1]
    assert rows[0]["guid"] == "0xa" and rows[0]["proid"] == "" and rows[1]["proid"] is None


def test_int_pairs(spark):
    lines = ["1 2", " 3\t4 5 ", "7", "", "  ", "x 1", "1 y"]
    frame = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [tuple(r) for r in logs.read_int_pairs(frame).collect()] == [(1, 2), (3, 4), (7, 0)]
