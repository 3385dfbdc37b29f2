"""The slot-wise plans against sequential models, for several slot lengths."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from model import h5_model, pc_model, trade_model
from touchpath import config as c
from touchpath.plans import h5, pc, trade

LANDING = "https://www.fundhub.com/"
SOURCES = [
    "", "null", "http://www.baidu.com/s", "https://www.google.com/", "http://news.qq.com/a",
    "http://blog.example.com/x", "http://www.baidu.com/s?wd=a b", "http://www.fundhub.com/a",
    "http://x.efundhub.com/", "http://example.com/?u=http://www.fundhub.com", "NULL",
]
TAGS = [
    "", "", "", "null", "bad", "1.0012345", "2.123456", "0.123456", "0.0010020003900000",
    "0.0010020004900000", "0.0990020003900000", "1.0010020003900000", "3.000000",
]
PAGES = ["", "null", "12", "312", "77", "2", "421000", "521010", "621020", "76"]
OTRACKS = [
    "", "", "null", "NULL", "garbage", "0-1-2-3.1", "2800000-1-2-3.0", "7800000-1-2-3.0",
    "0010020003900000-1-2-3.0", "0010020004900000-1-2-3.3", "9999999999-1-1-1.0",
    "9999999998-1-1-1.0", "123-1-1-1.0", "0-1-2-3.7",
]


def histories(seed, visitors=400, longest=12, span=200):
    """Random visitors with distinct times each; one visitor has a third of all rows."""
    rng, rows = random.Random(seed), []
    for v in range(visitors):
        n = rng.randint(1, longest)
        for ts in rng.sample(range(span), n):
            rows.append((f"0x{v}", ts))
    hot = len(rows) // 2
    rows += [("0xhot", ts) for ts in rng.sample(range(10 * hot), hot)]
    return rng, rows


@pytest.fixture(scope="module")
def views():
    rng, keys = histories(7)
    return [
        {"id": i, "guid": g, "ts": ts, "srcurl": rng.choice(SOURCES), "htag": rng.choice(TAGS),
         "pageid": rng.choice(PAGES)}
        for i, (g, ts) in enumerate(keys)
    ]


def view_frame(spark, views, proid):
    rows = [
        (v["id"], v["guid"], str(v["ts"]), v["srcurl"], v["htag"], LANDING, v["pageid"], proid)
        for v in views
    ]
    columns = "id int, guid string, ts string, srcurl string, htag string, desturl string, " \
              "pageid string, proid string"
    return spark.createDataFrame(rows, columns)


@pytest.mark.parametrize("slot_ms", [1, 7, 50, 10_000_000])
def test_pc_channel_of_every_view(spark, views, slot_ms):
    expected, _, _ = pc_model(views)
    valid = pc.valid(view_frame(spark, views, "1"))
    got = {r["id"]: r["channel"] for r in pc.attribute(valid, keep=("id",), slot_ms=slot_ms).collect()}
    assert got == expected


@pytest.mark.parametrize("slot_ms", [1, 7, 50, 10_000_000])
def test_pc_report(spark, views, slot_ms):
    _, expected, enter = pc_model(views)
    rows = pc.measures(view_frame(spark, views, "1"), slot_ms=slot_ms).collect()
    got = {r["channel"]: r for r in rows}
    assert {code: r["enter"] for code, r in got.items() if r["enter"]} == dict(enter)
    for code, want in expected.items():
        assert {k: got[code][k] for k in ("pv", "uv", "validuv", "simuuv")} == dict(want), code
    assert {code for code, r in got.items() if r["pv"]} == set(expected)


def test_pc_portals_counted_on_request(spark, views):
    channels, report, _ = pc_model(views)
    portal_views = sum(ch in c.PORTAL_CODES for ch in channels.values())
    assert portal_views > 0
    found = pc.measures(view_frame(spark, views, "1"), count_portals=True).collect()
    got = {r["channel"]: r["pv"] for r in found}
    assert got[c.ALL] == report[c.ALL]["pv"] + portal_views
    assert sum(got[code] for code in c.PORTAL_CODES if code in got) == portal_views


@pytest.mark.parametrize("slot_ms", [1, 50, 10_000_000])
def test_h5_channels_and_entries(spark, views, slot_ms):
    expected, enter = h5_model(views)
    frame = view_frame(spark, views, "5002")
    got = h5.attribute(h5.valid(frame), keep=("id",), slot_ms=slot_ms).collect()
    assert {r["id"]: r["channel"] for r in got} == expected
    found = h5.measures(frame, slot_ms=slot_ms).collect()
    assert {r["channel"]: r["enter"] for r in found if r["enter"]} == dict(enter)


@pytest.mark.parametrize("slot_ms", [1, 50, 10_000_000])
def test_trade_report(spark, slot_ms):
    rng, keys = histories(11)
    rows = [
        {"guid": g, "ts": ts, "type": rng.choice(c.REPORTED_ACTIONS), "otrack": rng.choice(OTRACKS),
         "amt": Decimal(rng.randint(-300, 500)) / 100}
        for g, ts in keys
    ]
    frame = spark.createDataFrame(
        [(r["guid"], str(r["ts"]), r["type"], LANDING, str(r["amt"]), "1", r["otrack"]) for r in rows],
        "guid string, ts string, type string, url string, amt string, tx_rslt string, otrack string",
    )
    got = {
        r["channel"]: (r["persons"], r["bills"], r["amt"], r["bind_card"], r["open_acct"])
        for r in trade.measures(frame, slot_ms=slot_ms).collect()
    }
    assert got == trade_model(rows)


def test_equal_times_give_the_same_result_in_any_input_order(spark):
    rows = [(i, "0xa", "5", s, t, LANDING, "12", "1")
            for i, (s, t) in enumerate((s, t) for s in SOURCES for t in TAGS)]
    columns = "id int, guid string, ts string, srcurl string, htag string, desturl string, " \
              "pageid string, proid string"
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, columns).repartition(seed)
        found = pc.measures(frame).orderBy("channel").collect()
        results.append(found)
    assert results[0] == results[1]


def test_times_far_apart_keep_their_order(spark):
    """Differences beyond 32 bits of milliseconds (about 25 days) must not wrap."""
    rows = [
        (1, "0xa", "0", "http://www.baidu.com/", "", LANDING, "", "1"),
        (2, "0xa", str(40 * 86_400_000), "", "", LANDING, "", "1"),
    ]
    columns = "id int, guid string, ts string, srcurl string, htag string, desturl string, " \
              "pageid string, proid string"
    got = pc.attribute(pc.valid(spark.createDataFrame(rows, columns)), keep=("id",))
    assert {r["id"]: r["channel"] for r in got.collect()} == {1: "2800000", 2: "2800000"}


def test_slots_bound_the_work_of_a_hot_visitor(spark):
    """One visitor with very many views ends as few rows per slot, not as one big group."""
    views = spark.range(200_000).selectExpr(
        "'0xbot' AS guid", "CAST(id * 100 AS STRING) AS ts",
        "IF(id % 10 = 0, 'http://www.baidu.com/', '') AS srcurl", "'' AS htag",
        f"'{LANDING}' AS desturl", "'12' AS pageid", "'1' AS proid",
    )
    per_visitor = pc.visitor_channels(pc.valid(views), slot_ms=60_000)
    slots = 200_000 * 100 // 60_000 + 1
    assert per_visitor.count() <= 4 * slots
    total = pc.measures(views).where(F.col("channel") == c.ALL).first()
    assert (total["pv"], total["uv"]) == (200_000, 1)


def test_copies_are_counted_before_the_visitor_is_put_together(spark):
    """A third of all rows being copies of a few lines leaves a handful of rows to order."""
    views = spark.range(300_000).selectExpr(
        "IF(id % 3 = 0, '0xbot', concat('0x', id % 1000)) AS guid",
        "IF(id % 3 = 0, '5', CAST(id AS STRING)) AS ts",
        "IF(id % 2 = 0, 'http://www.baidu.com/', '') AS srcurl", "'bad' AS htag",
        f"'{LANDING}' AS desturl", "'12' AS pageid", "'1' AS proid",
    )
    found = {r["channel"]: r for r in pc.measures(views).collect()}
    assert found[c.ALL]["pv"] == found[c.ALL]["enter"] == 300_000
    bot = pc.measures(views.where("guid = '0xbot'")).where(F.col("channel") == c.DIRECT).first()
    assert (bot["pv"], bot["uv"], bot["enter"]) == (50_000, 1, 50_000)
