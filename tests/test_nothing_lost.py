"""Amounts, pairs and stream rows are kept exactly or counted as rejected."""

from decimal import Decimal

from pyspark.sql import functions as F

from touchpath.plans import app, misc, trade
from touchpath.sources import logs
from touchpath.streaming.hourly import (
    login_summary,
    news_of_visits,
    news_visits,
    store_batches,
    stream_log,
)


def test_amounts_are_exact_or_null(spark):
    texts = ["1.00001", "1.0000010", "1.0000001", "x", "", None, "-2.5", "1E3", "1E-3", ".5", "7.", "9" * 19]
    rows = spark.createDataFrame([(t,) for t in texts], "amt string").select("amt", trade.amount().alias("value"))
    got = {r["amt"]: r["value"] for r in rows.collect()}
    assert got == {
        "1.00001": Decimal("1.00001"), "1.0000010": Decimal("1.000001"), "1.0000001": None, "x": None, "": None,
        None: None, "-2.5": Decimal("-2.5"), "1E3": Decimal(1000), "1E-3": None, ".5": Decimal("0.5"),
        "7.": Decimal(7), "9" * 19: None,
    }


def test_totals_count_unreadable_amounts(spark):
    rows = spark.createDataFrame([("8", "1.00001"), ("8", "2"), ("6", "3.10"), ("6", "x"), ("8", None), ("4", "x")], "type string, amt string")
    total = trade.amount_totals(rows).first()
    assert (total["pigamt"], total["buyamt"], total["n_rejected"]) == (Decimal("3.00001"), Decimal("3.1"), 2)
    assert total["line"] == "pigamt:3.00001,buyamt:3.10,other:0"


def test_pair_outcomes(spark):
    lines = spark.createDataFrame([(t,) for t in ["1 2", "3", " ", "", None, "x 1", "1 y", "1 99999999999"]], "value string")
    assert {r["reason"]: r["n"] for r in logs.int_pair_outcomes(lines).collect()} == {"ACCEPTED": 2, "BLANK": 3, "NOT_A_NUMBER": 3}
    assert sorted(map(tuple, logs.read_int_pairs(lines).collect())) == [(1, 2), (3, 0)]


def test_equal_pairs_are_split(spark):
    n, before = 200_000, spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = spark.range(n).select(F.lit(5).alias("first"), F.lit(7).alias("second"))
        parts = misc.secondary_sort(pairs).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(p["count"] for p in parts) == n + 1 and max(p["count"] for p in parts) < n / 2


def line(layout, **fields):
    row = [""] * layout.arity
    for name, value in fields.items():
        row[layout.positions[name]] = value
    return "\u0001".join(row)


def streamed(spark, folder, layout, files, per_trigger, summarize):
    source = folder / "in"
    source.mkdir(parents=True)
    for i, lines in enumerate(files):
        (source / f"{i}.txt").write_text("\n".join(lines))
    rows = stream_log(spark, str(source), layout, maxFilesPerTrigger=str(per_trigger))
    store_batches(rows, str(folder / "out"), summarize).option("checkpointLocation", str(folder / "progress")).trigger(
        availableNow=True).start().awaitTermination()
    return spark.read.parquet(str(folder / "out"))


def test_news_stream_keeps_late_rows_and_open_hours(spark, tmp_path):
    hour, page = 3_600_000, "1001000200003" + "3"

    def view(guid, ms):
        return line(logs.PAGE_VIEW, guid=guid, ts=ms, desturl="u", pageid=page, proid="10012")
    files = [[view("0xa", str(9 * hour)), view("0xb", str(9 * hour + 5))], [view("0xa", str(hour + 1)), view("0xa", "late")],
             [view("0xa", str(9 * hour + 7)), view("0xa", "9" * 19)]]
    want = {(9 * hour, 3, 2), (hour, 1, 1), (None, 2, 1)}
    for per_trigger in (1, 10):
        stored = streamed(spark, tmp_path / str(per_trigger), logs.PAGE_VIEW, files, per_trigger, news_visits)
        assert {(r["hour_ms"], r["pv"], r["uv"]) for r in news_of_visits(stored).collect()} == want


def test_login_stream_does_not_depend_on_batches(spark, tmp_path):
    def login(ms, product):
        return line(logs.APP_LOGIN, ts=ms, proid=product, imei="i", ios_guid="g", type="1", custno="7")
    files = [[login("5000", "2002")], [login("3000", "2002"), login("9000", "3002")], [login("4000", "3002")]]
    results = []
    for per_trigger in (1, 10):
        stored = streamed(spark, tmp_path / str(per_trigger), logs.APP_LOGIN, files, per_trigger, login_summary)
        results.append(app.first_logins(stored).select(
            F.unix_millis("chuxuguan_firsttime"), F.unix_millis("zhangji_firsttime"), "flag").collect())
    assert results[0] == results[1] == [(3000, 4000, 1)]
