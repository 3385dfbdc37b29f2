"""Estimated visitors from stored hourly sketches against exact counts."""

from pyspark.sql import functions as F

from touchpath.plans import pages

HOUR = pages.HOUR_MS


def views(spark, n, visitors):
    """``n`` views of a hot page and of one with seven visitors, over 24 hours."""
    rows = spark.range(n).select(
        F.concat(F.lit("0x"), F.pmod(F.xxhash64("id"), F.lit(visitors)).cast("string")).alias("guid"),
        (F.col("id") % 24 * HOUR).cast("string").alias("ts"), F.lit("10012").alias("proid"),
        F.lit("10010002000033").alias("pageid"))
    few = rows.where("id % 100 = 0").withColumn("guid", F.concat(F.lit("0xf"), (F.xxhash64("guid") % 4).cast("string")))
    return rows.unionByName(few.withColumn("pageid", F.lit("10010002000043")))


def test_united_sketches_stay_within_the_stated_error(spark, tmp_path):
    rows = views(spark, 200_000, 50_000)
    for part in (0, 1):  # two runs of a job, each with its own sketches of the same hours
        pages.news_sketches(rows.where(F.pmod(F.xxhash64("guid", "ts"), F.lit(2)) == part)).write.parquet(
            str(tmp_path / f"part={part}"))
    stored = spark.read.parquet(str(tmp_path))
    exact = {r.page_id: r for r in pages.news_report(rows, "2024-01-31").collect()}
    found = {r.page_id: r for r in pages.news_report_estimated(stored, "2024-01-31").collect()}
    assert found.keys() == exact.keys() and len(exact) == 2
    for page, r in exact.items():
        assert found[page].pv == r.pv and found[page].zid == r.zid
        assert abs(found[page].uv - r.uv) <= pages.SKETCH_ERROR * r.uv
    assert found["10010002000043"].uv == exact["10010002000043"].uv
    (total,), (whole,) = pages.news_total(rows).collect(), pages.news_total_estimated(stored).collect()
    assert whole.pv == total.pv and abs(whole.uv - total.uv) <= pages.SKETCH_ERROR * total.uv


def test_no_views_and_odd_times(spark):
    rows = views(spark, 300, 10)
    nothing = pages.news_sketches(rows.limit(0))
    assert pages.news_report_estimated(nothing).count() == 0
    (total,) = pages.news_total_estimated(nothing).collect()
    assert (total.pv, total.uv) == (0, 0)
    odd = pages.news_sketches(rows.withColumn("ts", F.lit("soon")))
    assert {r.hour for r in odd.collect()} == {None}
    assert pages.news_total_estimated(odd).first().pv == pages.news_total(rows).first().pv
