"""Streaming jobs against the batch plans."""

from checks.logs import spark_lines
from touchpath.plans import app
from touchpath.sources import logs
from touchpath.streaming.hourly import merge_logins, news_per_hour, stream_log

SF_DIR = "/root/testdata/sf0.001"


def line(guid, ms, page):
    fields = [""] * 27
    fields[0], fields[1], fields[18] = guid, str(ms), page
    return "\u0001".join(fields)


def test_hours_close_as_files_arrive(spark, tmp_path):
    page, hour = "10010002000033", 3_600_000
    first = [("0xa", 1), ("0xa", 2), ("0xb", 3), ("0xa", hour + 1)]
    second = [("0xc", hour + 2), ("0xa", 2 * hour + 700_000)]
    source = tmp_path / "in"
    source.mkdir()
    rows = stream_log(spark, str(source), logs.PAGE_VIEW)

    def run():
        job = (news_per_hour(rows).writeStream.format("parquet").option("path", str(tmp_path / "out"))
               .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start())
        job.awaitTermination()
        out = spark.read.parquet(str(tmp_path / "out")).selectExpr("unix_millis(hour) AS h", "pv", "uv")
        return {x["h"]: (x["pv"], x["uv"]) for x in out.collect()}

    (source / "1").write_text("\n".join(line(g, t, page) for g, t in first) + "\n")
    assert run() == {}  # the watermark has not passed the end of the first hour
    (source / "2").write_text("\n".join(line(g, t, page) for g, t in second) + "\n")
    assert run() == {0: (3, 2), hour: (2, 2)}


def test_login_batches_end_in_the_batch_result(spark, tmp_path):
    lines = spark_lines(spark, SF_DIR, "app_log").select("value")
    lines.repartition(3).write.text(str(tmp_path / "in"))
    versions = [spark.createDataFrame([], "deviceid string, custno string, chuxuguan_firsttime timestamp, "
                                          "zhangji_firsttime timestamp, flag int, ts timestamp")]

    def apply(changes, batch_id):
        state, changed = versions[-1], changes.drop("change")
        kept = state.join(changed, ["deviceid", "custno"], "left_anti")
        path = str(tmp_path / f"state-{batch_id}")
        kept.unionByName(changed).write.mode("overwrite").parquet(path)
        versions.append(spark.read.parquet(path))

    rows = stream_log(spark, str(tmp_path / "in"), logs.APP_LOGIN, maxFilesPerTrigger="1")
    job = (merge_logins(rows, lambda: versions[-1], apply)
           .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start())
    job.awaitTermination()
    assert len(versions) == 4
    whole = app.first_logins(app.logins(logs.parse(lines, logs.APP_LOGIN)))
    found = versions[-1]
    keys = ["deviceid", "custno"]
    assert {tuple(x) for x in found.select(keys).collect()} == {tuple(x) for x in whole.select(keys).collect()}
    # which first times are known does not depend on the batches; their values come from the first one
    known = ["deviceid", "custno", "chuxuguan_firsttime IS NULL", "zhangji_firsttime IS NULL"]
    assert {tuple(x) for x in found.selectExpr(*known).collect()} == {
        tuple(x) for x in whole.selectExpr(*known).collect()}
