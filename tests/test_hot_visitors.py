"""One visitor with very many rows: what a task reads is bounded by elapsed time, not by the rows.

A task gets at most one point a millisecond of a slot, or two rows per slot of elapsed time
(here 28,000 for 39 hours in slots of ten seconds), of the visitor's 200,000 rows.
"""

import json
import os

import pytest
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.plans import h5, pc, trade

ROWS = 200_000
LANDING = "https://www.fundhub.com/"
TAG = "concat(lpad(CAST(id AS STRING), 10, '0'), '900000')"
# one row in three carries, the others bring a tag that no other row has
LONG = {"ts": "id * 700", "tag": f"IF(id % 3 = 2, NULL, {TAG})"}
MINUTE = {"ts": "id % 60000", "tag": f"IF(id % 3 = 2, NULL, {TAG})"}
CARRIES = {"ts": "id * 7", "tag": f"IF(id = 5, {TAG}, NULL)"}
HISTORIES = {"as many tags": LONG, "one minute": MINUTE, "hardly a tag": CARRIES}


def bot(spark, history, proid):
    rows = spark.range(0, ROWS, 1, 16).selectExpr("id", f"{history['ts']} AS t", f"{history['tag']} AS tag")
    return rows.selectExpr(
        "id", "'0xbot' AS guid", "CAST(t AS STRING) AS ts", "IF(tag IS NULL, 'http://www.fundhub.com/', '') AS srcurl",
        "coalesce(concat('0.', tag), '') AS htag", f"'{LANDING}' AS desturl", "'12' AS pageid", f"'{proid}' AS proid",
        "'6' AS type", f"'{LANDING}' AS url", "'1.5' AS amt", "'1' AS tx_rslt",
        "coalesce(concat(tag, '-1-2-3.0'), '') AS otrack")


class Tasks:
    """Rows read from shuffles per stage and task, from the event log."""

    def __init__(self, spark):
        folder = spark.conf.get("spark.eventLog.dir").removeprefix("file://")
        self.file, = (os.path.join(folder, f) for f in os.listdir(folder) if spark.sparkContext.applicationId in f and not f.endswith(".crc"))
        self.before = os.path.getsize(self.file)

    def _events(self):
        with open(self.file, "rb") as log:
            log.seek(self.before)
            lines = log.read().decode().splitlines()
        return [json.loads(line) for line in lines if line.startswith('{"Event":"SparkListenerTaskEnd"') and line.endswith("}")]

    def largest(self):
        reads = [event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for event in self._events()]
        assert sum(reads) > ROWS
        return max(reads)


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("history", HISTORIES)
def test_report_tasks_share_a_hot_visitor(spark, many_partitions, history):
    views, mobile = (bot(spark, HISTORIES[history], p) for p in ("1", "5002"))
    for measure in (lambda: pc.measures(views), lambda: h5.measures(mobile), lambda: trade.measures(views)):
        tasks = Tasks(spark)
        found = {r["channel"]: r for r in measure().where(F.col("channel").isin(*c.GROUPS, c.ALL)).collect()}
        total = found[c.ALL]
        assert (total["pv"], total["uv"]) == (ROWS, 1) if "pv" in total else (total["bills"], total["persons"]) == (ROWS, 1)
        assert tasks.largest() < ROWS // 5


def test_the_largest_task_does_not_grow_with_the_rows(spark, many_partitions):
    reads = []
    for times in (1, 4):
        views = bot(spark, MINUTE, "1")
        more = views.select(F.explode(F.sequence(F.lit(1), F.lit(times))).alias("k"), "*").withColumn(
            "htag", F.when(F.col("htag") != "", F.concat(F.lit("0."), F.lpad((F.col("id") * 4 + F.col("k")).cast("string"), 10, "0"), F.lit("900000"))).otherwise(""))
        tasks = Tasks(spark)
        assert pc.measures(more).where(F.col("channel") == c.ALL).first()["pv"] == times * ROWS
        reads.append(tasks.largest() / (times * ROWS))
    assert reads[1] < reads[0] / 1.5


@pytest.mark.parametrize("history", HISTORIES)
def test_row_level_tasks_share_a_hot_visitor(spark, many_partitions, history):
    views, mobile = (bot(spark, HISTORIES[history], p) for p in ("1", "5002"))
    for rows in (
        lambda: pc.attribute(pc.valid(views), keep=("id",)), lambda: h5.attribute(h5.valid(mobile), keep=("id",)),
        lambda: trade.attribute(trade.valid(views), keep=("id",)),
    ):
        tasks = Tasks(spark)
        counted = rows().agg(F.count("id").alias("n"), F.countDistinct("id").alias("ids"), F.count("channel").alias("known")).first()
        assert tuple(counted) == (ROWS, ROWS, ROWS)
        assert tasks.largest() < ROWS // 5
