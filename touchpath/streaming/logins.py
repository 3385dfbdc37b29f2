"""First logins as keyed state of a stream.

Spark keeps, per device and customer, the earliest time of each app family and the earliest
login of all, as a streaming aggregation: a batch is summed up before it is dealt by key,
meets the state there, and emits the new rows of the keys it has logins of. Later batches
are compared with the state, no stored table is read again. The result does not depend on
how files fall into batches, and a busy device is one row per task and batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath import config as c
from touchpath.plans import app
from touchpath.sources.tables import LOGIN_STATE

STATE = "savings bigint, fund bigint, first bigint, flag int"
UPDATE = f"deviceid string, custno string, {STATE}"


def earliest_logins(rows: DataFrame, decrypt=None) -> DataFrame:
    """New rows of the keyed state, for a stream in update mode."""
    def earliest(products: tuple[str, ...]) -> Column:
        return F.min(F.when(F.col("proid").isin(*products), F.col("ts")))

    state = app.logins(rows, decrypt).groupBy("deviceid", "custno").agg(
        earliest(c.APP_SAVINGS).alias("savings"), earliest(c.APP_FUND).alias("fund"),
        F.min(F.struct("ts", "flag")).alias("least"))
    return state.select("deviceid", "custno", "savings", "fund", F.col("least.ts").alias("first"), "least.flag")


def store_updates(updates: DataFrame, path: str):
    """Write the updates of each batch under its id; a repeated batch replaces itself."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return updates.writeStream.outputMode("update").foreachBatch(store)


def login_table(spark: SparkSession, path: str) -> DataFrame:
    """The state as of the last batch: the latest update of each key."""
    updates = spark.read.schema(f"{UPDATE}, batch bigint").parquet(path)
    last = updates.groupBy("deviceid", "custno").agg(F.max_by(F.struct("savings", "fund", "flag"), "batch").alias("x"))
    times = [F.timestamp_millis(F.col(f"x.{name}")).alias(column) for name, column in zip(("savings", "fund"), LOGIN_STATE[2:4])]
    return last.select("deviceid", "custno", *times, F.col("x.flag").alias("flag"))
