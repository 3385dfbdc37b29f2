"""Session settings for large inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Narrow rows reach the shuffles, so many small partitions are cheap: AQE starts from a
# high number and merges them to the advisory size. Joins only broadcast what AQE has
# measured to be below the threshold (size estimates alone never broadcast), and skewed
# join partitions are split.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(name: str, **conf: str) -> SparkSession:
    """A session with the cluster settings; ``conf`` overrides or adds to them."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**CLUSTER_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
