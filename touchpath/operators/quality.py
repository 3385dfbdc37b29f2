"""Reject reasons: the first failing test of a row, and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACCEPTED = "ACCEPTED"
INCOMPLETE = "NO_COMPLETE"
INVALID_DATA = "INVALID_DATA"
INVALID_URL = "INVALID_URL"
INVALID_TIME = "INVALID_TIME"
# all reasons of the checks in `touchpath.plans`
REASONS = (
    INCOMPLETE, INVALID_DATA, INVALID_URL, INVALID_TIME, "EXCLUDED_PRODUCT", "OTHER_PRODUCT", "OTHER_EVENT",
    "OTHER_ACTION", "FAILED", "INVALID_AMOUNT", "INVALID_PAGEID", "NO_TAG", "INVALID_TAG", "INVALID_TYPE",
    "INVALID_DEVICE", "UNKNOWN_PRODUCT",
)
MAX_TIME_MS = 253402300799999  # end of the year 9999


def first_failure(*tests: tuple[Column, str]) -> Column:
    """Reason of the first test that is true or unknown; NULL when the row passes all of them.

    A test that comes out NULL rejects the row: a missing value is not a good one. Tests
    for which a missing value is harmless say so themselves.
    """
    return F.coalesce(*[F.when(F.coalesce(failed, F.lit(True)), reason) for failed, reason in tests])


def no_time(millis: Column) -> Column:
    """Test for a time that is missing or beyond what a timestamp can hold."""
    return millis.isNull() | ~millis.between(-MAX_TIME_MS, MAX_TIME_MS)


def incomplete(rows: DataFrame, arity: int) -> list[tuple[Column, str]]:
    """Arity test; rows that do not come from a delimited file have no ``n_fields``."""
    if "n_fields" not in rows.columns:
        return []
    return [(F.coalesce(F.col("n_fields") != arity, F.lit(False)), INCOMPLETE)]


def with_reason(rows: DataFrame, *tests: tuple[Column, str]) -> DataFrame:
    """Add ``reject``; rows that have it are checked already (and perhaps observed) and stay as they are."""
    return rows if "reject" in rows.columns else rows.withColumn("reject", first_failure(*tests))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject").isNull()).drop("reject", "n_fields")


def count_outcomes(rows: DataFrame, *extra: Column) -> DataFrame:
    """Rows per reject reason (``ACCEPTED`` for the good ones)."""
    reason = F.coalesce("reject", F.lit(ACCEPTED)).alias("reason")
    return rows.groupBy(reason).agg(F.count(F.lit(1)).alias("n"), *extra)


def observe_outcomes(rows: DataFrame, observation: Observation, *reasons: str) -> DataFrame:
    """Count the given reasons while another job runs over the rows, without a second scan."""
    counts = [F.count_if(F.col("reject") == reason).alias(reason) for reason in reasons]
    return rows.observe(observation, F.count(F.lit(1)).alias("ALL"), *counts)


def observe_checks(checked: DataFrame, observation: Observation) -> DataFrame:
    """Count all outcomes while another job runs over the rows, without a second scan."""
    counts = [F.count_if(F.col("reject") == reason).alias(reason) for reason in REASONS]
    return checked.observe(observation, F.count_if(F.col("reject").isNull()).alias(ACCEPTED), *counts)


def observed_outcomes(spark: SparkSession, observation: Observation) -> DataFrame:
    """What `count_outcomes` gives, from a job over the rows of `observe_checks`."""
    found = [(reason, int(n)) for reason, n in observation.get.items() if n]
    return spark.createDataFrame(found, "reason string, n bigint")
