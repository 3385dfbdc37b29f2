"""Delimited log readers.

Every log is text with control-A between fields. A reader names the positions the
reports use, so only those fields leave the scan; ``n_fields`` keeps the arity for
the completeness check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchpath.config import FIELD_SEPARATOR
from touchpath.functions.text import trim_field
from touchpath.operators import quality as q

BLANK, NOT_A_NUMBER = "BLANK", "NOT_A_NUMBER"


@dataclass(frozen=True)
class LogLayout:
    """Number of fields of a log and the 0-based positions of the named ones."""

    arity: int
    positions: dict[str, int]


# --- fixed values: log layouts -----------------------------------------------
PAGE_VIEW = LogLayout(27, {
    "guid": 0, "ts": 1, "srcurl": 2, "htag": 10, "desturl": 12, "pageid": 18, "proid": 22,
})
TRADE = LogLayout(32, {
    "ts": 1, "type": 2, "url": 3, "amt": 7, "tx_rslt": 13, "guid": 15, "otrack": 24,
})
H5_EVENT = LogLayout(21, {"type": 1, "productid": 19, "otrack": 20})
AD_CLICK = LogLayout(17, {"guid": 0, "ts": 1, "pageid": 12, "tag": 14, "proid": 16})
APP_LOGIN = LogLayout(13, {
    "ts": 0, "proid": 1, "imei": 2, "ios_guid": 3, "type": 5, "custno": 6,
})


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Text lines of one or several paths (globs allowed) as column ``value``."""
    return spark.read.text([paths] if isinstance(paths, str) else list(paths))


def split_fields(lines: DataFrame) -> DataFrame:
    """All fields of each line, trimmed; empty fields are kept, trailing ones too."""
    fields = F.split("value", FIELD_SEPARATOR, -1)
    return lines.select(F.transform(fields, trim_field).alias("fields"))


def parse(lines: DataFrame, layout: LogLayout, keep: Sequence[str] = ()) -> DataFrame:
    """Named, trimmed fields of each line plus ``n_fields``.

    Positions beyond the end of a short line are NULL. ``keep`` passes further
    columns of ``lines`` through.

    The line is split in one step and unpacked in a second one, by a generator that gives
    one row per line. Filters on the fields stay above it; pushed through a plain
    projection, they would repeat the split for every field they mention.
    """
    split = lines.select(*keep, F.split("value", FIELD_SEPARATOR, -1).alias("fields"))
    named = [
        trim_field(F.get("fields", F.lit(i))).alias(name)
        for name, i in layout.positions.items()
    ]
    row = F.struct(F.size("fields").alias("n_fields"), *named)
    return split.select(*keep, F.inline(F.array(row)))


def complete(rows: DataFrame, layout: LogLayout) -> DataFrame:
    """Rows with the right number of fields."""
    return rows.where(F.col("n_fields") == layout.arity).drop("n_fields")


def read_log(spark: SparkSession, paths: str | Sequence[str], layout: LogLayout) -> DataFrame:
    return parse(read_lines(spark, paths), layout)


def hourly_glob(root: str, dt: str, hour: int) -> str:
    """Glob for the files of one hour: names ending in ``<dt>.<hour>``, hour not padded."""
    return f"{root.rstrip('/')}/*{dt}.{hour}"


def check_int_pairs(lines: DataFrame) -> DataFrame:
    """Pairs of whitespace-separated integers with a ``reject`` reason; a missing second one is 0."""
    tokens = F.split(trim_field(F.col("value")), r"\s+")
    first, second = F.get(tokens, F.lit(0)), F.get(tokens, F.lit(1))
    pairs = lines.select(
        first.try_cast("int").alias("first"),
        F.when(second.isNull(), F.lit(0)).otherwise(second.try_cast("int")).alias("second"),
        (F.coalesce(first, F.lit("")) == "").alias("blank"),
    )
    return pairs.withColumn("reject", q.first_failure(
        (F.col("blank"), BLANK),
        (F.col("first").isNull() | F.col("second").isNull(), NOT_A_NUMBER),
    )).drop("blank")


def read_int_pairs(lines: DataFrame) -> DataFrame:
    """The pairs of the lines that hold some; `int_pair_outcomes` counts the others."""
    return q.accepted(check_int_pairs(lines))


def int_pair_outcomes(lines: DataFrame) -> DataFrame:
    return q.count_outcomes(check_int_pairs(lines))
