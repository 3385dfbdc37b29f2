"""Small text jobs: word count and grouped, sorted integer pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchpath.functions.labels import action_label, module_label

# fixed value: line written before each group
GROUP_SEPARATOR = "------------------------------------------------"


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of every whitespace-separated word."""
    words = lines.select(F.explode(F.split(column, "[ \t\n\r\f]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def secondary_sort(pairs: DataFrame) -> DataFrame:
    """Lines of the grouped listing: a separator before each first value, then its pairs.

    ``bucket`` is the output file of a line (first <= 10, <= 20, rest). The order is one
    distributed sort on all columns, so a very frequent first value is split as well; a
    last sort column tells equal pairs apart, so that one frequent pair is split too.
    """
    first, second = F.col("first"), F.col("second")
    listed = pairs.select(
        "first", "second",
        F.concat_ws("\t", first.cast("string"), second.cast("string")).alias("line"),
    )
    separators = pairs.select("first").distinct().select(
        "first", F.lit(None).cast("int").alias("second"), F.lit(GROUP_SEPARATOR).alias("line")
    )
    bucket = F.when(first <= 10, 0).when(first <= 20, 1).otherwise(2)
    return (
        listed.unionByName(separators)
        .select(bucket.alias("bucket"), "first", "second", "line",
                F.monotonically_increasing_id().alias("tie"))
        .orderBy("bucket", "first", F.asc_nulls_first("second"), "tie")
        .drop("tie")
    )


def write_secondary_sort(listing: DataFrame, path: str) -> None:
    """Write the listing as text, one directory per bucket."""
    listing.select("bucket", F.col("line").alias("value")).write.partitionBy("bucket").text(path)


def write_word_count(counts: DataFrame, path: str) -> None:
    counts.select("word", "n").write.csv(path, sep="\t", quote="")


def count_by_action(rows: DataFrame) -> DataFrame:
    """Events per action with its label; unknown actions fall back to a default label."""
    counted = rows.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("type", action_label(F.col("type"), "?").alias("label"), "n")


def count_by_module(rows: DataFrame, column: str = "proid") -> DataFrame:
    """Events per module with its label."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(column, module_label(F.col(column), "?").alias("label"), "n")

