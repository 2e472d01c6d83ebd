"""Reports as files: one folder a month, rows in key order across files and inside them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def _folder(root: str, month: date) -> str:
    return f"{root.rstrip('/')}/month={month:%Y-%m}"


def _keys(keys: Sequence[str]) -> list:
    return [F.col(f"`{k}`") for k in keys]


def write_month(report: DataFrame, root: str, month: date, keys: Sequence[str], files: int | None = None) -> None:
    """Write a month's report under ``root`` in the order of ``keys``, replacing that month and no other.

    Rows are dealt to files by key ranges, sampled from the report, and sorted inside each, so the
    file names in order hold the report in order and no task sees all of it. Rows with equal keys
    stay in one file: end ``keys`` with a column that tells rows apart. NULLs come first. An empty
    report leaves an empty month. A run that fails leaves the month to be written again.
    """
    dealt = report.repartitionByRange(files, *_keys(keys)) if files else report.repartitionByRange(*_keys(keys))
    dealt.sortWithinPartitions(*_keys(keys)).write.mode("overwrite").parquet(_folder(root, month))


def read_month(spark: SparkSession, root: str, month: date) -> DataFrame:
    """A month's rows with ``file`` and ``place``, by which they are in the order they were written in."""
    rows = spark.read.parquet(_folder(root, month))
    return rows.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))


def misplaced(spark: SparkSession, root: str, month: date, keys: Sequence[str]) -> DataFrame:
    """Places where a month's files are out of order: a row below the one before it, or a file that begins below the end of
    an earlier one. No row for files in order.

    Each file is read in its own order by one task, and files meet by their first and last keys.
    """
    rows = read_month(spark, root, month).select("file", "place", F.struct(*_keys(keys)).alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("place"))
    inside = rows.withColumn("before", before).where("key < before").select("file", "place")
    ends = rows.groupBy("file").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    reached = F.max("last").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return inside.unionByName(ends.withColumn("reached", reached).where("first < reached").select("file", F.lit(0).cast("long").alias("place")))
