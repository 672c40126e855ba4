"""Whole numbers without gaps, in a given order, over tables of any size.

Rows are dealt out by ranges of the order and written, each range one sorted
file. The second pass counts the rows of each file, which reads no column, and
adds the counts up in the order of the ranges; a row's number is what stands
before its file plus its place in the file, which Parquet readers know. So no
window goes over the rows, and no number depends on which task ran when.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablewarden.session import scratch_dir

_FILE, _FILE_ROWS, _FIRST = "_file", "_file_rows", "_first"
_ROW_TIE = "_row_tie"


def in_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in sorted ranges, partition after partition.

    Rows that tie in ``order`` go by their place in the scan, so equal rows are
    cut into ranges as well, however many there are.
    """
    tied = df.withColumn(_ROW_TIE, F.monotonically_increasing_id())
    keys = [*order, F.col(_ROW_TIE)]
    return tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(_ROW_TIE)


def write_in_ranges(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    in_ranges(df, order).write.parquet(path)


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """For each file of a folder its rows and the rows of all files of earlier ranges.

    One row for each file; the running total is over files, not over rows.
    """
    name = F.col("_metadata.file_name")
    counts = spark.read.parquet(path).groupBy(name.alias(_FILE)).agg(F.count("*").alias(_FILE_ROWS))
    place = F.regexp_extract(_FILE, r"^part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(_FIRST, F.coalesce(F.sum(_FILE_ROWS).over(before), F.lit(0)))


def numbered_files(rows: DataFrame, starts: DataFrame, name: str) -> DataFrame:
    """Rows as read from files with ``name``, from 0 on in the order they were written in."""
    placed = rows.select("*", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias("_place"))
    met = placed.join(starts.select(_FILE, _FIRST), _FILE)
    return met.select(*rows.columns, (F.col(_FIRST) + F.col("_place")).alias(name))


def with_serial(df: DataFrame, order: Sequence[str | Column], name: str = "id", start: int = 0) -> DataFrame:
    """The rows with a number from ``start`` on, without gaps, in ``order`` (nulls first).

    Rows that tie get neighbouring numbers in any order. The frame is written
    once to the shared scratch folder, so the numbers stay the same however
    often the result is read. An empty frame gives no rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "serials")
    write_in_ranges(df, path, order)
    starts_path = scratch_dir(spark, "serial-starts")
    file_starts(spark, path).coalesce(1).write.parquet(starts_path)
    rows = spark.read.schema(df.schema).parquet(path)
    out = numbered_files(rows, spark.read.parquet(starts_path), "_serial")
    return out.select(*df.columns, (F.col("_serial") + F.lit(start)).alias(name))
