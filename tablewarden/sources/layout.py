"""Year-partitioned bars: write, pruned read and partition inventory."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.exact import size_text
from tablewarden.operators.constraints import outside_years
from tablewarden.schemas import BARS_COMMENT

YEAR = "trade_year"


def write_by_year(bars: DataFrame, path: str, mode: str = "overwrite", years: tuple[int, int] | None = None) -> None:
    """Write bars under one folder per year, clustered by symbol and day.

    A row without a day has no folder and stops the write; with ``years``, the
    first and the last, so does a day outside them.

    Overwriting replaces the years that are in the input and keeps the others.

    The range shuffle cuts a crowded year or symbol into several tasks, each of
    which writes a narrow range, so file statistics prune by symbol. AQE picks
    the number of ranges.
    """
    nowhere = F.col("trade_date").isNull() if years is None else outside_years(F.col("trade_date"), *years)
    refused = F.raise_error(F.concat(F.lit("no partition for day "), F.coalesce(F.col("trade_date").cast("string"), F.lit("null"))))
    clustered = (
        bars.withColumn(YEAR, F.when(nowhere, refused.cast("int")).otherwise(F.year("trade_date")))
        .repartitionByRange(YEAR, "symbol", "trade_date")
        .sortWithinPartitions(YEAR, "symbol", "trade_date")
    )
    clustered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(path)


def read_by_year(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def register(spark: SparkSession, name: str, path: str, comment: str = BARS_COMMENT) -> None:
    """Name the folder in the catalog with a comment and fresh size statistics; safe to repeat."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", description=comment)
    spark.catalog.recoverPartitions(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")


def between_dates(since: date, until: date, day: str = "trade_date") -> Column:
    """Date range that also names the years, so folders outside are not listed."""
    return F.col(day).between(since, until) & F.col(YEAR).between(since.year, until.year)


def partition_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Rows and bytes per year folder.

    Rows are counted per file first, so the second step sees one row per file.
    """
    files = (
        read_by_year(spark, path)
        .groupBy(YEAR, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .agg(F.count("*").alias("n"))
    )
    return (
        files.groupBy(YEAR)
        .agg(F.sum("n").alias("satir_sayisi"), F.sum("size").alias("bayt"))
        .withColumn("boyut", size_text(F.col("bayt")))
        .orderBy(YEAR)
    )


def table_size(df: DataFrame) -> DataFrame:
    """Bytes of the files behind a file-based table."""
    files = df.groupBy(F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size")).count()
    return files.agg(F.sum("size").alias("bayt")).withColumn("tablo_boyutu", size_text(F.col("bayt")))
