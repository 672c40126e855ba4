"""Columns computed once from other columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def with_bar_columns(bars: DataFrame) -> DataFrame:
    """Day's change (close - open) and range (high - low)."""
    return bars.withColumns(
        {
            "daily_change": (F.col("close_price") - F.col("open_price")).cast("decimal(12,4)"),
            "daily_range": (F.col("high_price") - F.col("low_price")).cast("decimal(12,4)"),
        }
    )


def with_load_time(df: DataFrame, name: str = "created_at", at: Column | None = None) -> DataFrame:
    """Load timestamp; ``at`` fixes it for repeatable runs."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def with_surrogate_id(df: DataFrame, name: str = "id", start: int = 0) -> DataFrame:
    """A unique id from ``start`` on that may have gaps. Write the result before using it twice."""
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start).cast("bigint"))


def next_id(spark: SparkSession, path: str, name: str = "id", before_batch: int | None = None) -> int:
    """The first id above those stored in a folder of Parquet files; 0 if there is none.

    ``before_batch`` looks only at folders ``batch=n`` with a smaller number.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return 0
    stored = spark.read.schema(f"{name} bigint" + (", batch bigint" if before_batch is not None else "")).parquet(path)
    if before_batch is not None:
        stored = stored.where(F.col("batch") < before_batch)
    largest = stored.agg(F.max(name)).first()[0]
    return 0 if largest is None else largest + 1
