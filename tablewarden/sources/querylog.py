"""Append-only query log: timed runs and their rows."""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewarden.schemas import QUERY_LOG


def append_log(rows: DataFrame, path: str) -> None:
    rows.select(*QUERY_LOG.fieldNames()).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUERY_LOG).parquet(path)


def run_whole(df: DataFrame) -> tuple[int, float]:
    """Runs every row and column of a query into nothing; its rows and its milliseconds.

    The rows are counted on the way, so sorts and columns of the query stay in
    the plan, unlike with ``count()``.
    """
    seen = Observation()
    start = time.perf_counter()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"], (time.perf_counter() - start) * 1000


def timed_run(df: DataFrame, path: str, *, user: str, text: str, notes: str) -> int:
    """Run a query, log user, text, milliseconds, rows and note."""
    rows, took = run_whole(df)
    ms = Decimal(str(round(took, 3)))
    row = (uuid.uuid4().int >> 65, datetime.now(timezone.utc), user, text, ms, rows, notes)
    append_log(df.sparkSession.createDataFrame([row], QUERY_LOG), path)
    return rows
