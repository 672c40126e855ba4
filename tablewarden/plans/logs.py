"""Reports on a query log table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.exact import mean, ratio, units
from tablewarden.schemas import NEVER_USED, OFTEN_USED, SELDOM_USED, UNUSED_STATE, USED_STATE


def _statements(log: DataFrame, pattern: str) -> DataFrame:
    # grouped by the whole text; only the display is cut
    ms = F.col("duration_ms")
    return (
        log.where(F.col("query_text").ilike(pattern))
        .groupBy("query_text")
        .agg(
            F.count("*").alias("cagri_sayisi"),
            F.sum(ms).alias("_total"),
            F.count(ms).alias("_timed"),
            F.min(ms).alias("_min"),
            F.max(ms).alias("_max"),
            F.sum("rows_returned").alias("toplam_satir"),
        )
    )


def slow_statements(log: DataFrame, pattern: str = "%stock_prices%", rows: int = 20) -> DataFrame:
    """Slowest statements by mean time."""
    return (
        _statements(log, pattern)
        .withColumn("_mean", mean(F.col("_total"), F.col("_timed"), 3, 8))
        .orderBy(F.desc_nulls_first("_mean"), "query_text")
        .limit(rows)
        .select(
            F.left("query_text", F.lit(100)).alias("sorgu_ozeti"),
            "cagri_sayisi",
            F.round("_total", 2).alias("toplam_sure_ms"),
            mean(F.col("_total"), F.col("_timed"), 3, 2).alias("ortalama_sure_ms"),
            F.round("_min", 2).alias("min_sure_ms"),
            F.round("_max", 2).alias("max_sure_ms"),
            "toplam_satir",
        )
    )


def rows_per_call(log: DataFrame, pattern: str = "%") -> DataFrame:
    """Rows read per call of each statement, and its share of the logged time."""
    return (
        _statements(log, pattern)
        .select(
            "query_text",
            "cagri_sayisi",
            "toplam_satir",
            ratio(F.col("toplam_satir"), F.col("cagri_sayisi"), 1).alias("cagri_basina_satir"),
            ratio(F.col("toplam_satir") * 1000, units(F.col("_total"), 3), 2).alias("ms_basina_satir"),
        )
        .orderBy(F.desc("toplam_satir"), "query_text")
    )


def latest_log(log: DataFrame, rows: int = 10) -> DataFrame:
    return (
        log.orderBy(F.desc_nulls_first("logged_at"), F.desc("id"))
        .limit(rows)
        .select(
            F.col("notes").alias("test_tipi"),
            F.round("duration_ms", 3).alias("sure_ms"),
            F.col("rows_returned").alias("satir_sayisi"),
            F.col("logged_at").alias("test_zamani"),
        )
    )


def statement_ages(log: DataFrame, as_of: datetime, state: str, pattern: str) -> DataFrame:
    """Seconds since each statement, without one state and without matching texts."""
    # as text, so that a time without zone is not shifted by the session's zone
    now = F.lit(as_of.isoformat(sep=" ")).cast(log.schema["logged_at"].dataType)
    micros = F.timestamp_diff("MICROSECOND", F.col("logged_at"), now)
    return (
        log.where((F.col("notes") != state) & ~F.col("query_text").ilike(pattern))
        .select(
            F.col("id").alias("pid"),
            F.col("username").alias("kullanici"),
            F.col("notes").alias("durum"),
            ratio(micros, F.lit(1_000_000), 2, "bigint").alias("sure_saniye"),
            F.left("query_text", F.lit(120)).alias("sorgu"),
            "logged_at",
        )
        .orderBy("logged_at", "pid")
        .drop("logged_at")
    )


def usage_bands(known: DataFrame, key: str, uses: DataFrame) -> DataFrame:
    """Uses of every known key and the advice for it; a key never used counts 0.

    Uses are counted per key before the join.
    """
    counts = uses.groupBy(key).agg(F.count("*").alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    advice = (
        F.when(n == 0, NEVER_USED)
        .when(n < 10, SELDOM_USED)
        .otherwise(OFTEN_USED)
    )
    return known.select(key).join(counts, key, "left").select(
        key,
        n.alias("kullanim_sayisi"),
        advice.alias("oneri"),
        F.when(n == 0, UNUSED_STATE).otherwise(USED_STATE).alias("durum"),
    )
