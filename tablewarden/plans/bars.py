"""Reports on daily bars. Every function takes a bars DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.functions.exact import mean, ratio, size_text, units
from tablewarden.operators.ordered import moving_means
from tablewarden.session import ROWS_PER_TASK
from tablewarden.sources.layout import YEAR

PEAK = "tum_zamanin_zirve_fiyati"
SPANS = {"hareketli_ort_20g": 20, "hareketli_ort_50g": 50}
RETURN = "ort_yillik_getiri_pct"
# bytes assumed per row in the size estimate
ROW_BYTES = 100


def range_scan(bars: DataFrame, symbol: str, since: date, until: date, columns: Sequence[str]) -> DataFrame:
    """One symbol between two days, both included, in date order."""
    return (
        bars.where((F.col("symbol") == symbol) & F.col("trade_date").between(since, until))
        .select(*columns)
        .orderBy("trade_date")
    )


def peak_all_time(bars: DataFrame, day: date) -> DataFrame:
    """Bars of a day with the highest close each symbol ever had.

    The peaks are aggregated before the join, so a crowded symbol reaches the
    join as one row.
    """
    peaks = bars.groupBy("symbol").agg(F.max("close_price").alias(PEAK))
    today = bars.where(F.col("trade_date") == day).select("symbol", "trade_date", "close_price")
    return today.join(peaks, "symbol", "left")


def peak_correlated(bars: DataFrame, day: date, rows: int = 10) -> DataFrame:
    """The same report as a correlated subquery, first ``rows`` symbols."""
    return bars.sparkSession.sql(
        f"""
        SELECT b.symbol, b.trade_date, b.close_price,
               (SELECT max(p.close_price) FROM {{bars}} p WHERE p.symbol = b.symbol) AS {PEAK}
        FROM {{bars}} b
        WHERE b.trade_date = :day
        ORDER BY b.symbol, b.close_price
        LIMIT {int(rows)}
        """,
        args={"day": day},
        bars=bars,
    )


def peak_same_day(bars: DataFrame, day: date) -> DataFrame:
    """Distinct bars of a day with the highest close of that day per symbol.

    The date filter comes before the maximum, so the peak is the day's own.
    A maximum over a whole partition is an aggregate joined back.
    """
    today = bars.where(F.col("trade_date") == day).select("symbol", "trade_date", "close_price")
    peaks = today.groupBy("symbol").agg(F.max("close_price").alias(PEAK))
    return today.distinct().join(peaks, "symbol")


def yearly_stats_of_states(states: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """``yearly_stats`` from stored states, one row each."""
    return (
        states.where(F.col("symbol").isin(*symbols))
        .select(
            "symbol",
            F.col(YEAR).alias("yil"),
            F.col("n_rows").alias("islem_gunu"),
            ratio(F.col("close_units"), F.col("n_close") * 10**4, 2).alias("ort_kapanis"),
            F.col("low").alias("yillik_dip"),
            F.col("high").alias("yillik_zirve"),
            F.col("volume").alias("toplam_hacim"),
        )
        .orderBy("symbol", "yil")
    )


def yearly_stats(bars: DataFrame, symbols: Sequence[str]) -> DataFrame:
    return (
        bars.where(F.col("symbol").isin(*symbols))
        .groupBy("symbol", F.year("trade_date").alias("yil"))
        .agg(
            F.count("*").alias("islem_gunu"),
            mean(F.sum("close_price"), F.count("close_price"), 4, 2).alias("ort_kapanis"),
            F.min("low_price").alias("yillik_dip"),
            F.max("high_price").alias("yillik_zirve"),
            F.sum("volume").alias("toplam_hacim"),
        )
        .orderBy("symbol", "yil")
    )


def top_movers_daily(bars: DataFrame, since: date, volume_above: int, places: int = 5, rows: int | None = 50) -> DataFrame:
    """Best ``places`` per day by absolute change, newest days first.

    Catalyst limits each map task to the needed ranks before the shuffle.
    """
    percent = ratio(units(F.col("daily_change"), 4, "bigint") * 100, units(F.col("open_price"), 4, "bigint"), 2, "bigint")
    best = F.rank().over(W.partitionBy("trade_date").orderBy(F.col("daily_change").desc_nulls_first()))
    ranked = (
        bars.where((F.col("trade_date") >= since) & (F.col("volume") > volume_above))
        .select("trade_date", "symbol", "daily_change", "open_price", best.alias("siralama"))
        .where(F.col("siralama") <= places)
    )
    out = ranked.select("trade_date", "symbol", "daily_change", percent.alias("degisim_yuzdesi"), "siralama")
    if rows is None:
        return out
    return out.orderBy(F.desc("trade_date"), "siralama", "symbol").limit(rows)


def moving_averages(bars: DataFrame, symbol: str, rows: int = 100, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """20 and 50 row means of one symbol, its first ``rows`` days."""
    one = bars.where(F.col("symbol") == symbol).select("symbol", "trade_date", "close_price")
    # the first rows need no later ones
    first = one.orderBy("trade_date", "close_price").limit(rows)
    means = moving_means(first, SPANS, ties=["close_price"], rows_per_task=rows_per_task)
    return means.select("trade_date", "close_price", *SPANS).orderBy("trade_date", "close_price")


def moving_averages_all(bars: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """20 and 50 row means of every symbol and day."""
    narrow = bars.select("symbol", "trade_date", "close_price")
    return moving_means(narrow, SPANS, ties=["close_price"], rows_per_task=rows_per_task)


def top_avg_close(bars: DataFrame, since: date, until: date, rows: int = 10) -> DataFrame:
    """Symbols with the highest mean close in a date range."""
    return (
        bars.where(F.col("trade_date").between(since, until))
        .groupBy("symbol")
        .agg(mean(F.sum("close_price"), F.count("close_price"), 4, 8).alias("ort_kapanis"))
        .orderBy(F.desc_nulls_last("ort_kapanis"), "symbol")
        .limit(rows)
    )


def _years(bars: DataFrame) -> DataFrame:
    return bars.groupBy(F.year("trade_date").alias("yil")).agg(
        F.count("*").alias("kayit_sayisi"), F.count_distinct("symbol").alias("farkli_hisse")
    )


def _year_columns(total):
    return [
        "yil",
        "kayit_sayisi",
        "farkli_hisse",
        ratio(F.col("kayit_sayisi") * 100, total, 2).alias("yuzdesi"),
        size_text(F.col("kayit_sayisi") * ROW_BYTES).alias("tahmini_alan"),
    ]


def year_share(bars: DataFrame) -> DataFrame:
    """Rows, symbols, share and estimated size per year.

    The window over everything runs on the grouped table, one row per year.
    """
    total = F.sum("kayit_sayisi").over(W.partitionBy(F.lit(1)))
    return _years(bars).select(*_year_columns(total)).orderBy("yil")


def year_share_subquery(bars: DataFrame) -> DataFrame:
    """The same report with the total from a scalar subquery."""
    total = bars.select(F.count("*").alias("n")).scalar()
    return _years(bars).select(*_year_columns(total)).orderBy("yil")


def top_volume(bars: DataFrame, rows: int = 10) -> DataFrame:
    return (
        bars.groupBy("symbol")
        .agg(
            F.sum("volume").alias("toplam_hacim"),
            mean(F.sum("close_price"), F.count("close_price"), 4, 2).alias("ort_kapanis"),
            F.count("*").alias("islem_gunu"),
        )
        .orderBy(F.desc_nulls_last("toplam_hacim"), "symbol")
        .limit(rows)
    )


def _with_return(yearly: DataFrame) -> DataFrame:
    first, last = F.col("yil_basi_fiyat"), F.col("yil_sonu_fiyat")
    return yearly.withColumn("getiri", ratio(units(last - first, 4) * 100, units(first, 4), 8, precision=30))


def yearly_returns_of_states(states: DataFrame) -> DataFrame:
    """``yearly_returns`` from stored states."""
    return _with_return(
        states.select(
            "symbol",
            F.col(YEAR).alias("yil"),
            F.col("first_close").alias("yil_basi_fiyat"),
            F.col("last_close").alias("yil_sonu_fiyat"),
            F.col("n_rows").alias("gun"),
        )
    )


def yearly_returns(bars: DataFrame) -> DataFrame:
    """First and last close of each symbol and year and the return in percent.

    First and last in a year are taken with a hash aggregate, not a window, so
    a crowded symbol is reduced in the map tasks. Of several rows of one day the
    lowest close is the day's first and the highest its last.
    """
    # day and close as one long: a close has at most twelve digits
    order = F.unix_date("trade_date").cast("bigint") * 2 * 10**12 + units(F.col("close_price"), 4, "bigint")
    return _with_return(
        bars.groupBy("symbol", F.year("trade_date").alias("yil")).agg(
            F.min_by("close_price", order).alias("yil_basi_fiyat"),
            F.max_by("close_price", order).alias("yil_sonu_fiyat"),
            F.count("*").alias("gun"),
        )
    )


def avg_yearly_return(bars: DataFrame, years: int = 4, rows: int = 15, equal_years: bool = False) -> DataFrame:
    """Mean yearly return of symbols seen in at least ``years`` years.

    A year weighs as many times as it has rows; ``equal_years`` weighs each
    year once.
    """
    return mean_returns(yearly_returns(bars), years, rows, equal_years)


def mean_returns(yearly: DataFrame, years: int = 4, rows: int = 15, equal_years: bool = False) -> DataFrame:
    """``avg_yearly_return`` from the returns of each year."""
    weight = F.when(F.col("getiri").isNotNull(), F.lit(1) if equal_years else F.col("gun"))
    total = F.sum((F.col("getiri") * weight.cast("decimal(12,0)")).cast("decimal(38,8)"))
    return (
        yearly.groupBy("symbol")
        .agg(F.count("yil").alias("yillar"), mean(total, F.sum(weight), 8, 2).alias(RETURN))
        .where(F.col("yillar") >= years)
        .select("symbol", RETURN)
        .orderBy(F.desc_nulls_first(RETURN), "symbol")
        .limit(rows)
    )


def load_summary(bars: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, symbols and date range; one row even for an empty table.

    ``approximate=True`` estimates the number of symbols, without a shuffle of them.
    """
    symbols = F.approx_count_distinct("symbol") if approximate else F.count_distinct("symbol")
    return bars.agg(
        F.count("*").alias("toplam_kayit"),
        symbols.alias("farkli_hisse"),
        F.min("trade_date").alias("ilk_tarih"),
        F.max("trade_date").alias("son_tarih"),
    )


def load_summary_of_states(states: DataFrame) -> DataFrame:
    """``load_summary`` from stored states."""
    return states.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("toplam_kayit"),
        F.count_distinct("symbol").alias("farkli_hisse"),
        F.min("first_day").alias("ilk_tarih"),
        F.max("last_day").alias("son_tarih"),
    )
