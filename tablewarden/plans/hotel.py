"""Reports on reservations and guests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.cards import masked
from tablewarden.functions.exact import mean


def tenant_overview(reservations: DataFrame) -> DataFrame:
    """Reservations, mean price and cancellations per hotel."""
    return (
        reservations.groupBy("hotel")
        .agg(
            F.count("*").alias("toplam_rezervasyon"),
            mean(F.sum("adr"), F.count("adr"), 2, 2).alias("ortalama_fiyat"),
            F.sum(F.when(F.col("is_canceled") == 1, 1).otherwise(0)).alias("iptal_sayisi"),
        )
        .orderBy(F.asc_nulls_last("hotel"))
    )


def tenant_counts(reservations: DataFrame) -> DataFrame:
    return reservations.groupBy("hotel").agg(F.count("*").alias("kayit_sayisi")).orderBy(F.asc_nulls_last("hotel"))


def lookup_by_country(reservations: DataFrame, guests: DataFrame, country: str, rows: int = 20) -> DataFrame:
    """Reservations of guests from a country. The country is bound, never SQL text."""
    return reservations.sparkSession.sql(
        f"""
        SELECT r.rezervasyon_id, r.hotel, g.ulke, r.adr, r.reservation_status
        FROM {{r}} r JOIN {{g}} g ON g.musteri_id = r.musteri_id
        WHERE g.ulke = :country
        ORDER BY r.rezervasyon_id
        LIMIT {int(rows)}
        """,
        args={"country": country},
        r=reservations,
        g=guests,
    )


def masked_cards(guests: DataFrame, rows: int = 10, shown: int = 29) -> DataFrame:
    """First guests in id order with the card token cut."""
    return (
        guests.select("musteri_id", "ulke", "musteri_tipi", masked(F.col("kredi_karti"), shown).alias("sifreli_kredi_karti"))
        .orderBy("musteri_id")
        .limit(rows)
    )


def origin_overview(reservations: DataFrame, guests: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Reservations per region and country.

    Reservations are reduced to one row per guest before the three joins.
    """
    per_guest = reservations.groupBy("musteri_id").agg(F.count("*").alias("n"), F.sum("is_canceled").alias("c"))
    return (
        per_guest.join(guests, "musteri_id")
        .join(nations, F.col("ulke") == F.col("n_name"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("bolge"), "ulke")
        .agg(F.sum("n").alias("toplam_rezervasyon"), F.sum("c").alias("iptal_sayisi"))
        .orderBy("bolge", "ulke")
    )
