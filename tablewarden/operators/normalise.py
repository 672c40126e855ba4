"""Split loaded bookings into guests and reservations.

The id given at load feeds both tables, so a reservation's guest is known from
its own row and no join or shuffle is needed to link them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewarden.functions.cards import card_number, card_token
from tablewarden.schemas import BOOKING_COLUMNS, DROPPED_COLUMNS, GUEST_COLUMNS


def guests(bookings: DataFrame, pepper: str, draw: Column | None = None, salt: Column | None = None) -> DataFrame:
    """One guest per booking, with a card token. Write the result once."""
    return bookings.select(
        F.col("id").alias("musteri_id"),
        *[F.col(old).alias(new) for old, new in GUEST_COLUMNS.items()],
        card_token(card_number(draw), pepper, salt).alias("kredi_karti"),
    )


def reservations(bookings: DataFrame) -> DataFrame:
    kept = [c for c in BOOKING_COLUMNS if c not in GUEST_COLUMNS and c not in DROPPED_COLUMNS]
    return bookings.select(F.col("id").alias("rezervasyon_id"), F.col("id").alias("musteri_id"), *kept)
