"""Table shapes, roles, policies and grants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Bookings file columns in file order, with the kind of each.
# int | number(p,s) | date | text(n); "sentinel" texts and numbers turn
# the words in NULL_WORDS into null.
BOOKING_COLUMNS: dict[str, str] = {
    "hotel": "text(50)",
    "is_canceled": "int",
    "lead_time": "int",
    "arrival_date_year": "int",
    "arrival_date_month": "text(20)",
    "arrival_date_week_number": "int",
    "arrival_date_day_of_month": "int",
    "stays_in_weekend_nights": "int",
    "stays_in_week_nights": "int",
    "adults": "int",
    "children": "number(10,2)",
    "babies": "int",
    "meal": "text(10)",
    "country": "text(10)",
    "market_segment": "text(30)",
    "distribution_channel": "text(30)",
    "is_repeated_guest": "int",
    "previous_cancellations": "int",
    "previous_bookings_not_canceled": "int",
    "reserved_room_type": "text(5)",
    "assigned_room_type": "text(5)",
    "booking_changes": "int",
    "deposit_type": "text(30)",
    "agent": "text(20)",
    "company": "text(20)",
    "days_in_waiting_list": "int",
    "customer_type": "text(30)",
    "adr": "number(10,2)",
    "required_car_parking_spaces": "int",
    "total_of_special_requests": "int",
    "reservation_status": "text(20)",
    "reservation_status_date": "date",
}
SENTINEL_COLUMNS = ("children", "agent", "company")
NULL_WORDS = ("NULL", "NA", "")

# Columns of a booking that describe the guest; they move to the guests table.
GUEST_COLUMNS = {"country": "ulke", "customer_type": "musteri_tipi", "is_repeated_guest": "tekrar_misafir"}
# Columns kept in neither table.
DROPPED_COLUMNS = ("previous_cancellations", "previous_bookings_not_canceled")

_PRICE = T.DecimalType(12, 4)
BARS = T.StructType(
    [
        T.StructField("trade_date", T.DateType(), False),
        T.StructField("open_price", _PRICE, False),
        T.StructField("high_price", _PRICE, False),
        T.StructField("low_price", _PRICE, False),
        T.StructField("close_price", _PRICE, False),
        T.StructField("volume", T.LongType(), False),
        T.StructField("symbol", T.StringType(), False, {"max_length": 10}),
    ]
)
# Texts that reports and tables show.
BLOCKED_TEXT, LOGGED_TEXT = "Yetkisiz Fiyat Degisiklik Denemesi", "Admin Fiyat Guncelleme"
LOG_PARTS = ("Kullanici: ", " | Saat: ", " | Islem: ", " | Otel: ", " | Degisim: %")
NEVER_USED, SELDOM_USED, OFTEN_USED = "KALDIR - Hic kullanilmamis", "GOZDEN GECIR - Az kullaniliyor", "Aktif - Koru"
UNUSED_STATE, USED_STATE = "KULLANIMIYOR - Kaldir!", "Aktif"
PAIR_WARNING = "Indeks_1 Indeks_2 ile kapsaniyor olabilir"
BARS_COMMENT = "S&P 500 hisse senedi fiyat verileri (2013-2018)"
# Years with a partition; a day outside is a violation.
BAR_YEARS = (2013, 2018)

AUDIT_LOG = T.StructType(
    [
        T.StructField("log_id", T.LongType()),
        T.StructField("kullanici_adi", T.StringType()),
        T.StructField("islem_zamani", T.TimestampType()),
        T.StructField("tablo_adi", T.StringType()),
        T.StructField("islem_turu", T.StringType()),
        T.StructField("aciklama", T.StringType()),
        T.StructField("eski_deger", T.DecimalType(10, 2)),
        T.StructField("yeni_deger", T.DecimalType(10, 2)),
        T.StructField("rezervasyon_id", T.LongType()),
    ]
)

QUERY_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("logged_at", T.TimestampType()),
        T.StructField("username", T.StringType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("duration_ms", T.DecimalType(10, 3)),
        T.StructField("rows_returned", T.LongType()),
        T.StructField("notes", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Policy:
    name: str
    table: str
    role: str
    predicate: str
    command: str = "ALL"


@dataclass(frozen=True)
class Grant:
    role: str
    table: str
    privilege: str


RESERVATIONS, GUESTS, LOG = "rezervasyonlar", "musteriler", "guvenlik_loglari"
BAR_TABLE, QUERY_LOG_TABLE = "stock_prices", "query_audit_log"

# Who sees which reservations.
POLICIES = (
    Policy("city_hotel_policy", RESERVATIONS, "city_reception", "hotel = 'City Hotel'"),
    Policy("resort_hotel_policy", RESERVATIONS, "resort_reception", "hotel = 'Resort Hotel'"),
    Policy("admin_full_access", RESERVATIONS, "admin", "true"),
)

# Role, table, privileges.
_GRANTS = """
city_reception    rezervasyonlar    SELECT
resort_reception  rezervasyonlar    SELECT
admin             rezervasyonlar    SELECT INSERT UPDATE DELETE
city_reception    musteriler        SELECT
resort_reception  musteriler        SELECT
admin             musteriler        SELECT INSERT UPDATE DELETE
admin             guvenlik_loglari  SELECT INSERT
city_reception    guvenlik_loglari  INSERT
resort_reception  guvenlik_loglari  INSERT
stocks_analyst    stock_prices      SELECT
stocks_analyst    query_audit_log   SELECT
stocks_readonly   stock_prices      SELECT
stocks_etl        stock_prices      INSERT SELECT
stocks_admin      stock_prices      SELECT INSERT UPDATE DELETE TRUNCATE REFERENCES TRIGGER
stocks_admin      query_audit_log   SELECT INSERT UPDATE DELETE TRUNCATE REFERENCES TRIGGER
"""
GRANTS = tuple(
    Grant(role, table, privilege)
    for role, table, *privileges in (line.split() for line in _GRANTS.strip().splitlines())
    for privilege in privileges
)

# Roles whose price changes are refused, and roles whose changes are logged.
BLOCKED_ROLES = ("city_reception", "resort_reception")
LOGGED_ROLES = ("admin",)
