"""The driver's star-schema tables seen as bars, bookings, changes and logs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.operators.derived import with_bar_columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TRADE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def trade_order(lines: DataFrame):
    """One number that orders the trades of a bar: order, line, part, then supplier.

    A pruned pass finds how many bits each of them has. Where all fit into one
    long it is a long, which aggregates compare fastest; wider keys become a
    decimal. Both stand in buffers of fixed width, so the aggregates stay hash
    aggregates, and both order alike.
    """
    ends = lines.agg(*[f(c).alias(f"{name}_{c}") for c in TRADE_KEY for f, name in ((F.min, "least"), (F.max, "largest"))]).first()
    widths = [int(ends[f"largest_{c}"] or 0).bit_length() for c in TRADE_KEY]
    if sum(widths) < 63 and all((ends[f"least_{c}"] or 0) >= 0 for c in TRADE_KEY):
        packed = F.lit(0).cast("bigint")
        for name, width in zip(TRADE_KEY, widths, strict=True):
            packed = F.shiftleft(packed, width).bitwiseOR(F.col(name).cast("bigint"))
        return packed
    return wide_trade_order()


def wide_trade_order():
    """The same as a decimal; a key with more digits than its place has stops the query."""
    whole = F.col(TRADE_KEY[0]).cast("decimal(14,0)").cast("decimal(38,0)")
    for name, digits in zip(TRADE_KEY[1:], (3, 11, 10), strict=True):
        step = F.lit(Decimal(10) ** digits).cast(f"decimal({digits + 1},0)")
        whole = (whole * step + F.col(name).cast(f"decimal({digits},0)")).cast("decimal(38,0)")
    return whole


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per brand."""
    return bars_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))


def bars_of(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Prices become decimals after the aggregate, once per bar."""
    price, order = F.col("l_extendedprice"), trade_order(lines)
    parts = parts.select("p_partkey", "p_brand")
    out = (
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .groupBy(
            F.col("p_brand").alias("symbol"),
            F.col("l_shipdate").cast("date").alias("trade_date"),
        )
        .agg(
            F.min_by(price, order).cast("decimal(12,4)").alias("open_price"),
            F.max(price).cast("decimal(12,4)").alias("high_price"),
            F.min(price).cast("decimal(12,4)").alias("low_price"),
            F.max_by(price, order).cast("decimal(12,4)").alias("close_price"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
        )
    )
    return with_bar_columns(out)


def _hotel():
    """Hotel by priority; one priority has none."""
    return F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "City Hotel").when(
        F.col("o_orderpriority").isin("4-NOT SPECIFIED", "5-LOW"), "Resort Hotel"
    )


def reservations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rezervasyon_id"),
        F.col("o_custkey").alias("musteri_id"),
        _hotel().alias("hotel"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_canceled"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("adr"),
        F.col("o_orderstatus").alias("reservation_status"),
        F.col("o_orderdate").cast("date").alias("reservation_status_date"),
    )


def guests(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey).select(
        F.col("c_custkey").alias("musteri_id"),
        F.col("n_name").alias("ulke"),
        F.col("c_mktsegment").alias("musteri_tipi"),
        (F.col("c_acctbal") > 0).cast("int").alias("tekrar_misafir"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price changes; event ids are unique and rise with time."""
    role = (
        F.when(F.col("event_type") == "purchase", "admin")
        .when(F.col("event_type") == "click", "city_reception")
        .when(F.col("event_type") == "view", "resort_reception")
        .when(F.col("event_type") == "signup", "manager")
        .otherwise("visitor")
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("islem_zamani"),
        role.alias("role"),
        F.col("user_id").alias("rezervasyon_id"),
        F.when(F.col("event_id") % 97 != 0, F.col("value")).cast("decimal(10,2)").alias("new_adr"),
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("logged_at"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("username"),
        F.concat_ws(" ", F.lit("SELECT"), F.col("event_type"), F.lit("WHERE"), F.col("props")).alias("query_text"),
        F.col("value").cast("decimal(10,3)").alias("duration_ms"),
        (F.col("user_id") % 50).alias("rows_returned"),
        F.col("event_type").alias("notes"),
    )


def used_rights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rights as exercised in the event log: role, table and privilege."""
    privilege = (
        F.when(F.col("event_type") == "view", "SELECT")
        .when(F.col("event_type") == "signup", "INSERT")
        .when(F.col("event_type") == "click", "UPDATE")
        .when(F.col("event_type") == "purchase", "DELETE")
        .otherwise("REFERENCES")
    )
    table_name = (
        F.when(F.col("value") < 20, "stock_prices")
        .when(F.col("value") < 60, "query_audit_log")
        .otherwise("rezervasyonlar")
    )
    events = table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("grantee"),
        table_name.alias("table_name"),
        privilege.alias("privilege_type"),
    )


def unchecked_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bars before any check, with faults that follow from the data."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).cast("decimal(12,4)").alias("open_price"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).cast("decimal(12,4)").alias("close_price"),
        # some amounts carry a unit, some are too large for (10,2)
        F.concat(
            F.col("l_extendedprice").cast("decimal(12,2)").cast("string"),
            F.when(F.col("l_linenumber") == 7, " TL").otherwise(""),
            F.when(F.col("l_linenumber") == 6, "e6").otherwise(""),
        ).alias("amount"),
        F.repeat(F.col("l_returnflag"), F.col("l_linenumber") * 2).alias("symbol"),
    )


def booking_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV lines of the bookings file, with faults that follow from the key."""
    k = F.col("o_orderkey")
    every = lambda n, text, other: F.when(k % n == 0, text).otherwise(other)
    price = F.col("o_totalprice").cast("decimal(10,2)").cast("string")
    text = {
        "hotel": every(29, "H" * 51, F.coalesce(F.col("hotel"), F.lit("Garden Hotel"))),
        "is_canceled": F.when(F.col("o_orderstatus") == "F", 1).otherwise(0),
        "lead_time": k % 400,
        "arrival_date_year": F.year("o_orderdate"),
        "arrival_date_month": F.date_format("o_orderdate", "MMMM"),
        "arrival_date_week_number": F.weekofyear("o_orderdate"),
        "arrival_date_day_of_month": F.dayofmonth("o_orderdate"),
        "stays_in_weekend_nights": k % 3,
        "stays_in_week_nights": k % 5,
        "adults": k % 2 + 1,
        "children": every(7, "NA", every(11, "", (k % 4).cast("string"))),
        "babies": k % 2,
        "meal": every(5, "NULL", F.lit("BB")),
        "country": every(6, "NULL", every(10, "", F.col("n_name"))),
        "market_segment": F.col("c_mktsegment"),
        "distribution_channel": F.lit("Direct"),
        "is_repeated_guest": F.when(F.col("c_acctbal") > 0, 1).otherwise(0),
        "previous_cancellations": k % 2,
        "previous_bookings_not_canceled": k % 3,
        "reserved_room_type": F.chr(k % 8 + 65),
        "assigned_room_type": F.chr(k % 9 + 65),
        "booking_changes": every(13, F.concat(F.lit("x"), k), (k % 4).cast("string")),
        "deposit_type": F.lit("No Deposit"),
        "agent": every(7, "NULL", F.col("o_custkey").cast("string")),
        "company": every(11, "", every(3, "NA", F.col("o_custkey").cast("string"))),
        "days_in_waiting_list": k % 20,
        "customer_type": every(4, "Group", F.lit("Transient")),
        "adr": every(17, "abc", every(19, F.concat(price, F.lit("5")), price)),
        "required_car_parking_spaces": k % 2,
        "total_of_special_requests": k % 6,
        "reservation_status": F.when(F.col("o_orderstatus") == "F", "Canceled").otherwise("Check-Out"),
        "reservation_status_date": every(23, "2017-02-30", F.date_format("o_orderdate", "yyyy-MM-dd")),
    }
    fields = [c.cast("string") for c in text.values()]
    # the two last fields go together, and the rest is built once
    last = F.when(k % 31 == 0, None).otherwise(F.concat_ws(",", *fields[-2:]))
    line = F.concat_ws(",", *fields[:-2], last)
    orders = table(spark, sf_dir, "orders")
    tasks = spark.sparkContext.defaultParallelism
    # one row group is one task; what is done with a line costs far more than to move it
    few = orders.rdd.getNumPartitions() < tasks
    orders = orders.withColumn("hotel", _hotel())
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    lines = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .select(k.alias("id"), line.alias("line"))
    )
    return lines.repartition(tasks) if few else lines


def bar_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as CSV lines of the bars file."""
    names = ["trade_date", "open_price", "high_price", "low_price", "close_price", "volume", "symbol"]
    return bars(spark, sf_dir).select(F.concat_ws(",", *[F.col(n).cast("string") for n in names]).alias("line"))
