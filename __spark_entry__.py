"""Registered queries, each with the DuckDB SQL that gives the same rows.

Library functions return decimals, dates and timestamps. At this edge they are
turned into doubles and text, so that both engines print equal values.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import all_sql
from tablewarden.functions.cards import card_number, card_token, matches, raised, token_cost
from tablewarden.operators import audit, constraints, derived, normalise, pairs, policy, profile, serials
from tablewarden.operators.bar_states import StateStore
from tablewarden.operators.keyed import KeyedTable, Reference
from tablewarden.operators.session_role import SessionRole
from tablewarden.plans import bars as B
from tablewarden.plans import hotel, logs
from tablewarden.schemas import BARS, BOOKING_COLUMNS, GRANTS, POLICIES, RESERVATIONS, Grant, Policy
from tablewarden.session import scratch_dir
from tablewarden.sources import bars_csv, bookings, clustered, layout, loads, querylog
from tablewarden.sources import testtables as src

from tablewarden.streaming import bars_stream, means_stream
from tablewarden.streaming.price_stream import CHANGE_SCHEMA, PriceStore, guard_stream

try:  # the text operators are a part that may be left out
    from tablewarden.llm import queries as text_queries
except ImportError as error:
    if not (error.name or "").startswith(("tablewarden.llm", "corpus_pipeline")) and "tablewarden.llm" not in str(error):
        raise
    text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

SYMBOL = "Brand#13"
SYMBOLS = ["Brand#1", "Brand#7", "Brand#13", "Brand#19", "Brand#25"]
DAY = date(1999, 1, 4)
SINCE, UNTIL = date(1997, 1, 1), date(1998, 12, 31)
YEAR_2000 = (date(2000, 1, 1), date(2000, 12, 31))
BAR_COLUMNS = ["symbol", "trade_date", "open_price", "high_price", "low_price", "close_price", "volume"]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and timestamps as text."""

    def one(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(field.name)

    return df.select(*[one(f) for f in df.schema.fields])


def _on_bars(plan: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: plain(plan(src.bars(spark, sf_dir), *args, **kwargs))


def _by_year(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "bars-by-year")
    layout.write_by_year(src.bars(spark, sf_dir), path)
    return path


def _streamed_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving means of bars that arrive in four parts; the second brings days that lie between those of the first."""
    folder = scratch_dir(spark, "means-stream")
    bars = src.bars(spark, sf_dir).select("symbol", "trade_date", "close_price")
    year, seventh = F.year("trade_date"), F.dayofmonth("trade_date") == 7
    parts = [(year <= 1995) & ~seventh, (year <= 1995) & seventh, year.between(1996, 1997), year > 1997]
    store = means_stream.MeansStore(spark, f"{folder}/store")
    for part in parts:
        bars.where(part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(means_stream.ROW).parquet(f"{folder}/in")
        means_stream.start(stream, store, f"{folder}/check").awaitTermination()
    return plain(store.means())


def _bars_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(layout.read_by_year(spark, _by_year(spark, sf_dir)))


def _replaced_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registered table of which one year is written again with fewer rows; the other years stay."""
    path = _by_year(spark, sf_dir)
    again = src.bars(spark, sf_dir).where((F.year("trade_date") == 1996) & (F.col("volume") > 50))
    layout.write_by_year(again, path, years=(1996, 1996))
    name = f"bars_{uuid.uuid4().hex}"
    layout.register(spark, name, path)
    text = f"SELECT {layout.YEAR}, symbol, count(*) AS satir_sayisi, sum(volume) AS hacim FROM {name} GROUP BY ALL"
    return spark.sql(text)


def _load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the time they were loaded at, and the user who did."""
    at = datetime(2024, 1, 31, 12, 30, 15, 250000)
    bars = derived.with_load_time(src.bars(spark, sf_dir).select("symbol", "trade_date"), at=F.lit(at))
    return plain(bars.withColumn("username", F.lit("stocks_etl")))


def _partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.partition_inventory(spark, _by_year(spark, sf_dir)).select(layout.YEAR, "satir_sayisi")


def _top_avg_close_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = layout.read_by_year(spark, _by_year(spark, sf_dir))
    return plain(B.top_avg_close(table.where(layout.between_dates(*YEAR_2000)), *YEAR_2000))


def _moving_averages_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(B.moving_averages_all(src.bars(spark, sf_dir)))


def _layout_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count timed on a plain and on a year-partitioned table."""
    span = date(1997, 1, 1), date(1997, 12, 31)
    plain_path, log_path = scratch_dir(spark, "bars-plain"), scratch_dir(spark, "query-log")
    src.bars(spark, sf_dir).write.parquet(plain_path)
    tables = {
        "plain": spark.read.parquet(plain_path).where(F.col("trade_date").between(*span)),
        "by year": layout.read_by_year(spark, _by_year(spark, sf_dir)).where(layout.between_dates(*span)),
    }
    for notes, table in tables.items():
        querylog.timed_run(
            table.where(F.col("symbol") == SYMBOL), log_path, user="bench", text="count of one symbol and year", notes=notes
        )
    return logs.latest_log(querylog.read_log(spark, log_path)).select("test_tipi", "satir_sayisi")


def _from_states(report: Callable[..., DataFrame], *args) -> Query:
    """A report from stored states after three loads; the last one corrects days of the first two."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = src.bars(spark, sf_dir).drop("daily_change", "daily_range")
        month = F.month("trade_date")
        corrected = bars.where(F.dayofmonth("trade_date") == 15)
        for price in ("open_price", "high_price", "low_price", "close_price"):
            corrected = corrected.withColumn(price, (F.col(price) / 2).cast("decimal(12,4)"))
        store = StateStore(spark, scratch_dir(spark, "bar-states"))
        for load, some in enumerate([bars.where(month <= 6), bars.where(month > 6), corrected.where("symbol not like '%3'")]):
            store.apply(some, load)
        return plain(report(store.states(), *args))

    return query


def _explain_analyze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a yearly report on the year layout really read: rows and folders of scan, filter and aggregate."""
    table = layout.read_by_year(spark, _by_year(spark, sf_dir))
    # a comparison of two columns is no filter of the reader, so the scan counts all rows of its folders
    picked = table.where(layout.between_dates(date(1996, 1, 1), date(1997, 12, 31))).where("daily_change > daily_range / 2")
    steps = profile.profile(picked.groupBy("symbol").agg(F.count("*").alias("n")))
    # of the two steps of the aggregate the last is the root
    shown = F.col("operator").isin("Scan", "Filter") | (F.col("id") == 0)
    only_files = F.col("files_read") >= F.col("folders_read")
    return steps.where(shown).select("operator", "rows_out", "folders_read", only_files.alias("has_files"))


def _clustered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars clustered by symbol and day: rows of filters on either column, and whether they spared files."""
    path = scratch_dir(spark, "bars-clustered")
    clustered.write(src.bars(spark, sf_dir), path, ["symbol", "trade_date"], files=64)
    symbol, days = {"symbol": (SYMBOL, SYMBOL)}, {"trade_date": (date(1997, 3, 1), date(1997, 6, 30))}
    out = []
    for name, ranges in (("symbol", symbol), ("days", days), ("both", {**symbol, **days}), ("all", {})):
        steps = profile.profile(clustered.read(spark, path, ranges).select("close_price"))
        # at most half of the files for one column, a quarter for both
        scan = steps.where(F.col("operator") == "Scan").select(
            F.lit(name).alias("filtre"), (F.col("files_read") * F.lit({"both": 4, "all": 1}.get(name, 2)) <= 64).alias("few_files")
        )
        rows = steps.agg(F.min_by("rows_out", F.when(F.col("rows_out").isNotNull(), F.col("id"))).alias("satir_sayisi"))
        out.append(scan.join(rows))
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


def _timed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports run whole under a clock, and what the log says of their rows."""
    bars, log_path = src.bars(spark, sf_dir), scratch_dir(spark, "query-log")
    for notes, query in (("sorted", bars.orderBy("symbol", "trade_date")), ("yearly", B.yearly_stats(bars, SYMBOLS))):
        querylog.timed_run(query, log_path, user="bench", text=notes, notes=notes)
    log = querylog.read_log(spark, log_path)
    return log.select(F.col("notes").alias("test_tipi"), F.col("rows_returned").alias("satir_sayisi"), (F.col("duration_ms") > 0).alias("timed"))


def _bar_queries() -> dict[str, Query]:
    return {
        "bar_derived": _on_bars(lambda b: b.select("symbol", "trade_date", "daily_change", "daily_range")),
        "bars_range_scan": _on_bars(B.range_scan, SYMBOL, SINCE, UNTIL, BAR_COLUMNS),
        "bars_range_scan_narrow": _on_bars(B.range_scan, SYMBOL, SINCE, UNTIL, ["symbol", "trade_date", "close_price"]),
        "peak_all_time": _on_bars(B.peak_all_time, DAY),
        "peak_correlated": _on_bars(B.peak_correlated, DAY),
        "peak_same_day": _on_bars(B.peak_same_day, DAY),
        "yearly_stats": _on_bars(B.yearly_stats, SYMBOLS),
        "top_movers_daily": _on_bars(B.top_movers_daily, YEAR_2000[0], 50),
        "top_movers_daily_all": _on_bars(B.top_movers_daily, date(1900, 1, 1), 50, rows=None),
        "moving_averages": _on_bars(B.moving_averages, SYMBOL),
        "moving_averages_all": _moving_averages_all,
        "top_avg_close": _on_bars(B.top_avg_close, *YEAR_2000),
        "top_avg_close_pruned": _top_avg_close_pruned,
        "year_share": _on_bars(B.year_share),
        "year_share_subquery": _on_bars(B.year_share_subquery),
        "top_volume": _on_bars(B.top_volume),
        "avg_yearly_return": _on_bars(B.avg_yearly_return),
        "avg_yearly_return_equal": _on_bars(B.avg_yearly_return, equal_years=True),
        "load_summary": _on_bars(B.load_summary),
        "bars_by_year": _bars_by_year,
        "partition_inventory": _partition_inventory,
        "replaced_year": _replaced_year,
        "load_times": _load_times,
        "layout_comparison": _layout_comparison,
        "yearly_stats_from_states": _from_states(B.yearly_stats_of_states, SYMBOLS),
        "avg_yearly_return_from_states": _from_states(lambda s: B.mean_returns(B.yearly_returns_of_states(s))),
        "load_summary_from_states": _from_states(B.load_summary_of_states),
        "explain_analyze": _explain_analyze,
        "timed_queries": _timed_queries,
        "clustered_reads": _clustered_reads,
        "stream_means": _streamed_means,
    }


# A role that is neither blocked nor logged, so that every decision occurs.
MANAGER_POLICIES = (*POLICIES, Policy("manager_full_access", RESERVATIONS, "manager", "true"))
MANAGER_GRANTS = (*GRANTS, Grant("manager", RESERVATIONS, "UPDATE"))
TEST_PEPPER = "test-pepper"


def _test_card(key: str):
    """Draw and salt that follow from the key, so that tokens repeat."""
    return F.col(key) * 7919000003, F.md5(F.col(key).cast("string"))


def _with_tokens(guests: DataFrame, key: str) -> DataFrame:
    draw, salt = _test_card(key)
    return guests.withColumn("kredi_karti", card_token(card_number(draw), TEST_PEPPER, salt))


def _raised_tokens(s: SparkSession, d: str) -> DataFrame:
    """Tokens of every guest's card made at one cost and raised to another, and what still matches."""
    draw, salt = _test_card("musteri_id")
    guests = src.guests(s, d).select("musteri_id", card_number(draw).alias("pan"), salt.alias("salt"))
    # every third token is an old one without a cost
    old = F.when(F.col("musteri_id") % 3 == 0, card_token(F.col("pan"), TEST_PEPPER, salt)).otherwise(
        card_token(F.col("pan"), TEST_PEPPER, salt, cost=2)
    )
    held = guests.withColumn("eski", old).withColumn("yeni", raised(F.col("eski"), F.col("pan"), TEST_PEPPER, 4, F.col("salt")))
    both = F.struct(*[matches(F.col(c), F.col("pan"), TEST_PEPPER).alias(c) for c in ("eski", "yeni")])
    return held.withColumn("m", both).select(
        "musteri_id", "eski", "yeni", token_cost(F.col("eski")).alias("eski_bedel"), (F.col("m.eski") & F.col("m.yeni")).alias("uyuyor")
    )


def _on_reservations(plan: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, sf_dir: plain(plan(src.reservations(spark, sf_dir), *args, **kwargs))


def _lookup(country: str) -> Query:
    return lambda s, d: plain(hotel.lookup_by_country(src.reservations(s, d), src.guests(s, d), country))


def _decisions(s: SparkSession, d: str, require_grant: bool) -> DataFrame:
    guard = audit.PriceGuard(MANAGER_POLICIES, MANAGER_GRANTS, require_grant)
    return guard.decide(src.changes(s, d), src.reservations(s, d).select("rezervasyon_id", "hotel", "adr"))


def _streamed_changes(s: SparkSession, d: str) -> PriceStore:
    """All price changes through the stream, a part of them with each start of it."""
    changes = src.changes(s, d)
    folder = scratch_dir(s, "price-stream")
    store = PriceStore(s, f"{folder}/store")
    store.start(src.reservations(s, d).select("rezervasyon_id", "hotel", "adr"))
    last = changes.agg(F.max("seq")).first()[0] or 0
    guard, parts = audit.PriceGuard(MANAGER_POLICIES, MANAGER_GRANTS), 3
    for part in range(parts):
        some = changes.where((F.col("seq") > last * part // parts) if part else F.lit(True)).where(F.col("seq") <= last * (part + 1) // parts)
        some.write.mode("append").parquet(f"{folder}/in")
        stream = s.readStream.schema(CHANGE_SCHEMA).parquet(f"{folder}/in")
        # stops when all files are read; the second start finds the state of the first
        guard_stream(stream, store, guard, f"{folder}/check", compact_every=2).awaitTermination()
    return store


def _streamed_bars(s: SparkSession, d: str) -> DataFrame:
    """All bars as files that arrive in a directory in two parts; days without a partition are refused."""
    folder = scratch_dir(s, "bar-stream")
    lines = src.bar_lines(s, d)
    for part in range(2):
        some = lines.where(F.month(F.substring("line", 1, 10).cast("date")) % 2 == part)
        name = F.col("line").alias(",".join(BARS.fieldNames()))
        some.select(name).write.mode("append").options(header=True, sep="\u0001", quote="\u0000", escapeQuotes=False).csv(f"{folder}/in")
        rows = bars_stream.read_stream(s, f"{folder}/in", (1993, 1997))
        for query in bars_stream.start(rows, f"{folder}/bars", f"{folder}/rejects", f"{folder}/check"):
            query.awaitTermination()
    good = bars_stream.streamed_bars(s, f"{folder}/bars").select(*BAR_COLUMNS, "daily_change", F.lit(None).cast("string").alias("reason"))
    bad = s.read.parquet(f"{folder}/rejects")
    day, symbol = (F.split("raw", ",")[i] for i in (0, 6))
    none = [F.lit(None).cast(good.schema[c].dataType).alias(c) for c in (*BAR_COLUMNS[2:], "daily_change")]
    return plain(good.unionByName(bad.select(symbol.alias("symbol"), day.cast("date").alias("trade_date"), *none, "reason")))


def _price_after(s: SparkSession, d: str) -> DataFrame:
    guard = audit.PriceGuard(MANAGER_POLICIES, MANAGER_GRANTS)
    return guard.prices_after(src.changes(s, d), src.reservations(s, d).select("rezervasyon_id", "hotel", "adr"))


def _grant_matrix(s: SparkSession, d: str) -> DataFrame:
    groups = src.table(s, d, "customer").select(
        F.concat(F.lit("user_"), F.col("c_custkey")).alias("rol"), F.col("c_mktsegment").alias("grup")
    )
    rights = src.used_rights(s, d)
    return policy.grant_matrix(rights, ["stock_prices", "query_audit_log"], groups, exclude=["user_1", "user_2"])


def _grant_check(s: SparkSession, d: str) -> DataFrame:
    """Rights asked for by users; some ask for another right than they have."""
    rights = src.used_rights(s, d)
    other = F.col("grantee").rlike("[07]$") & (F.col("privilege_type") == "SELECT")
    asked = rights.withColumn("privilege_type", F.when(other, "TRUNCATE").otherwise(F.col("privilege_type")))
    return policy.missing_rights(asked, rights.distinct())


def _policy_list(s: SparkSession, d: str) -> DataFrame:
    """The real policies beside one for each hotel found."""
    found = policy.tenant_policies(src.reservations(s, d))
    return policy.policy_list(found.unionByName(policy.policy_table(s, MANAGER_POLICIES)))


def _session_roles(s: SparkSession, d: str) -> DataFrame:
    """One SQL text in one session: before any role, under three roles, and after RESET."""
    session = SessionRole(s, MANAGER_POLICIES, MANAGER_GRANTS + (Grant("manager", RESERVATIONS, "SELECT"),))
    session.protect(src.reservations(s, d), RESERVATIONS)
    seen = []
    for rol in (None, "city_reception", "resort_reception", "manager", None):
        session.reset_role() if rol is None else session.set_role(rol)
        step = s.sql(f"SELECT hotel, count(*) AS gordugun_kayit_sayisi, count(DISTINCT musteri_id) AS misafir FROM {RESERVATIONS} GROUP BY hotel")
        seen.append(step.select(F.lit(len(seen)).alias("adim"), F.lit(rol or "-").alias("rol"), "*"))
    return seen[0].unionAll(seen[1]).unionAll(seen[2]).unionAll(seen[3]).unionAll(seen[4])


def _hotel_queries() -> dict[str, Query]:
    rows_for = lambda role: _on_reservations(policy.visible, role)
    roles = ["admin", "city_reception", "resort_reception", "visitor"]
    return {
        "rows_for_city_reception": rows_for("city_reception"),
        "rows_for_resort_reception": rows_for("resort_reception"),
        "rows_for_admin": rows_for("admin"),
        "rows_for_unknown_role": rows_for("visitor"),
        "guests_for_city_reception": lambda s, d: policy.visible_guests(
            src.guests(s, d), src.reservations(s, d), "city_reception"
        ),
        "isolation_report": _on_reservations(policy.isolation_report, roles, MANAGER_POLICIES),
        "session_roles": _session_roles,
        "policy_list": _policy_list,
        "grant_matrix": _grant_matrix,
        "grant_check": _grant_check,
        "price_audit": lambda s, d: plain(audit.audit_log(_decisions(s, d, False))),
        "price_audit_granted": lambda s, d: plain(audit.audit_log(_decisions(s, d, True))),
        "price_decisions": lambda s, d: plain(_decisions(s, d, False)),
        "price_decisions_granted": lambda s, d: plain(_decisions(s, d, True)),
        "price_after": lambda s, d: plain(_price_after(s, d)),
        "stream_price_audit": lambda s, d: plain(_streamed_changes(s, d).audit().drop("batch")),
        "stream_price_after": lambda s, d: plain(_streamed_changes(s, d).prices()),
        "stream_bars": _streamed_bars,
        "audit_report": lambda s, d: plain(audit.audit_report(audit.audit_log(_decisions(s, d, False)))),
        "tenant_overview": _on_reservations(hotel.tenant_overview),
        "tenant_counts": _on_reservations(hotel.tenant_counts),
        "tenant_counts_for_city_reception": _on_reservations(
            lambda r: hotel.tenant_counts(policy.guarded_read(r, "city_reception"))
        ),
        "lookup_by_country": _lookup("NATION_7"),
        "lookup_attack": _lookup("' OR '1'='1' --"),
        "origin_overview": lambda s, d: hotel.origin_overview(
            src.reservations(s, d), src.guests(s, d), src.table(s, d, "nation"), src.table(s, d, "region")
        ),
        "card_tokens": lambda s, d: _with_tokens(src.guests(s, d), "musteri_id").select("musteri_id", "kredi_karti"),
        "raised_tokens": _raised_tokens,
        "masked_cards": lambda s, d: hotel.masked_cards(_with_tokens(src.guests(s, d), "musteri_id")),
    }


def _typed(s: SparkSession, d: str) -> DataFrame:
    return bookings.typed(bookings.strings_from_lines(src.booking_lines(s, d)))


def _good(s: SparkSession, d: str) -> DataFrame:
    return _typed(s, d).where(F.col("reason").isNull()).drop("reason")


def _rejected(s: SparkSession, d: str) -> DataFrame:
    return _typed(s, d).where(F.col("reason").isNotNull())


def _normalise_guests(s: SparkSession, d: str) -> DataFrame:
    return plain(normalise.guests(_good(s, d), TEST_PEPPER, *_test_card("id")))


def _on_unchecked(check: Callable[..., DataFrame], *args) -> Query:
    return lambda s, d: plain(check(src.unchecked_bars(s, d), *args))


def _check_fk(s: SparkSession, d: str) -> DataFrame:
    # some bars name a part that no table has
    shifted = F.when(F.col("id") % 37 == 0, F.col("part_id") + 10**12).otherwise(F.col("part_id"))
    bars = src.unchecked_bars(s, d).withColumn("part_id", shifted)
    return constraints.foreign_key(bars, "part_id", src.table(s, d, "part"), "p_partkey")


def _keyed_bars(s: SparkSession, d: str) -> KeyedTable:
    """Line items in three batches, written into a table that keeps its key, its reference and its rules."""
    tag = uuid.uuid4().hex
    parts = src.table(s, d, "part").select(F.col("p_partkey").alias("part_id"))
    parents = KeyedTable(s, scratch_dir(s, "parts"), f"parts_{tag}", parts.schema, ["part_id"])
    # the parts that no table has are those that end in 3
    parents.append(parts.where("part_id % 10 <> 3"), 0)
    rows = src.unchecked_bars(s, d).select("id", "part_id", "trade_date", "open_price", "amount")
    rules = {"open_price: missing": F.col("open_price").isNull(), "trade_date: no partition": constraints.outside_years(F.col("trade_date"), 1993, 1997)}
    root = scratch_dir(s, "keyed-bars")
    reference = [Reference(("part_id",), parents)]
    table = KeyedTable(s, root, f"bars_{tag}", rows.schema, ["part_id", "trade_date"], reference, rules)
    for batch in range(3):
        table.append(rows.where(F.col("id") % 3 == batch), batch, order=["id", "amount"])
    return table


def _keyed_accepted(s: SparkSession, d: str) -> DataFrame:
    return plain(_keyed_bars(s, d).accepted().select("id", "part_id", "trade_date", "amount", "batch"))


def _keyed_refused(s: SparkSession, d: str) -> DataFrame:
    refused = _keyed_bars(s, d).refused()
    # the parent's name is another one in each run
    reasons = F.regexp_replace(F.array_join("reasons", "; "), r"parts_[0-9a-f]+", "parts")
    return refused.groupBy("batch", reasons.alias("reasons")).agg(F.count("*").alias("satir_sayisi"))


def _row_faults(df: DataFrame) -> DataFrame:
    rules = {
        "open_price is null": F.col("open_price").isNull(),
        "symbol too long": F.length("symbol") > 10,
        "no partition": constraints.outside_years(F.col("trade_date"), 1996, 2000),
    }
    marked = constraints.with_faults(df, rules)
    return marked.groupBy(F.array_join("faults", ",").alias("faults")).agg(F.count("*").alias("satir_sayisi"))


def _as_files(lines: DataFrame, header: list[str], name: str) -> str:
    """The lines as CSV files with a header, as they stand."""
    path = scratch_dir(lines.sparkSession, name)
    lines.select(F.col("line").alias(",".join(header))).write.options(
        header=True, sep="\u0001", quote="\u0000", escapeQuotes=False
    ).csv(path)
    return path


def _booking_files(s: SparkSession, d: str) -> str:
    return _as_files(src.booking_lines(s, d), list(BOOKING_COLUMNS), "booking-files")


def _ingest_booking_files(s: SparkSession, d: str) -> DataFrame:
    typed = bookings.typed(bookings.read_strings(s, _booking_files(s, d)))
    return plain(typed.where(F.col("reason").isNull()).drop("reason"))


def _ingest_bar_files(s: SparkSession, d: str) -> DataFrame:
    return plain(bars_csv.read_bars(s, _as_files(src.bar_lines(s, d), BARS.fieldNames(), "bar-files")))


def _appended_loads(s: SparkSession, d: str) -> DataFrame:
    """Two loads of the same files: rows, ids, and reservations that meet their guest."""
    files, out = _booking_files(s, d), scratch_dir(s, "bookings")
    for _ in range(2):
        bookings.load(s, files, out, mode="append")
    loaded = bookings.good(s.read.parquet(out))
    guests = normalise.guests(loaded, TEST_PEPPER, *_test_card("id")).select("musteri_id")
    met = normalise.reservations(loaded).select("musteri_id").join(guests, "musteri_id")
    # one pass over the stored ids, one over the reservations with their guests
    parts = [
        loaded.select(F.lit("kayit").alias("ad"), F.lit(1).alias("n")),
        loaded.select("id").distinct().select(F.lit("numara"), F.lit(1)),
        met.select(F.lit("eslesme"), F.lit(1)),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).groupBy("ad").agg(F.sum("n").alias("sayi"))


def _load_outcomes(s: SparkSession, d: str) -> DataFrame:
    """What a load of the booking files counted while it wrote them."""
    counts = bookings.load(s, _booking_files(s, d), scratch_dir(s, "bookings"))
    return s.createDataFrame(list(counts.items()), "sonuc string, satir_sayisi long")


def _serial_ids(s: SparkSession, d: str) -> DataFrame:
    """Every line item as a row of a table that numbers its rows in order, without gaps."""
    order = ["trade_date", "id", "part_id", "amount"]
    return plain(serials.with_serial(src.unchecked_bars(s, d).select(*order), order, "serial", start=1))


def _repeated_loads(s: SparkSession, d: str) -> DataFrame:
    """Three loads of booking files: one loaded twice, one broken off and loaded again."""
    store = loads.LoadStore(s, scratch_dir(s, "load-store"))
    lines = src.booking_lines(s, d)
    for number, load in enumerate(["first", "twice", "broken"]):
        files = _as_files(lines.where(F.col("id") % 3 == number).orderBy("id"), list(BOOKING_COLUMNS), f"load-{load}")
        if load == "broken":
            # the attempt wrote a part of its rows and was never published
            rows = bookings.typed(bookings.read_strings(s, files, in_order=True))
            store.write(load, rows.where("lead_time < 200"))
        for _ in range(2 if load == "twice" else 1):
            loads.load_bookings(store, load, files)
    return plain(store.read().select("id", "load", "reason", "hotel", "lead_time", "adr", "agent"))


def _ingest_queries() -> dict[str, Query]:
    return {
        "ingest_bookings": lambda s, d: plain(_good(s, d)),
        "ingest_rejects": lambda s, d: bookings.reject_counts(_rejected(s, d)),
        "first_rejects": lambda s, d: bookings.first_rejects(_rejected(s, d)),
        "null_sentinels": lambda s, d: plain(_good(s, d).select("id", "children", "agent", "company", "country", "meal")),
        "ingest_booking_files": _ingest_booking_files,
        "ingest_bar_files": _ingest_bar_files,
        "appended_loads": _appended_loads,
        "load_outcomes": _load_outcomes,
        "serial_ids": _serial_ids,
        "repeated_loads": _repeated_loads,
        "ingest_bars": lambda s, d: plain(bars_csv.bars_from_lines(src.bar_lines(s, d))),
        "normalise_guests": _normalise_guests,
        "normalise_reservations": lambda s, d: plain(normalise.reservations(_good(s, d))),
        "check_not_null": _on_unchecked(constraints.not_null, ["open_price", "close_price", "symbol"]),
        "check_unique": _on_unchecked(constraints.unique, ["id"]),
        "check_unique_composite": _on_unchecked(constraints.unique, ["id", "trade_date"]),
        "check_fk": _check_fk,
        "check_length": _on_unchecked(constraints.lengths, {"symbol": 10}),
        "check_numeric": _on_unchecked(constraints.numerics, "amount", 10, 2),
        "check_partition_range": _on_unchecked(constraints.partition_range, "trade_date", 1996, 2000),
        "row_faults": _on_unchecked(_row_faults),
        "keyed_accepted": _keyed_accepted,
        "keyed_refused": _keyed_refused,
    }


def _on_log(plan: Callable[..., DataFrame], *args) -> Query:
    return lambda s, d: plain(plan(src.query_log(s, d), *args))


def _usage_bands(s: SparkSession, d: str) -> DataFrame:
    uses = src.table(s, d, "events").select(F.col("user_id").alias("c_custkey"))
    return logs.usage_bands(src.table(s, d, "customer"), "c_custkey", uses)


def _log_queries() -> dict[str, Query]:
    return {
        "slow_statements": _on_log(logs.slow_statements, "%WHERE%7%"),
        "rows_per_call": _on_log(logs.rows_per_call),
        "latest_log": _on_log(logs.latest_log),
        "statement_ages": _on_log(logs.statement_ages, datetime(2024, 2, 1), "signup", "%VIEW%"),
        "usage_bands": _usage_bands,
        "pairs_in_group": lambda s, d: pairs.pairs_in_group(src.table(s, d, "supplier"), "s_nationkey", "s_suppkey"),
        "later_partners": lambda s, d: pairs.later_partners(src.table(s, d, "customer"), "c_nationkey", "c_custkey"),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Mean yearly return per symbol on the smallest tables, or on those that ``ENTRY_SF_DIR`` names."""
    return queries()["avg_yearly_return"](spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    own = {**_bar_queries(), **_hotel_queries(), **_ingest_queries(), **_log_queries()}
    return {**own, **(text_queries.queries() if text_queries else {})}


def oracle_sql() -> dict[str, str]:
    keys = queries()
    texts = text_queries.oracle_sql() if text_queries else {}
    return {k: v for k, v in {**all_sql(), **texts}.items() if k in keys}
