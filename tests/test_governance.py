import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablewarden.functions.cards import card_number, card_token, masked, matches, raised, token_cost
from tablewarden.operators import constraints as C
from tablewarden.operators import policy as P
from tablewarden.plans import hotel as H
from tablewarden.schemas import GRANTS, GUESTS, LOG, POLICIES, RESERVATIONS, Policy

ROLES = ["admin", "city_reception", "resort_reception", "nobody"]


@pytest.fixture(scope="module")
def stays(spark):
    rows = [
        (1, 10, "City Hotel", 1, Decimal("100.00"), "Canceled"),
        (2, 11, "City Hotel", 0, Decimal("100.01"), "Check-Out"),
        (3, 12, "Resort Hotel", 0, Decimal("50.00"), "Check-Out"),
        (4, 12, None, 1, None, "No-Show"),
    ]
    names = "rezervasyon_id long, musteri_id long, hotel string, is_canceled int, adr decimal(10,2), reservation_status string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="module")
def guests(spark):
    return spark.createDataFrame([(10, "PRT"), (11, "GBR"), (12, "PRT"), (13, "PRT")], "musteri_id long, ulke string")


def test_each_role_sees_its_hotel(stays):
    seen = {r: {x.rezervasyon_id for x in P.visible(stays, r).collect()} for r in ROLES}
    assert seen == {"admin": {1, 2, 3, 4}, "city_reception": {1, 2}, "resort_reception": {3}, "nobody": set()}


def test_isolation_report(stays):
    got = {(r.rol, r.hotel): r.gordugun_kayit_sayisi for r in P.isolation_report(stays, ROLES).collect()}
    assert got == {
        ("admin", "City Hotel"): 2,
        ("admin", "Resort Hotel"): 1,
        ("admin", None): 1,
        ("city_reception", "City Hotel"): 2,
        ("resort_reception", "Resort Hotel"): 1,
    }


def test_two_policies_of_a_role_are_joined_by_or(stays):
    both = (*POLICIES, Policy("second", RESERVATIONS, "city_reception", "hotel = 'Resort Hotel'"))
    assert P.visible(stays, "city_reception", both).count() == 3


def test_guests_follow_the_grant_unless_restricted(stays, guests):
    assert P.guarded_read(guests, "city_reception", GUESTS).count() == 4
    assert {r.musteri_id for r in P.visible_guests(guests, stays, "city_reception").collect()} == {10, 11}
    with pytest.raises(PermissionError):
        P.guarded_read(stays, "city_reception", LOG)
    with pytest.raises(PermissionError):
        P.guarded_read(stays, "nobody")


def test_guarded_append(spark, stays, tmp_path):
    path = str(tmp_path / "out")
    P.guarded_append(stays, path, "admin")
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(PermissionError):
        P.guarded_append(stays, path, "city_reception")
    more = (*GRANTS, P.Grant("city_reception", RESERVATIONS, "INSERT"))
    with pytest.raises(Exception, match="violates row policy"):
        P.guarded_append(stays, path, "city_reception", grants=more)
    P.guarded_append(stays.where("hotel = 'City Hotel'"), path, "city_reception", grants=more)
    assert spark.read.parquet(path).count() == 6


def test_policy_listing(spark, stays):
    rows = P.policy_list(P.policy_table(spark)).collect()
    assert [r.politika_adi for r in rows] == ["admin_full_access", "city_hotel_policy", "resort_hotel_policy"]
    derived = P.policy_list(P.tenant_policies(stays)).collect()
    assert [(r.roller, r.kosul) for r in derived] == [
        ("city_hotel_reception", "hotel = 'City Hotel'"),
        ("resort_hotel_reception", "hotel = 'Resort Hotel'"),
    ]


def test_derived_policy_quotes_its_tenant(spark):
    names = ["O'Hara Inn", "Other", "Back\\", "' OR '1'='1", "\\' OR 1=1 --"]
    odd = spark.createDataFrame([(n,) for n in names], "hotel string")
    for p in P.tenant_policies(odd).collect():
        assert odd.where(p.kosul).count() == 1


def test_grant_matrix(spark):
    got = {(r.rol, r.tablo): r.yetkiler for r in P.grant_matrix(P.grant_table(spark), ["stock_prices", "query_audit_log"]).collect()}
    assert got[("stocks_etl", "stock_prices")] == "INSERT, SELECT"
    assert got[("stocks_admin", "stock_prices")] == "DELETE, INSERT, REFERENCES, SELECT, TRIGGER, TRUNCATE, UPDATE"
    assert ("stocks_readonly", "query_audit_log") not in got and len(got) == 6
    listed = P.grant_matrix(P.grant_table(spark), ["stock_prices"], exclude=["stocks_admin", "stocks_etl"]).collect()
    assert [r.rol for r in listed] == ["stocks_analyst", "stocks_readonly"]


def test_missing_rights(spark):
    need = spark.createDataFrame(
        [("admin", RESERVATIONS, "UPDATE"), ("city_reception", RESERVATIONS, "UPDATE")],
        "grantee string, table_name string, privilege_type string",
    )
    assert [r.grantee for r in P.missing_rights(need.union(need), P.grant_table(spark)).collect()] == ["city_reception"]
    assert len(GRANTS) == len(set(GRANTS))


def test_overview(stays):
    rows = [tuple(r) for r in H.tenant_overview(stays).collect()]
    # 200.01 / 2 = 100.005, half away from zero
    assert rows == [
        ("City Hotel", 2, Decimal("100.01"), 1),
        ("Resort Hotel", 1, Decimal("50.00"), 0),
        (None, 1, None, 1),
    ]


def test_lookup_binds_its_value(stays, guests):
    seen = P.visible(stays, "city_reception")
    assert [r.rezervasyon_id for r in H.lookup_by_country(seen, guests, "PRT").collect()] == [1]
    assert H.lookup_by_country(seen, guests, "' OR '1'='1' --").count() == 0
    assert [r.rezervasyon_id for r in H.lookup_by_country(stays, guests, "PRT", rows=2).collect()] == [1, 3]


def test_card_numbers_and_tokens(spark):
    df = spark.range(500).withColumn("pan", card_number())
    assert df.where(~F.col("pan").rlike(r"^4\d{15}$")).count() == 0
    low = spark.range(1).select(card_number(F.lit(0)), card_number(F.lit(9 * 10**14 - 1))).first()
    assert tuple(low) == ("4100000000000000", "4999999999999999")
    many = spark.range(0, 2000, 1, 7).withColumn("pan", card_number()).withColumn("t", card_token(F.col("pan"), "p"))
    assert many.where(matches(F.col("t"), F.col("pan"), "p")).count() == 2000
    assert many.select("t").distinct().count() == 2000
    same = spark.range(2).select(card_token(F.lit("4000111122223333"), "p").alias("t")).collect()
    assert same[0].t != same[1].t
    row = spark.createDataFrame([(same[0].t,)], "t string").select(
        matches(F.col("t"), F.lit("4000111122223333"), "p"),
        matches(F.col("t"), F.lit("4000111122223334"), "p"),
        matches(F.col("t"), F.lit("4000111122223333"), "q"),
        masked(F.col("t")),
        masked(F.col("t"), 20),
    ).first()
    assert row[:3] == (True, False, False)
    assert row[3] == same[0].t[:29] + "..." and row[4] == same[0].t[:20] + "..."


def test_constraints(spark):
    rows = [
        (1, 10, date(2013, 1, 1), Decimal("1"), "AAPL", "12.345"),
        (1, 99, date(2018, 12, 31), None, "ABCDEFGHIJK", "abc"),
        (2, None, date(2012, 12, 31), Decimal("1"), None, "99999999999"),
        (3, 99, date(2019, 1, 1), None, "A", None),
        (None, 10, None, Decimal("1"), "A", "-0.005"),
        (None, 10, None, Decimal("1"), "A", "1"),
    ]
    df = spark.createDataFrame(rows, "id long, guest long, day date, price decimal(12,4), symbol string, amount string")
    as_rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert as_rows(C.not_null(df, ["price", "guest", "amount"])) == [("amount", 1), ("guest", 1), ("price", 2)]
    assert as_rows(C.unique(df, ["id"])) == [(1, 2)]
    assert as_rows(C.unique(df, ["id", "day"])) == []
    parents = spark.createDataFrame([(10,), (11,)], "musteri_id long")
    assert as_rows(C.foreign_key(df, "guest", parents, "musteri_id")) == [(99, 2)]
    assert as_rows(C.lengths(df, {"symbol": 10, "amount": 20})) == [("symbol", 1, 11)]
    assert as_rows(C.numerics(df, "amount", 10, 2)) == [("not a number", 1), ("out of range", 1)]
    assert as_rows(C.partition_range(df, "day", 2013, 2018)) == [(2012, 1), (2019, 1), (None, 2)]
    faults = C.with_faults(df, {"price": F.col("price").isNull(), "day": C.outside_years(F.col("day"), 2013, 2018)})
    assert [sorted(r.faults) for r in faults.collect()] == [[], ["price"], ["day"], ["day", "price"], ["day"], ["day"]]


def test_tokens_with_a_cost(spark):
    pan = F.col("pan")
    cards = spark.range(60).withColumn("pan", card_number(F.col("id") * 991))
    made = cards.withColumn("t", F.when(F.col("id") % 3 == 0, card_token(pan, "p")).when(F.col("id") % 3 == 1, card_token(pan, "p", cost=3)).otherwise(card_token(pan, "p", cost=9)))
    # random salts are drawn once
    held = spark.createDataFrame(made.collect(), made.schema)
    assert {(r.id % 3, r.c) for r in held.select("id", token_cost(F.col("t")).alias("c")).collect()} == {(0, 0), (1, 3), (2, 9)}
    up = held.withColumn("up", raised(F.col("t"), pan, "p", 5))
    up = spark.createDataFrame(up.collect(), up.schema)
    checks = up.select(
        "id",
        (F.col("t") != F.col("up")).alias("new"),
        token_cost(F.col("up")).alias("c"),
        *[matches(F.col(c), pan, "p").alias(f"ok_{c}") for c in ("t", "up")],
        matches(F.col("up"), F.lit("4000000000000000"), "p").alias("other"),
        matches(F.col("up"), pan, "q").alias("pepper"),
    )
    for r in checks.collect():
        assert r.ok_t and r.ok_up and not r.other and not r.pepper
        assert (r.new, r.c) == ((True, 5) if r.id % 3 < 2 else (False, 9))
    # the hash is what the standard library gives
    one = up.where("id = 1").first()
    salt, cost, digest = one.up.split("$")
    want = hashlib.sha256(f"p{salt}{one.pan}".encode()).hexdigest()
    for _ in range(int(cost)):
        want = hashlib.sha256(f"{want}p{salt}".encode()).hexdigest()
    assert digest == want and "BatchEvalPython" not in up._jdf.queryExecution().toString()
    odd = spark.createDataFrame([(None,), ("x",), ("a$b$c",), ("a$1$b$c",), ("",)], "t string")
    assert [r.m for r in odd.select(matches(F.col("t"), F.lit("4"), "p").alias("m")).collect()] == [None, False, False, False, False]
    # a token that the number does not match stays, whatever its cost
    kept = held.limit(3).select("t", raised(F.col("t"), F.lit("4999"), "p", 50).alias("u")).collect()
    assert all(r.t == r.u for r in kept)
