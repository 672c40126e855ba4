"""The same SQL text under several roles of one session."""

import pytest

from tablewarden.operators.session_role import SessionRole
from tablewarden.schemas import GRANTS, POLICIES, Grant, Policy

COUNTS = "SELECT hotel, count(*) AS n FROM rezervasyonlar GROUP BY hotel"


@pytest.fixture()
def role(spark, tmp_path):
    rows = [(i, ["City Hotel", "Resort Hotel", None][i % 3]) for i in range(30)]
    spark.createDataFrame(rows, "id long, hotel string").write.parquet(str(tmp_path / "r"))
    policies = [*POLICIES, Policy("odd", "rezervasyonlar", "o'neil \\ co", "id % 2 = 1"), Policy("own", "rezervasyonlar", "city_reception", "id = 1")]
    session = SessionRole(spark, policies, [*GRANTS, Grant("o'neil \\ co", "rezervasyonlar", "SELECT"), Grant("blind", "rezervasyonlar", "SELECT")])
    session.protect(spark.read.parquet(str(tmp_path / "r")), "rezervasyonlar")
    session.protect(spark.range(7), "musteriler")
    yield session
    session.reset_role()


def _seen(spark):
    return {r.hotel: r.n for r in spark.sql(COUNTS).collect()}


def test_roles_of_a_session(spark, role):
    assert role.current() is None and _seen(spark) == {}
    role.set_role("resort_reception")
    assert role.current() == "resort_reception" and _seen(spark) == {"Resort Hotel": 10}
    role.set_role("city_reception")  # two policies add up
    assert _seen(spark) == {"City Hotel": 10, "Resort Hotel": 1}
    role.set_role("admin")
    assert _seen(spark) == {"City Hotel": 10, "Resort Hotel": 10, None: 10}
    role.set_role("blind")  # may read, but has no policy
    assert _seen(spark) == {}
    role.set_role("o'neil \\ co")
    assert sum(_seen(spark).values()) == 15
    role.reset_role()
    assert _seen(spark) == {}
    role.set_role("nobody")
    with pytest.raises(Exception, match="nobody has no SELECT on rezervasyonlar"):
        spark.sql(COUNTS).collect()


def test_a_table_without_policies_is_open_to_readers(spark, role):
    with role.as_role("admin"):
        assert spark.sql("SELECT * FROM musteriler").count() == 7
        with role.as_role("stocks_etl"), pytest.raises(Exception, match="no SELECT"):
            spark.sql("SELECT * FROM musteriler").collect()
        assert role.current() == "admin"
    assert role.current() is None and spark.sql("SELECT * FROM musteriler").count() == 0


def test_joins_subqueries_and_frames_keep_their_role(spark, role):
    role.set_role("resort_reception")
    joined = spark.sql("SELECT count(*) FROM rezervasyonlar a JOIN rezervasyonlar b ON a.hotel = b.hotel WHERE a.id IN (SELECT id FROM rezervasyonlar)")
    made = spark.sql(COUNTS)
    role.set_role("admin")
    assert joined.first()[0] == 100 and made.collect() == [("Resort Hotel", 10)]
    assert spark.table("rezervasyonlar").count() == 30
    with pytest.raises(ValueError):
        role.protect(spark.range(1), "a; DROP")


def test_the_policy_reaches_the_scan(spark, role):
    role.set_role("resort_reception")
    plan = spark.sql("SELECT id FROM rezervasyonlar")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(hotel,Resort Hotel)" in plan and "CASE" not in plan
    role.reset_role()
    plan = spark.sql("SELECT id FROM rezervasyonlar")._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan
