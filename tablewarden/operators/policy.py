"""Row policies, grants and reports about both.

The role is an argument of a job. Policies are applied to base rows, before
any join or aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewarden.schemas import GRANTS, POLICIES, RESERVATIONS, Grant, Policy


def _predicate(role: str, policies: Iterable[Policy], table: str) -> Column:
    mine = [F.expr(p.predicate) for p in policies if p.role == role and p.table == table]
    return reduce(lambda a, b: a | b, mine, F.lit(False))


def row_guard(role: str, policies: Iterable[Policy] = POLICIES, table: str = RESERVATIONS) -> Column:
    """True for the rows a role may touch; false for a role with no policy."""
    return F.coalesce(_predicate(role, policies, table), F.lit(False))


def role_guard(role: Column, policies: Iterable[Policy] = POLICIES, table: str = RESERVATIONS) -> Column:
    """The same for a role that is a column of the row."""
    policies = [p for p in policies if p.table == table]
    out = F.lit(False)
    for name in sorted({p.role for p in policies}):
        out = F.when(role == name, row_guard(name, policies, table)).otherwise(out)
    return out


def visible(df: DataFrame, role: str, policies: Iterable[Policy] = POLICIES, table: str = RESERVATIONS) -> DataFrame:
    # a filter takes null for false, and a bare predicate can go to the reader
    return df.where(_predicate(role, policies, table))


def visible_guests(guests: DataFrame, reservations: DataFrame, role: str, policies: Iterable[Policy] = POLICIES) -> DataFrame:
    """Stricter option: only guests with a reservation the role can see."""
    seen = visible(reservations, role, policies).select("musteri_id").distinct()
    return guests.join(seen, "musteri_id", "left_semi")


def isolation_report(
    df: DataFrame, roles: Sequence[str], policies: Iterable[Policy] = POLICIES, tenant: str = "hotel"
) -> DataFrame:
    """Rows each role sees per tenant, for all roles in one pass."""
    policies = list(policies)
    seen = df.groupBy(tenant).agg(*[F.count_if(row_guard(r, policies)).alias(f"_{i}") for i, r in enumerate(roles)])
    pairs = F.array(*[F.struct(F.lit(r).alias("rol"), F.col(f"_{i}").alias("n")) for i, r in enumerate(roles)])
    return (
        seen.select(tenant, F.explode(pairs).alias("p"))
        .select("p.rol", tenant, F.col("p.n").alias("gordugun_kayit_sayisi"))
        .where(F.col("gordugun_kayit_sayisi") > 0)
    )


def policy_table(spark: SparkSession, policies: Iterable[Policy] = POLICIES) -> DataFrame:
    rows = [(p.name, p.table, p.role, p.command, p.predicate) for p in policies]
    return spark.createDataFrame(rows, "politika_adi string, tablo string, roller string, komut string, kosul string")


def tenant_policies(df: DataFrame, tenant: str = "hotel", table: str = RESERVATIONS) -> DataFrame:
    """One policy per tenant found in the data."""
    t = F.col(tenant)
    slug = F.regexp_replace(F.lower(t), "[^a-z0-9]+", "_")
    # the name becomes SQL text: double its quotes and backslashes
    quoted = F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))
    return df.select(t).where(t.isNotNull()).distinct().select(
        F.concat(slug, F.lit("_policy")).alias("politika_adi"),
        F.lit(table).alias("tablo"),
        F.concat(slug, F.lit("_reception")).alias("roller"),
        F.lit("ALL").alias("komut"),
        F.concat(F.lit(f"{tenant} = '"), quoted, F.lit("'")).alias("kosul"),
    )


def policy_list(policies: DataFrame, table: str = RESERVATIONS) -> DataFrame:
    """Policies of one table in name order."""
    return (
        policies.where(F.col("tablo") == table)
        .select("politika_adi", "roller", "komut", "kosul")
        .orderBy("politika_adi", "roller")
    )


def grant_table(spark: SparkSession, grants: Iterable[Grant] = GRANTS) -> DataFrame:
    rows = [(g.role, g.table, g.privilege) for g in grants]
    return spark.createDataFrame(rows, "grantee string, table_name string, privilege_type string")


def require(role: str, table: str, privilege: str, grants: Iterable[Grant] = GRANTS) -> None:
    """Raise unless the role holds the privilege."""
    if Grant(role, table, privilege) not in set(grants):
        raise PermissionError(f"{role} has no {privilege} on {table}")


def guarded_read(
    df: DataFrame,
    role: str,
    table: str = RESERVATIONS,
    grants: Iterable[Grant] = GRANTS,
    policies: Iterable[Policy] = POLICIES,
) -> DataFrame:
    """Grant check, then row policy."""
    require(role, table, "SELECT", grants)
    policies = [p for p in policies if p.table == table]
    # a table without policies is open to whoever holds the grant
    return visible(df, role, policies, table) if policies else df


def guarded_append(
    df: DataFrame,
    path: str,
    role: str,
    table: str = RESERVATIONS,
    grants: Iterable[Grant] = GRANTS,
    policies: Iterable[Policy] = POLICIES,
) -> None:
    """Append rows as a role: needs INSERT, and a row outside its policy stops the job."""
    require(role, table, "INSERT", grants)
    policies = [p for p in policies if p.table == table]
    if policies:
        refused = F.raise_error(F.lit(f"new row violates row policy of {table}")).cast("boolean")
        df = df.where(F.when(row_guard(role, policies, table), True).otherwise(refused))
    df.write.mode("append").parquet(path)


def missing_rights(required: DataFrame, grants: DataFrame) -> DataFrame:
    """Distinct required rights that are not granted."""
    keys = ["grantee", "table_name", "privilege_type"]
    return required.select(*keys).distinct().join(grants, keys, "left_anti")


def grant_matrix(
    grants: DataFrame, tables: Sequence[str], roles: DataFrame | None = None, exclude: Sequence[str] = ("postgres", "PUBLIC")
) -> DataFrame:
    """Ordered privilege list per role and table.

    The set is built in the map tasks and holds at most the number of
    privilege names. ``roles`` adds role columns by an inner join on ``rol``.
    """
    out = (
        grants.where(F.col("table_name").isin(*tables) & ~F.col("grantee").isin(*exclude))
        .groupBy(F.col("grantee").alias("rol"), F.col("table_name").alias("tablo"))
        .agg(F.array_join(F.sort_array(F.collect_set("privilege_type")), ", ").alias("yetkiler"))
    )
    if roles is not None:
        out = out.join(roles, "rol")
    return out.orderBy("rol", "tablo")
