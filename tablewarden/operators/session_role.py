"""SET ROLE for a Spark session: SQL text sees the rows of the current role.

Protected tables are temporary views that read a session variable. A query
takes the variable's value when it is analysed, so the condition of one role
folds to that role's predicate and reaches the scan; a frame keeps the role it
was made under. Without a role, or with one that has no policy, no row is seen;
a role without the right to read a table is an error, as in a database.

This guards against mistakes of a session's own queries. Code of a session can
always set another role or read the files, so it is no barrier against it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tablewarden.schemas import GRANTS, POLICIES, Grant, Policy

VARIABLE = "tablewarden_role"
_BASE = "tablewarden_base_"


def _text(value: str) -> str:
    """A SQL literal; quotes and backslashes are doubled."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class SessionRole:
    """The role of a session, and the tables that it filters."""

    def __init__(self, spark: SparkSession, policies: Iterable[Policy] = POLICIES, grants: Iterable[Grant] = GRANTS):
        self.spark, self.policies, self.grants = spark, list(policies), set(grants)
        spark.sql(f"DECLARE OR REPLACE VARIABLE {VARIABLE} STRING DEFAULT NULL")

    def protect(self, df: DataFrame, table: str) -> None:
        """Names a frame as a table of the session's SQL, filtered by the current role.

        A role that may read the table sees the rows of its policies, or all
        rows if the table has no policy at all.
        """
        if not table.isidentifier():
            raise ValueError(f"not a name for a table: {table!r}")
        df.createOrReplaceTempView(_BASE + table)
        mine = [p for p in self.policies if p.table == table]
        readers = sorted({g.role for g in self.grants if g.table == table and g.privilege == "SELECT"})
        cases = []
        for role in readers:
            predicates = [f"({p.predicate})" for p in mine if p.role == role] if mine else ["true"]
            # a filter takes null for false, and a bare predicate can go to the reader
            cases.append(f"WHEN {_text(role)} THEN {' OR '.join(predicates) or 'false'}")
        denied = f"CAST(raise_error(concat(session.{VARIABLE}, {_text(f' has no SELECT on {table}')})) AS BOOLEAN)"
        by_role = f"CASE session.{VARIABLE} {' '.join(cases)} ELSE {denied} END" if cases else denied
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {table} AS SELECT * FROM {_BASE}{table} "
            f"WHERE CASE WHEN session.{VARIABLE} IS NULL THEN false ELSE {by_role} END"
        )

    def current(self) -> str | None:
        return self.spark.sql(f"SELECT session.{VARIABLE}").first()[0]

    def set_role(self, role: str) -> None:
        self.spark.sql(f"SET VAR {VARIABLE} = :role", args={"role": role})

    def reset_role(self) -> None:
        self.spark.sql(f"SET VAR {VARIABLE} = DEFAULT")

    @contextmanager
    def as_role(self, role: str) -> Iterator[SparkSession]:
        """The session under a role; afterwards the role it had before."""
        before = self.current()
        self.set_role(role)
        try:
            yield self.spark
        finally:
            if before is None:
                self.reset_role()
            else:
                self.set_role(before)
