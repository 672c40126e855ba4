"""Price-change guard: decide every change, log it, and give the prices after.

Whether a change is applied depends on its role and on the row's own columns,
never on the running price. The price a change meets is therefore the last
applied price before it, or the base price: one ordered pass per reservation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewarden.functions.exact import ratio, units
from tablewarden.operators.ordered import CHUNK, with_chunk
from tablewarden.operators.policy import role_guard, row_guard
from tablewarden.schemas import (
    BLOCKED_ROLES,
    BLOCKED_TEXT,
    GRANTS,
    LOG_PARTS,
    LOGGED_ROLES,
    LOGGED_TEXT,
    POLICIES,
    RESERVATIONS,
    Grant,
    Policy,
)
from tablewarden.session import ROWS_PER_TASK

KEY = "rezervasyon_id"
# the order of changes; the columns after seq only matter where it is missing
ORDER = ["seq", "islem_zamani", "role", "new_adr"]
BLOCKED, ALLOWED = "ENGELLENDI", "IZIN VERILDI"


class PriceGuard:
    """Rules of the price guard: policies, grants and the listed roles.

    ``require_grant=True`` refuses a role without UPDATE before anything else;
    ``False`` lets blocked roles reach the log, which is what the log is for.
    """

    def __init__(
        self,
        policies: Iterable[Policy] = POLICIES,
        grants: Iterable[Grant] = GRANTS,
        require_grant: bool = False,
        rows_per_task: int = ROWS_PER_TASK,
    ):
        self.policies = [p for p in policies if p.table == RESERVATIONS]
        self.require_grant = require_grant
        self.rows_per_task = rows_per_task
        self._updaters = sorted({g.role for g in grants if g.table == RESERVATIONS and g.privilege == "UPDATE"})

    def _may_update(self) -> Column:
        return F.col("role").isin(*self._updaters) if self.require_grant else F.lit(True)

    def _appliers(self) -> list[str]:
        """Roles that can change a price at all; at most one per policy."""
        roles = {p.role for p in self.policies} - set(BLOCKED_ROLES)
        return sorted(roles & set(self._updaters) if self.require_grant else roles)

    def _last_by_role(self, changes: DataFrame, *keys: str) -> DataFrame:
        """Newest change of each applying role, one row per key, by hash aggregate."""
        aggs = []
        for i, role in enumerate(self._appliers()):
            seq = F.when(F.col("role") == role, F.struct(*ORDER))
            aggs += [F.max(seq).alias(f"_seq{i}"), F.max_by("new_adr", seq).alias(f"_adr{i}")]
        return changes.groupBy(*keys).agg(*aggs)

    def _newest_visible(self) -> Column:
        """Of those, the newest one on a row its role can see; null if none."""
        options = [
            F.when(
                F.col(f"_seq{i}").isNotNull() & row_guard(role, self.policies),
                F.struct(F.col(f"_seq{i}").alias("seq"), F.col(f"_adr{i}").alias("adr")),
            )
            for i, role in enumerate(self._appliers())
        ]
        return F.array_max(F.array(*options))

    def decide(self, changes: DataFrame, base: DataFrame) -> DataFrame:
        """Every change of a known reservation with the price it met and the decision.

        ``changes``: seq (unique long; a missing one comes first), islem_zamani, role, rezervasyon_id, new_adr.
        ``base``: rezervasyon_id, adr and the columns policies name.
        """
        changes, split = with_chunk(changes, [KEY], ORDER, self.rows_per_task)
        applied = (
            self._may_update() & role_guard(F.col("role"), self.policies) & ~F.col("role").isin(*BLOCKED_ROLES)
        )
        earlier = W.partitionBy(KEY, CHUNK).orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1)
        # the struct keeps a null price apart from no price
        local = F.last(F.when(applied, F.struct("new_adr")), ignorenulls=True).over(earlier)

        if split:
            rows = changes.join(self._chunk_starts(changes, base), [KEY, CHUNK])
        else:
            rows = changes.join(base, KEY)
        rows = rows.withColumn("_local", local)
        old = F.when(F.col("_local").isNotNull(), F.col("_local.new_adr")).otherwise(F.col("adr"))
        new = F.col("new_adr")
        decision = (
            F.when(~self._may_update(), "NO_GRANT")
            .when(~role_guard(F.col("role"), self.policies), "INVISIBLE")
            .when(old.eqNullSafe(new), "UNCHANGED")
            .when(F.col("role").isin(*BLOCKED_ROLES), BLOCKED)
            .when(F.col("role").isin(*LOGGED_ROLES), ALLOWED)
            .otherwise("APPLIED")
        )
        percent = ratio(units(new - old, 2, "bigint") * 100, units(old, 2, "bigint"), 2, "bigint")
        return rows.select(
            "seq",
            "islem_zamani",
            "role",
            KEY,
            "hotel",
            old.alias("eski_deger"),
            new.alias("yeni_deger"),
            decision.alias("karar"),
            percent.alias("degisim"),
        )

    def _chunk_starts(self, changes: DataFrame, base: DataFrame) -> DataFrame:
        """Base row per chunk, with adr set to the price at the chunk's start."""
        chunks = self._last_by_role(changes, KEY, CHUNK).join(base, KEY).withColumn("_end", self._newest_visible())
        before = W.partitionBy(KEY).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
        carried = chunks.withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
        adr = F.when(F.col("_carry").isNotNull(), F.col("_carry.adr")).otherwise(F.col("adr"))
        return carried.withColumn("adr", adr).select(*base.columns, CHUNK)

    def prices_after(self, changes: DataFrame, base: DataFrame) -> DataFrame:
        """Base rows with the last applied price of each reservation.

        The changes are reduced to one row per reservation before the join.
        """
        last = self._last_by_role(changes, KEY)
        rows = base.join(last, KEY, "left").withColumn("_end", self._newest_visible())
        adr = F.when(F.col("_end").isNotNull(), F.col("_end.adr")).otherwise(F.col("adr"))
        return rows.withColumn("adr", adr).select(*base.columns)

    def price_deltas(self, changes: DataFrame, base: DataFrame) -> DataFrame:
        """Only the reservations with an applied change, and their new price."""
        last = self._last_by_role(changes, KEY)
        rows = last.join(base, KEY).withColumn("_end", self._newest_visible())
        return rows.where(F.col("_end").isNotNull()).select(KEY, F.col("_end.adr").alias("adr"))


def audit_log(decisions: DataFrame, table: str = RESERVATIONS) -> DataFrame:
    """Log rows of blocked attempts and logged changes."""
    what = F.when(F.col("karar") == BLOCKED, BLOCKED_TEXT).otherwise(LOGGED_TEXT)
    user, at, action, hotel, change = map(F.lit, LOG_PARTS)
    text = F.concat(
        user,
        F.coalesce("role", F.lit("")),
        at,
        F.coalesce(F.date_format("islem_zamani", "yyyy-MM-dd HH:mm:ss"), F.lit("")),
        action,
        what,
        hotel,
        F.coalesce("hotel", F.lit("")),
        change,
        F.coalesce(F.col("degisim").cast("string"), F.lit("")),
    )
    return decisions.where(F.col("karar").isin(BLOCKED, ALLOWED)).select(
        F.col("seq").alias("log_id"),
        F.col("role").alias("kullanici_adi"),
        "islem_zamani",
        F.lit(table).alias("tablo_adi"),
        F.col("karar").alias("islem_turu"),
        text.alias("aciklama"),
        "eski_deger",
        "yeni_deger",
        KEY,
    )


def audit_report(log: DataFrame) -> DataFrame:
    """The log, newest first."""
    return log.orderBy(F.desc_nulls_last("islem_zamani"), F.desc("log_id")).select(
        "log_id",
        "kullanici_adi",
        F.date_format("islem_zamani", "dd.MM.yyyy HH:mm:ss").alias("zaman"),
        "islem_turu",
        F.col("eski_deger").alias("Eski ADR"),
        F.col("yeni_deger").alias("Denenen ADR"),
        "aciklama",
    )
