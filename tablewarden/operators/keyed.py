"""Tables that keep their constraints while they grow: every batch is checked before it is written.

``rows/batch=<n>/status=accepted|refused``  rows, refused ones with their reasons
``keys/batch=<n>``                          keys of accepted rows, in hash buckets
``done/batch=<n>``                          one row for each finished batch

The keys lie in a bucketed table of the catalog, so a batch is dealt out by the
same hash and meets them bucket by bucket; the stored side is never shuffled.
A batch is reduced to one row for each key before it meets them. Only contested
keys, which are stored already or have several rows in the batch, are looked at
again; their rows learn the outcome from the place of the first one, so the rest
of a batch is neither sorted nor moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators.constraints import with_faults
from tablewarden.operators.ordered import settle

BATCH, STATUS, REASONS = "batch", "status", "reasons"
ACCEPTED, REFUSED = "accepted", "refused"
BUCKETS = 64
_PLACE, _FIRST, _WINNER, _STORED, _ROWS, _ORPHAN = "_place", "_first", "_winner", "_stored", "_rows", "_orphan"


@dataclass(frozen=True)
class Reference:
    """Columns whose values must be a key of the parent; a row with a null in one of them passes."""

    columns: tuple[str, ...]
    parent: KeyedTable


class KeyedTable:
    """A table with a unique key, references to other such tables, and rules for single rows.

    ``rules`` name what is wrong and say when: a rule is broken where its
    column is true.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        name: str,
        schema: T.StructType,
        key: Sequence[str],
        references: Sequence[Reference] = (),
        rules: Mapping[str, Column] | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name
        self.schema, self.key, self.references, self.rules = schema, list(key), list(references), dict(rules or {})
        self.buckets, self.keys_table = buckets, f"{name}_keys"
        self._attach()

    def _attach(self) -> None:
        """Names the folder of keys in this session's catalog."""
        columns = ", ".join(f"`{k}` {self.schema[k].dataType.simpleString()}" for k in self.key)
        by = ", ".join(f"`{k}`" for k in self.key)
        if self.spark.catalog.tableExists(self.keys_table):
            self.spark.sql(f"DROP TABLE {self.keys_table}")  # the files stay
        fs, folder = self._folder("keys")
        fs.mkdirs(folder)
        self.spark.sql(
            f"CREATE TABLE {self.keys_table} ({columns}, {BATCH} INT) USING parquet PARTITIONED BY ({BATCH}) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/keys'"
        )
        self.spark.catalog.recoverPartitions(self.keys_table)

    # --- reading

    def _folder(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _exists(self, *parts: str) -> bool:
        fs, path = self._folder(*parts)
        return fs.exists(path)

    def batches(self) -> DataFrame:
        """The finished batches, one row each."""
        if not self._exists("done"):
            return self.spark.createDataFrame([], f"rows_accepted long, rows_refused long, {BATCH} int")
        return self.spark.read.schema(f"rows_accepted long, rows_refused long, {BATCH} int").parquet(f"{self.root}/done")

    def _rows(self, status: str) -> DataFrame:
        fields = [*self.schema.fields, T.StructField(REASONS, T.ArrayType(T.StringType()))]
        schema = T.StructType([*fields, T.StructField(BATCH, T.IntegerType()), T.StructField(STATUS, T.StringType())])
        if not self._exists("rows"):
            return self.spark.createDataFrame([], schema).drop(STATUS)
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/rows").where(F.col(STATUS) == status)
        # a batch that broke off is not seen; there is one row for each batch
        return rows.join(self.batches().select(BATCH), BATCH, "left_semi").select(*self.schema.fieldNames(), REASONS, BATCH)

    def accepted(self) -> DataFrame:
        """Rows of finished batches that broke no constraint, with their batch."""
        return self._rows(ACCEPTED).drop(REASONS)

    def refused(self) -> DataFrame:
        """Rows kept aside, with every reason and their batch."""
        return self._rows(REFUSED)

    def stored_keys(self) -> DataFrame:
        return self.spark.table(self.keys_table)

    # --- checking

    def missing(self, values: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Distinct values without a key here; the stored side is read by buckets and not shuffled."""
        names = dict(zip(columns, self.key, strict=True))
        used = values.select(*columns).dropna().distinct().withColumnsRenamed(names)
        dealt = used.repartition(self.buckets, *self.key)
        return dealt.join(self.stored_keys().select(*self.key).hint("merge"), self.key, "left_anti").withColumnsRenamed(
            {v: k for k, v in names.items()}
        )

    def new_keys(self, candidates: DataFrame, batch: int) -> DataFrame:
        """The keys of the candidates with their rows, and whether other batches hold them."""
        counts = candidates.groupBy(*self.key).agg(F.count("*").alias(_ROWS)).repartition(self.buckets, *self.key)
        stored = self.stored_keys().where(F.col(BATCH) != batch).select(*self.key, F.lit(True).alias(_STORED))
        return counts.join(stored.hint("merge"), self.key, "left").withColumn(_STORED, F.coalesce(_STORED, F.lit(False)))

    def _winners(self, candidates: DataFrame, batch: int) -> DataFrame:
        """For each contested key the place of the row that has it; null where another batch does."""
        contested = self.new_keys(candidates, batch).where(F.col(_STORED) | (F.col(_ROWS) > 1))
        contested = settle(contested, f"{self.name}-contested")
        met = candidates.join(contested.where(~F.col(_STORED)).select(*self.key), self.key, "left_semi")
        firsts = met.groupBy(*self.key).agg(F.min(_FIRST)[_PLACE].alias(_WINNER))
        taken = contested.where(_STORED).select(*self.key, F.lit(None).cast("long").alias(_WINNER)).distinct()
        return settle(firsts.unionByName(taken), f"{self.name}-winners").withColumn(_STORED, F.lit(True))

    def check(self, rows: DataFrame, batch: int, order: Sequence[str] = ()) -> DataFrame:
        """The rows with their reasons; an empty list is a row to accept.

        Of rows with one key the first by ``order`` counts, of those that have
        no other fault; rows that tie go by their place in the scan.
        """
        names = self.schema.fieldNames()
        key_rules = {f"{k}: null in key": F.col(k).isNull() for k in self.key}
        marked = with_faults(rows.select(*names), {**key_rules, **self.rules}, REASONS)
        # written once, so that every step below sees the same places
        marked = settle(marked.withColumn(_PLACE, F.monotonically_increasing_id()), f"{self.name}-batch")
        batch_rows = marked
        for number, reference in enumerate(self.references):
            columns, flag = list(reference.columns), f"{_ORPHAN}{number}"
            orphans = settle(reference.parent.missing(batch_rows, columns), f"{self.name}-orphans").withColumn(flag, F.lit(True))
            broken = F.when(F.col(flag), F.array(F.lit(f"{', '.join(columns)}: not in {reference.parent.name}")))
            found = F.concat(REASONS, F.coalesce(broken, F.array().cast("array<string>")))
            marked = marked.join(orphans, columns, "left").withColumn(REASONS, found).drop(flag)
        candidates = marked.where(F.size(REASONS) == 0).withColumn(_FIRST, F.struct(*order, _PLACE))
        # rows with a fault meet no key
        free = F.size(REASONS) == 0
        winners = self._winners(candidates, batch)
        clash = F.when(free & F.col(_STORED) & ~F.col(_WINNER).eqNullSafe(F.col(_PLACE)), F.array(F.lit(f"{', '.join(self.key)}: key exists")))
        out = marked.join(winners, self.key, "left").withColumn(REASONS, F.coalesce(clash, REASONS))
        return out.select(*names, REASONS)

    def append(self, rows: DataFrame, batch: int, order: Sequence[str] = ()) -> tuple[int, int]:
        """Checks and writes one batch; returns the rows accepted and refused.

        To be repeated under the same number after a failure: the batch's own
        folders are replaced and its own keys do not count against it. Batches
        are written one after the other; a batch after one that broke off is
        refused until that one has been repeated.
        """
        self._no_gap_before(batch)
        status = F.when(F.size(REASONS) == 0, ACCEPTED).otherwise(REFUSED)
        out = f"{self.root}/rows/{BATCH}={batch}"
        checked = self.check(rows, batch, order).withColumn(STATUS, status)
        checked.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(STATUS).parquet(out)
        written = self.spark.read.schema(checked.schema).parquet(out)
        keys = written.where(F.col(STATUS) == ACCEPTED).select(*self.key, F.lit(batch).cast("int").alias(BATCH))
        self._drop_keys(batch)
        keys.repartition(self.buckets, *self.key).write.mode("append").insertInto(self.keys_table)
        counts = {r[STATUS]: r["n"] for r in written.groupBy(STATUS).agg(F.count("*").alias("n")).collect()}
        done = (counts.get(ACCEPTED, 0), counts.get(REFUSED, 0))
        marker = self.spark.createDataFrame([done], "rows_accepted long, rows_refused long").coalesce(1)
        marker.write.mode("overwrite").parquet(f"{self.root}/done/{BATCH}={batch}")
        return done

    def _drop_keys(self, batch: int) -> None:
        """Removes the keys that an earlier attempt at the batch has stored."""
        self.spark.sql(f"ALTER TABLE {self.keys_table} DROP IF EXISTS PARTITION ({BATCH}={batch})")
        fs, path = self._folder("keys", f"{BATCH}={batch}")
        fs.delete(path, True)

    def _no_gap_before(self, batch: int) -> None:
        fs, path = self._folder("rows")
        begun = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        for name in begun:
            other = int(name.removeprefix(f"{BATCH}="))
            if other != batch and not self._exists("done", name):
                raise RuntimeError(f"batch {other} of {self.name} broke off; repeat it first")
