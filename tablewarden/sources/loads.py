"""Loads that can be repeated: a load counts as a whole, or not at all.

``data/load=<name>/attempt=<id>``  the rows of one attempt, in sorted ranges
``starts/attempt=<id>``            the rows before each file of that attempt
``log/<version>.json``             all finished loads, oldest first

An attempt writes into folders of its own and is then published by one new
version of the list. The list is written aside and renamed, which fails where
the version exists; whoever comes second reads the newer list and tries again.
Readers follow the newest list, so rows of an attempt that broke off, or that
nobody has published yet, are never seen. Ids go on over the loads without a
gap: first id of the load, rows before the file, place in the file.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.operators import serials
from tablewarden.sources import bookings

LOAD, ATTEMPT, ID = "load", "attempt", "id"
_TRIES = 20


class Conflict(Exception):
    """Another writer has published this version."""


@dataclass(frozen=True)
class Load:
    """One finished load: its rows have the ids from ``first_id`` on."""

    load: str
    attempt: str
    first_id: int
    rows: int


class LoadStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    # --- the list of finished loads

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self, *parts: str):
        path = self._path(*parts)
        return path.getFileSystem(self._hadoop), path

    def _version(self) -> tuple[int, list[Load], T.StructType | None]:
        fs, folder = self._files("log")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        versions = [int(n[:-5]) for n in names if re.fullmatch(r"\d{20}\.json", n)]
        if not versions:
            return -1, [], None
        newest = max(versions)
        stream = fs.open(self._path("log", f"{newest:020d}.json"))
        try:
            # java's utility reads the whole of a small file
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return newest, [Load(**one) for one in held["loads"]], T.StructType.fromJson(held["schema"])

    def finished(self) -> list[Load]:
        """The finished loads in the order they were first published."""
        return self._version()[1]

    def _publish(self, version: int, loads: list[Load], schema: T.StructType) -> None:
        """Writes the list as a new version; raises ``Conflict`` if that version exists."""
        jvm = self.spark._jvm
        fs, aside = self._files("log", f".{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        try:
            text = json.dumps({"schema": schema.jsonValue(), "loads": [asdict(x) for x in loads]})
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self._hadoop)
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(aside, self._path("log", f"{version:020d}.json"), options)
        except Py4JJavaError as error:
            fs.delete(aside, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(str(version)) from error
            raise

    # --- loading

    def write(self, load: str, rows: DataFrame, order: Sequence[str | Column] | None = None) -> tuple[str, int]:
        """Writes one attempt and returns its id and its rows; nothing is published.

        ``order`` gives the order of the ids; without it the rows are written
        as they come, partition after partition.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
            raise ValueError(f"not a name for a load: {load!r}")
        attempt = uuid.uuid4().hex
        path = f"{self.root}/data/{LOAD}={load}/{ATTEMPT}={attempt}"
        (rows if order is None else serials.in_ranges(rows, order)).write.parquet(path)
        starts = f"{self.root}/starts/{ATTEMPT}={attempt}"
        serials.file_starts(self.spark, path).coalesce(1).write.parquet(starts)
        n = self.spark.read.parquet(starts).agg(F.sum(serials._FILE_ROWS)).first()[0]
        return attempt, n or 0

    def publish(self, load: str, attempt: str, rows: int, schema: T.StructType, replaces: bool = False) -> Load:
        """Makes a written attempt the load of that name.

        A load that is finished already stays as it is. With ``replaces`` the
        attempt takes its place: under the same ids if it has as many rows, else
        under new ones after all others, so that no id ever means another row
        of another load.
        """
        schema = _nullable(schema)
        for _ in range(_TRIES):
            version, loads, known = self._version()
            if known is not None and known != schema:
                raise ValueError(f"columns differ from those of the loads before: {schema.simpleString()}, {known.simpleString()}")
            old = next((x for x in loads if x.load == load), None)
            if old and not replaces:
                return old
            following = max((x.first_id + x.rows for x in loads), default=0)
            if old and old.rows == rows:
                new = replace(old, attempt=attempt)
                loads = [new if x is old else x for x in loads]
            else:
                new = Load(load, attempt, following, rows)
                loads = [*(x for x in loads if x is not old), new]
            try:
                self._publish(version + 1, loads, schema)
            except Conflict:
                continue
            return new
        raise Conflict(f"{_TRIES} writers were faster")

    def run(self, load: str, rows: DataFrame, order: Sequence[str | Column] | None = None, replaces: bool = False) -> Load:
        """One load from beginning to end; to be repeated under the same name if it fails.

        A load that is finished is not written again.
        """
        old = next((x for x in self.finished() if x.load == load), None)
        if old and not replaces:
            return old
        attempt, n = self.write(load, rows, order)
        return self.publish(load, attempt, n, rows.schema, replaces)

    def read(self) -> DataFrame:
        """The rows of all finished loads with ``load`` and ``id``, as of the newest list."""
        _, loads, schema = self._version()
        if not loads:
            raise FileNotFoundError(f"no finished load in {self.root}")
        paths = [f"{self.root}/data/{LOAD}={x.load}/{ATTEMPT}={x.attempt}" for x in loads]
        # the folder names give load and attempt
        typed = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType()), T.StructField(ATTEMPT, T.StringType())])
        rows = self.spark.read.schema(typed).option("basePath", f"{self.root}/data").parquet(*paths)
        starts = self.spark.read.schema(f"{serials._FILE} string, {serials._FIRST} long, {ATTEMPT} string")
        starts = starts.option("basePath", f"{self.root}/starts").parquet(*[f"{self.root}/starts/{ATTEMPT}={x.attempt}" for x in loads])
        firsts = self.spark.createDataFrame([(x.attempt, x.first_id) for x in loads], f"{ATTEMPT} string, _load_first long")
        begun = starts.join(firsts, ATTEMPT).withColumn(serials._FIRST, F.col(serials._FIRST) + F.col("_load_first"))
        numbered = serials.numbered_files(rows, begun.drop(ATTEMPT, "_load_first"), "_serial")
        return numbered.select(*schema.fieldNames(), LOAD, F.col("_serial").alias(ID))

    def forget_unfinished(self, older_than_hours: float = 24.0) -> int:
        """Removes attempts that no list names and that began long enough ago; returns how many."""
        kept = {x.attempt for x in self.finished()}
        fs, folder = self._files("data")
        gone = 0
        before = (time.time() - older_than_hours * 3600) * 1000
        for load in fs.listStatus(folder) if fs.exists(folder) else []:
            for attempt in fs.listStatus(load.getPath()):
                name = attempt.getPath().getName().removeprefix(f"{ATTEMPT}=")
                if name not in kept and attempt.getModificationTime() <= before:
                    fs.delete(attempt.getPath(), True)
                    fs.delete(self._path("starts", f"{ATTEMPT}={name}"), True)
                    gone += 1
        return gone


def _nullable(schema: T.StructType) -> T.StructType:
    """What a reader of the files sees: every column may be null."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def load_bookings(store: LoadStore, load: str, path: str | list[str], replaces: bool = False) -> Load:
    """Loads booking files under a name; ids follow the files' names and their lines.

    Good and rejected rows stand side by side; ``reason`` is null for a good one.
    """
    rows = bookings.typed(bookings.read_strings(store.spark, path, in_order=True))
    return store.run(load, rows, replaces=replaces)
