"""Helpers shared by the text operators."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.session import scratch_dir


#: Bytes of a batch on its way to a Python worker, where the session does not set them.
BATCH_BYTES = 8 << 20
#: Bytes a writer holds of an intermediate table before it writes them out.
ROW_GROUP_BYTES = 16 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(df: DataFrame) -> DataFrame:
    """Gives the package to the Python workers, once a session, and bounds the batches they get; returns ``df``."""
    session = df.sparkSession
    context = session.sparkContext
    if session.conf.get(_BATCH_SETTING, "1") == "1":  # no one sets a batch to one byte
        session.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    if context not in _shipped:
        root = Path(__file__).resolve().parents[1]
        name = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
        with zipfile.ZipFile(name, "w") as package:
            for file in sorted(root.rglob("*.py")):
                package.write(file, file.relative_to(root.parent))
        context.addPyFile(str(name))
        _shipped.add(context)
    return df


_shipped: weakref.WeakSet = weakref.WeakSet()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text; a null text counts as empty."""
    ship_package(docs)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def saved(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Written once to the shared scratch folder and read back, which cuts the lineage.

    ``files`` is the most files to write; a small table needs no file for each
    partition of the shuffle before it.
    """
    path = scratch_dir(df.sparkSession, name)
    (df if files is None else df.coalesce(files)).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def files_for(df: DataFrame, rows: int, rows_per_file: int) -> int:
    """Files for so many rows: as many as run side by side, more where a file would hold too many."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_file))


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``docs`` has them, in whatever case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def every_column(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` as they are named, dots and blanks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def by_number(docs: DataFrame) -> DataFrame:
    """The same rows with columns ``c0``, ``c1``, …, which clash with no name and go to Python whatever they were called."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def with_fields(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` with more fields behind it."""
    types = {"long": T.LongType(), "double": T.DoubleType()}
    more = [T.StructField(name, types[kind]) for name, kind in kinds.items()]
    return T.StructType([*df.schema.fields, *more])


def vocabulary_path(name: str) -> str:
    """A path as given, or the place of a public vocabulary file of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class Known(dict):
    """Values computed when first asked for, and kept up to a number of bytes.

    When half of the bytes are used what is held becomes the old generation;
    what is asked for again moves over from there, so frequent keys stay. Long
    keys are computed each time. Only the memory of a worker depends on it.
    """

    #: What an entry takes beside the characters of its key and the bytes of its value, about.
    ENTRY_BYTES = 250

    def __init__(self, compute: Callable, most_bytes: int, longest: int = 64):
        super().__init__()
        self._compute, self._half, self._longest = compute, most_bytes // 2, longest
        self._used, self._old = 0, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        size = len(key) if isinstance(key, str) else len(key[0])
        if size > self._longest:
            return value
        if self._used >= self._half:
            self._old = dict(self)
            self.clear()
            self._used = 0
        self[key] = value
        self._used += self.ENTRY_BYTES + size + len(value)
        return value


def by_slices(
    fn: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text", limit: int = 8 << 20
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that sees at most about ``limit`` bytes of text at once.

    A single row is never cut, so one very long text is a slice of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = batch.column(batch.schema.get_field_index(text)).nbytes
            rows = max(1, int(batch.num_rows * limit / max(size, 1)))
            for start in range(0, batch.num_rows, rows):
                yield fn(batch.slice(start, rows))

    return run
