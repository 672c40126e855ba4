"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are written for. A cluster sets its own partition counts.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # recording the Python call site of every column costs more than building it
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Rows one task may hold as a single group before the group is split.
ROWS_PER_TASK = 2_000_000


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("tablewarden")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: the one that ``spark.checkpoint.dir`` names.

    Every executor must see it, so off a local master it has to be set. A local
    session without it gets ``tablewarden-scratch`` below the system's temporary
    folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.gettempdir(), "tablewarden-scratch")


# Folders of this process, for clear_scratch.
_made: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for an intermediate table; ``clear_scratch`` removes it."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Removes the scratch folders that this process has made.

    To be called once the results that read them have been written. A session
    on a local master does so when Python ends.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(hadoop).delete(path, True)


def _clear_local() -> None:
    for path in _made:
        if path.startswith(tempfile.gettempdir()):
            shutil.rmtree(path, ignore_errors=True)


atexit.register(_clear_local)
