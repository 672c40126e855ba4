"""What a query really did: the operators of its final plan with the figures they counted.

The frame is planned anew and run once, every row and column of it, into
nothing. Spark counts rows, bytes, files and times in each operator while it
runs; after the run they are read from the final plan, as the adaptive planner
left it, so a join that became a broadcast at run time is shown as one.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROFILE = (
    "id int, parent int, depth int, operator string, detail string, rows_out long, files_read long, folders_read long, "
    "bytes_read long, bytes_shuffled long, bytes_spilled long, bytes_broadcast long, reused boolean, metrics map<string, long>"
)
# Nodes that only wrap others; their children stand in their place.
_WRAPPERS = {"AdaptiveSparkPlan", "InputAdapter", "WholeStageCodegen", "ResultQueryStage", "ShuffleQueryStage", "BroadcastQueryStage"}
_DETAIL_FIELDS = 25


@dataclass
class Step:
    """One operator: its place in the tree and what it counted."""

    id: int
    parent: int | None
    depth: int
    operator: str
    detail: str
    reused: bool = False
    metrics: dict[str, int] = field(default_factory=dict)

    def row(self) -> tuple:
        m = self.metrics
        shuffled = m.get("shuffleBytesWritten")
        broadcast = m.get("dataSize") if self.operator == "BroadcastExchange" else None
        return (
            self.id,
            self.parent,
            self.depth,
            self.operator,
            self.detail,
            # an exchange hands on the records it wrote
            m.get("numOutputRows", m.get("shuffleRecordsWritten")),
            m.get("numFiles"),
            m.get("numPartitions") if "numFiles" in m else None,
            m.get("filesSize"),
            shuffled,
            m.get("spillSize"),
            broadcast,
            self.reused,
            m,
        )


@dataclass
class Profile:
    """The steps of one run, its rows and its milliseconds."""

    steps: list[Step]
    rows: int
    duration_ms: float

    def text(self) -> str:
        """The plan as an indented tree with the rows, files and bytes of each operator."""
        lines = []
        for s in self.steps:
            named = dict(zip([c.split()[0] for c in PROFILE.split(", ")], s.row(), strict=False))
            shown = ("rows_out", "files_read", "folders_read", "bytes_read", "bytes_shuffled", "bytes_spilled", "bytes_broadcast")
            counted = [f"{k}={named[k]}" for k in shown if named[k] is not None]
            again = ["reused"] if s.reused else []
            lines.append("  " * s.depth + " ".join([s.operator, f"({', '.join([*again, *counted])})"]).replace(" ()", ""))
        return "\n".join([*lines, f"{self.rows} rows in {self.duration_ms:.3f} ms"])

    def table(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame([s.row() for s in self.steps], PROFILE)


def _each(scala_items) -> Iterator:
    items = scala_items.iterator()
    while items.hasNext():
        yield items.next()


def _steps(node, parent: int | None, depth: int, steps: list[Step]) -> None:
    name = node.nodeName().split(" (")[0]
    if name in _WRAPPERS or name.endswith("QueryStage"):
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else None
        if inner is None:
            inner = node.plan() if name.endswith("QueryStage") else node.children().head()
        return _steps(inner, parent, depth, steps)
    metrics = {pair._1(): pair._2().value() for pair in _each(node.metrics())}
    # sizes and times that nothing was counted for start below zero
    metrics = {k: v for k, v in metrics.items() if v >= 0}
    reused = name == "ReusedExchange"
    step = Step(len(steps), parent, depth, name.split(" ")[0], node.simpleString(_DETAIL_FIELDS), reused, metrics)
    steps.append(step)
    if reused:
        return None
    for child in _each(node.children()):
        _steps(child, step.id, depth + 1, steps)
    for subquery in _each(node.subqueries()):
        if subquery.nodeName() != "ReusedSubquery":
            _steps(subquery.child(), step.id, depth + 1, steps)
    return None


def run(df: DataFrame) -> Profile:
    """Runs every row and column of a frame once and reads what each operator counted."""
    # a plan of its own: counters of earlier runs of the same frame stay out
    execution = df.alias("profiled")._jdf.queryExecution()
    start = time.perf_counter()
    rows = execution.toRdd().count()
    took = (time.perf_counter() - start) * 1000
    steps: list[Step] = []
    _steps(execution.executedPlan(), None, 0, steps)
    return Profile(steps, rows, round(took, 3))


def profile(df: DataFrame) -> DataFrame:
    """One row for each operator of the final plan, the root first.

    ``rows_out``, ``files_read``, ``folders_read`` (partition folders),
    ``bytes_read``, ``bytes_shuffled``, ``bytes_spilled`` and
    ``bytes_broadcast`` are null where an operator does not count them;
    ``metrics`` holds all that it counts, under Spark's names. An exchange that
    is used again is one row with ``reused`` and not gone through twice.
    """
    return run(df).table(df)


def scans(profiled: DataFrame) -> DataFrame:
    return profiled.where(F.col("operator") == "Scan")
