"""Conversations as training samples: turn-aligned windows within a token budget, with a loss mask.

The tokens of the formatted turns are summed up along each conversation. The
sums cut a conversation into chunks of many windows, so one that holds most of
all rows is the work of many tasks. Within a chunk each window takes as many
whole turns as the budget leaves beside the retained system turn and a little
repeated history. Only new assistant texts are targets.

A sample reads ``<s>``, then its turns: ``[SYS]text[/SYS]``, ``[INST]text[/INST]``,
``text</s>`` for the assistant, ``[ROLE]name[TEXT]text[/TEXT]`` for any other
role. Where a text holds one of these marks, an escape character goes between
the mark's first character and the rest; an escape character in a text is
doubled. So every mark in a sample is a real one, and texts come back as they were.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import files_for, saved, ship_package
from tablewarden.llm.token_files import BYTE_VOCABULARY, word_encoder

#: Tokens of a window, marks included. A turn that alone needs more is a window of its own.
BUDGET = 1024
#: Repeated history: the turns before a window, at most so many turns and tokens.
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
#: Budgets of tokens in a chunk, the work of one step of a task.
CHUNK_BUDGETS = 64
#: Turns in a file of an intermediate table.
TURNS_PER_FILE = 100_000

# Marks of the template (fixed values)
START = "<s>"
AROUND = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("", "</s>")}
ROLE, TEXT, END_TEXT = "[ROLE]", "[TEXT]", "[/TEXT]"
MARKS = [START, "</s>", "[SYS]", "[/SYS]", "[INST]", "[/INST]", ROLE, TEXT, END_TEXT]
ESCAPE = "␛"

_TO_ESCAPE = re.compile("|".join(map(re.escape, [ESCAPE, *MARKS])))
_ESCAPED = re.compile(f"{ESCAPE}({ESCAPE}?)")
_MARK = re.compile("|".join(map(re.escape, MARKS)))

TURNS = "conv_id long, turn long, role string, text string"
SAMPLES = (
    "conv_id long, chunk long, window long, first_turn long, n_turns long, n_repeated long, n_tokens long, "
    "over_budget boolean, sample string, targets array<struct<start: long, end: long>>"
)


class Turn(NamedTuple):
    role: str
    text: str


def escaped(text: str) -> str:
    return _TO_ESCAPE.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the escaped text, what stands behind it."""
    if role in AROUND:
        before, behind = AROUND[role]
    else:
        before, behind = ROLE + escaped(role) + TEXT, END_TEXT
    return before, escaped(text), behind


def parsed(sample: str) -> list[Turn]:
    """The turns of a sample, read from its marks alone."""
    marks = [(m[0], m.start(), m.end()) for m in _MARK.finditer(sample)]
    if not marks or marks[0][:2] != (START, 0):
        raise ValueError("not a sample")
    opening = {before: role for role, (before, _) in AROUND.items() if before}
    turns, at, i = [], marks[0][2], 1
    while i < len(marks):
        mark, start, end = marks[i]
        if mark in opening and start == at:
            close = marks[i + 1]
            turns.append(Turn(opening[mark], unescaped(sample[end : close[1]])))
            i, at = i + 2, close[2]
        elif mark == ROLE:
            middle, close = marks[i + 1], marks[i + 2]
            turns.append(Turn(unescaped(sample[end : middle[1]]), unescaped(sample[middle[2] : close[1]])))
            i, at = i + 3, close[2]
        elif mark == AROUND["assistant"][1]:
            turns.append(Turn("assistant", unescaped(sample[at:start])))
            i, at = i + 1, end
        else:
            raise ValueError(f"{mark} out of place")
    return turns


def token_counts(turns: DataFrame, vocabulary: str = BYTE_VOCABULARY) -> DataFrame:
    """The turns with ``n_tokens``: tokens of the escaped text, and one for each mark around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            sizes = []
            for role, text in zip(batch.column(2), batch.column(3), strict=True):
                before, body, behind = formatted(role.as_py(), text.as_py())
                size = sum(1 for m in (before, behind) if m) + len(encoder.encode(body))
                # a role's name stands between two marks
                sizes.append(size if role.as_py() in AROUND else size + 1 + len(encoder.encode(escaped(role.as_py()))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "n_tokens"])

    return turns.mapInArrow(run, f"{TURNS}, n_tokens long")


def placed(turns: DataFrame, vocabulary: str = BYTE_VOCABULARY) -> DataFrame:
    """The turns with ``n_tokens``, ``place``, from 0 on, and ``before``, the tokens of all turns before them.

    Rows go to ranges of conversation and turn, each a bounded part of all rows
    even if they are all alike; the ranges are joined by one row for each
    conversation that is cut. Order is by turn, role and text, nulls first.
    """
    order = ["turn", "role", "text"]
    # the number of a row in the scan parts rows that are alike throughout
    dealt = turns.repartitionByRange("conv_id", *order, F.monotonically_increasing_id())
    # counted behind the shuffle, since finding the ranges reads what is before it twice
    counted = token_counts(dealt, vocabulary).withColumn("piece", F.spark_partition_id().cast("long"))
    dealt = saved(counted, "chat-turns")
    rows = Window.partitionBy("piece", "conv_id").orderBy(*order)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)
    own = dealt.withColumn("place", F.row_number().over(rows).cast("long") - 1)
    own = own.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    sizes = dealt.groupBy("conv_id", "piece").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("conv_id").alias("cut_id"),
        F.col("piece").alias("cut_piece"),
        F.sum("n_rows").over(earlier).alias("rows_before"),
        F.sum("n_tokens").over(earlier).alias("tokens_before"),
    ).where("rows_before is not null")
    # at most one row for each range
    offsets = saved(offsets, "chat-offsets", files=1)
    met = own.join(offsets, (F.col("piece") == F.col("cut_piece")) & F.col("conv_id").eqNullSafe(F.col("cut_id")), "left")
    return met.select(
        *dealt.drop("piece").columns,
        (F.col("place") + F.coalesce("rows_before", F.lit(0))).alias("place"),
        (F.col("before") + F.coalesce("tokens_before", F.lit(0))).alias("before"),
    )


def spans(sizes: np.ndarray, first: int, retained: int, budget: int, turns: int, tokens: int) -> list[tuple[int, int, int]]:
    """Windows over turns with the given tokens, as (first repeated, first new, end), from ``first`` on.

    Turns before ``first`` can be history. Beside the ``retained`` tokens a
    window holds as much history as allowed and as many new turns as fit, one
    at least; history gives way, oldest first, where the first new turn needs
    the room.
    """
    sums = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    while first < len(sizes):
        back = max(first - turns, int(np.searchsorted(sums, sums[first] - tokens, "left")), 0)
        room = budget - retained
        # the oldest turn from which the first new one still fits
        back = min(first, max(back, int(np.searchsorted(sums, sums[first + 1] - room, "left"))))
        end = max(first + 1, int(np.searchsorted(sums, sums[back] + room, "right")) - 1)
        out.append((back, first, end))
        first = end
    return out


def samples(
    conversations: DataFrame,
    vocabulary: str = BYTE_VOCABULARY,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    chunk_budgets: int = CHUNK_BUDGETS,
) -> DataFrame:
    """One row for each window, with its formatted text and the spans of its targets.

    ``conv_id``, then ``chunk`` and ``window``, which order the windows of a
    conversation; ``first_turn`` (place of the first new turn), ``n_turns``,
    ``n_repeated`` (turns at the front that an earlier window has too: the
    system turn and the history), ``n_tokens``, ``over_budget``, ``sample`` and
    ``targets``, spans of code points that cover the text of each new assistant
    turn and nothing else.

    A conversation's turns go by ``turn``, then role and text; nulls come
    first, so rows with the same turn or repeated throughout stay apart. A
    null ``conv_id`` is a conversation of its own, a null role the role ``''``,
    a null text empty. The system turn is the first turn if its role is
    ``system``; every window has it. A turn that does not fit into the budget
    is whole in a window of its own, marked ``over_budget``; texts are never
    cut. Other columns are not read. An empty table gives no rows.
    """
    if history_tokens > chunk_budgets * budget:
        raise ValueError("history must fit into a chunk")
    turns = ship_package(conversations).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = chunk_budgets * budget
    chunk = F.floor(F.col("before") / F.lit(size))
    rows = placed(turns, vocabulary).withColumn("chunk", chunk)
    rows = rows.drop("turn")
    rows = saved(rows, "chat-placed", files_for(rows, turns.count(), TURNS_PER_FILE))
    # turns that begin within the last tokens of a chunk may be history of the next one
    late = rows.where(F.col("before") >= (F.col("chunk") + 1) * size - history_tokens).withColumn("chunk", F.col("chunk") + 1)
    later = rows.where("chunk > 0").select(F.col("conv_id").alias("later_id"), F.col("chunk").alias("later")).distinct()
    system = rows.where("place = 0 and role = 'system'").drop("chunk")
    again = system.join(later, F.col("conv_id").eqNullSafe(F.col("later_id"))).withColumn("chunk", F.col("later"))
    kinds = [(rows, 2), (late.where("place > 0 or role <> 'system'"), 1), (again, 0)]
    columns = ["conv_id", "chunk", "place", "role", "text", "n_tokens"]
    parts = [df.select(*columns, F.lit(kind).alias("kind")) for df, kind in kinds]
    dealt = parts[0].unionByName(parts[1]).unionByName(parts[2]).repartition("conv_id", "chunk")
    dealt = dealt.sortWithinPartitions("conv_id", "chunk", "place", "kind")

    def windows(key: tuple, held: list[dict]) -> Iterator[dict]:
        if all(t["kind"] < 2 for t in held):
            return  # no turn begins in this chunk
        system = held[0] if held[0]["place"] == 0 and held[0]["role"] == "system" else None
        body = held[1:] if system else held
        fresh = next((i for i, t in enumerate(body) if t["kind"] == 2), len(body))
        opens_with_system = bool(system) and system["kind"] == 2
        retained = 1 + (system["n_tokens"] if system else 0)
        sizes = np.array([t["n_tokens"] for t in body], dtype=np.int64)
        cuts = spans(sizes, fresh, retained, budget, history_turns, history_tokens) or [(0, 0, 0)]
        for number, (back, first, end) in enumerate(cuts):
            shown = ([system] if system else []) + body[back:end]
            n_new = end - first + (1 if opens_with_system and number == 0 else 0)
            text, targets, at = [START], [], len(START)
            for i, t in enumerate(shown):
                parts = formatted(t["role"], t["text"])
                if t["role"] == "assistant" and i >= len(shown) - (end - first):
                    targets.append({"start": at + len(parts[0]), "end": at + len(parts[0]) + len(parts[1])})
                text += parts
                at += sum(map(len, parts))
            tokens = retained + int(sizes[back:end].sum())
            yield {
                "conv_id": key[0],
                "chunk": key[1],
                "window": number,
                "first_turn": body[first]["place"] if end > first else 0,
                "n_turns": len(shown),
                "n_repeated": len(shown) - n_new,
                "n_tokens": tokens,
                "over_budget": tokens > budget,
                "sample": "".join(text),
                "targets": targets,
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema()
        out: list[dict] = []
        for key, held in _chunks(batches):
            out.extend(windows(key, held))
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return dealt.mapInArrow(run, SAMPLES)


def _arrow_schema() -> pa.Schema:
    longs = ["conv_id", "chunk", "window", "first_turn", "n_turns", "n_repeated", "n_tokens"]
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.schema(
        [*[(name, pa.int64()) for name in longs], ("over_budget", pa.bool_()), ("sample", pa.string()), ("targets", pa.list_(span))]
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """The rows of each chunk in turn; a chunk is a bounded number of tokens."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (row["conv_id"], row["chunk"]) != key:
                yield key, held
                held = []
            key = (row["conv_id"], row["chunk"])
            held.append(row)
    if held:
        yield key, held


def read_back(samples: DataFrame) -> DataFrame:
    """What each sample says on its own: new turns as ``role\\ntext\\n``, and the unescaped text under the mask."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_turns, said, learned = [], [], []
            for sample, repeated, targets in zip(
                batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True
            ):
                new = parsed(sample)[repeated:]
                n_turns.append(len(new))
                said.append("".join(f"{t.role}\n{t.text}\n" for t in new))
                learned.append("".join(unescaped(sample[t["start"] : t["end"]]) for t in targets))
            sizes = pa.array([len(s) for s in batch.column(3).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n_turns, pa.int64()), pa.array(said, pa.string()), pa.array(learned, pa.string()), sizes],
                names=["conv_id", "chunk", "window", "n_turns", "said", "learned", "formatted_chars"],
            )

    picked = samples.select("conv_id", "chunk", "window", "sample", "n_repeated", "targets")
    return picked.mapInArrow(
        run, "conv_id long, chunk long, window long, n_turns long, said string, learned string, formatted_chars long"
    )


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(samples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its samples alone.

    A digest over a conversation goes through its windows one after the other;
    a task holds one window and the running digests, however long it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        begun, key = False, None
        turns = chars = written = 0
        said, learned = hashlib.sha256(), hashlib.sha256()

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if begun and row["conv_id"] != key:
                    out.append((key, turns, said.hexdigest(), chars, learned.hexdigest(), written))
                    turns = chars = written = 0
                    said, learned = hashlib.sha256(), hashlib.sha256()
                begun, key = True, row["conv_id"]
                turns += row["n_turns"]
                said.update(row["said"].encode("utf-8"))
                chars += len(row["learned"])
                learned.update(row["learned"].encode("utf-8"))
                written += row["formatted_chars"]
            if len(out) >= 1000:
                yield flush()
                out = []
        if begun:
            out.append((key, turns, said.hexdigest(), chars, learned.hexdigest(), written))
        if out:
            yield flush()

    dealt = read_back(samples).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "window")
    return dealt.mapInArrow(run, DIGESTS)


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Formats all conversations and one that speaks in marks, writes the samples, reads them back."""
    turns = conversations.select(*(F.col(c).cast(k).alias(c) for c, k in (t.split() for t in TURNS.split(", "))))
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    marks = turns.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    turns = turns.unionByName(marks)
    windows = samples(turns)
    return conversation_digests(saved(windows, "chat-samples", files_for(windows, turns.count(), TURNS_PER_FILE)))
