"""Cheapest repair of conversations into (s?(ua)+)? by weighted interval parsing.

The grammar has a symbol X(p, q) for every two states p, q of the wanted form: 0 nothing yet, 1 after
the system row, 2 after a user row, 3 after an assistant row. In Chomsky normal form its rules are
X(p, q) -> X(p, r) X(r, q) and X(p, q) -> row, by keeping, reroling or deleting that row. A cell holds
the least (cost, audit) with which a span of rows derives X(p, q). Rows that exist only in the output
derive from no row at all; the closure over such insertions is multiplied into every row's cells on
both sides, so it stands between any two rows.

Spans are combined bottom-up by length. A derivation is in some state r at every border between
rows, so all splits of a span give the same cell and one split, in the middle, is enough (a test
compares this with all splits). Two audits of one cell and cost never are prefixes of each other, as
further insertions cost, so the least audit of a span is made of least audits of its parts.

Rows are dealt by ranges of (conversation, turn), so a long conversation is parsed in blocks by many
tasks; a block is 11 cells, and the few blocks of conversations that a border cuts are combined after.
The digest of a repaired conversation needs its texts in order in one stream, which is read in
sorted order with nothing but the audit in memory.

Defined results: a NULL conv_id is a conversation of its own; NULL roles and texts are one space,
as is a NULL turn or conv_id where rows are drawn for damage; rows of one turn are ordered by role, then
text; an empty role has no initial and fits nowhere; rows repeated whole are duplicates; an empty table
gives no rows. Only `conv_id`, `turn`, `role` and `text` are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftspark.llm.common import slices, staged

Cells = dict[tuple[int, int], tuple[int, str]]

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs; CUT for a truncated row that stays
MOVES = ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (3, "u", 2))
STATES, ACCEPTING = 4, (0, 3)
NEXT = ("su", "ua", "au")  # initials that may stand side by side
PIECE = 1 << 12  # rows whose cells a task makes at once


def _better(cells: Cells, key: tuple[int, int], cost: int, audit: str) -> None:
    if key not in cells or (cost, audit) < cells[key]:
        cells[key] = (cost, audit)


def combine(left: Cells, right: Cells) -> Cells:
    """The cells of two spans side by side."""
    cells: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(STATES):
            if (r, q) in right:
                more, rest = right[r, q]
                _better(cells, (p, q), cost + more, audit + rest)
    return cells


def _inserted() -> Cells:
    """The cells of no rows: states as they are, or reached by inserted rows alone."""
    cells: Cells = {(p, p): (0, "") for p in range(STATES)}
    for _ in range(STATES):
        for (p, r), (cost, audit) in list(cells.items()):
            for a, symbol, b in MOVES:
                if a == r and symbol != "s":
                    _better(cells, (p, b), cost + INSERT, audit + "I")
    return cells


NOTHING = _inserted()


@lru_cache(64)
def row_cells(kind: str) -> Cells:
    """The cells of one row: its initial, in upper case if truncated, or `-` if it must go."""
    cells: Cells = {(p, p): (DELETE, "D") for p in range(STATES)}
    if kind != "-":
        cut = CUT if kind.isupper() else 0
        for p, symbol, q in MOVES:
            if kind.lower() == symbol:
                _better(cells, (p, q), KEEP + cut, "K")
            if symbol != "s":
                _better(cells, (p, q), REROLE + cut, "R")
    return combine(combine(NOTHING, cells), NOTHING)


def _halves(kinds: str) -> Cells:
    if len(kinds) == 1:
        return row_cells(kinds)
    middle = len(kinds) // 2
    return combine(span_cells(kinds[:middle]), span_cells(kinds[middle:]))


_short = lru_cache(1 << 14)(_halves)


def span_cells(kinds: str) -> Cells:
    """The cells of rows in order; short spans come again and again and are remembered."""
    if not kinds:
        return NOTHING
    return _short(kinds) if len(kinds) <= 16 else _halves(kinds)


def best(cells: Cells) -> tuple[int, str]:
    return min(cells[0, q] for q in ACCEPTING if (0, q) in cells)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text: rows dropped, emptied, cut, repeated or given to the user, by crc32."""

    def or_space(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat_ws(":", or_space("conv_id"), or_space("turn")).cast("binary")) % 20
    drawn = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        or_space("role").alias("role"),
        or_space("text").alias("text"),
        draw.alias("draw"),
    )
    damaged = drawn.filter("draw <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("draw") == 1, F.lit(""))
        .when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return damaged.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy"))


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows with `kind`, what `row_cells` wants to know, and `fault`, the first of its faults."""
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.asc_nulls_first("turn"), "copy")
    last = F.right(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    fault = (
        F.when(last == "", F.lit("blank"))
        .when(F.row_number().over(same) > 1, F.lit("duplicate"))
        .when(~last.isin(".", "!", "?"), F.lit("truncated"))
    )
    initial = F.substring("role", 1, 1)
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    kind = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit("-"))
        .when(F.col("fault") == "truncated", F.upper(kind))
        .otherwise(kind)
    )
    return rows.withColumn("fault", fault).withColumn("kind", kind).withColumn("initial", initial)


CELLS = ", ".join(f"cost_{p}{q} long, audit_{p}{q} string" for p in range(STATES) for q in range(STATES))
BLOCK = "conv_id long, task int, first string, last string, illegal long, whole boolean"


def _block(conv_id, task: int, illegal: int, first: str, last: str, cells: Cells, whole: bool) -> dict:
    block = {"conv_id": conv_id, "task": task, "first": first, "last": last, "illegal": illegal, "whole": whole}
    for (p, q), (cost, audit) in cells.items():
        block[f"cost_{p}{q}"], block[f"audit_{p}{q}"] = cost, audit
    return block


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in NEXT for a, b in zip(initials, initials[1:]))


def parse_blocks(rows: DataFrame, tasks: int) -> DataFrame:
    """The cells of each conversation's rows, or of each block of them where ranges cut it.

    `whole` are conversations that begin and end inside one range.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, done = TaskContext.get().partitionId(), None, []

        def close(whole: bool) -> dict:
            cells = combine(held["cells"], span_cells("".join(held["kinds"])))
            illegal, last = held["illegal"] + _illegal(held["initials"]), held["initials"][-1]
            return _block(held["conv_id"], task, illegal, held["first"], last, cells, whole)

        for batch in batches:
            for conv_id, kind, initial in zip(
                batch["conv_id"].to_pylist(), batch["kind"].to_pylist(), batch["initial"].to_pylist()
            ):
                if held is None or held["conv_id"] != conv_id:
                    begins = held is None
                    if not begins:
                        done.append(close(whole=not held["opens"]))
                    held = {
                        "conv_id": conv_id, "kinds": [], "initials": [], "cells": NOTHING,
                        "illegal": 0, "first": initial, "opens": begins,
                    }
                held["kinds"].append(kind)
                held["initials"].append(initial)
                if len(held["kinds"]) >= PIECE:
                    held["cells"] = combine(held["cells"], span_cells("".join(held["kinds"])))
                    held["illegal"] += _illegal(held["initials"])
                    held["kinds"], held["initials"] = [], held["initials"][-1:]
            if done:
                yield pa.RecordBatch.from_pylist(done, BLOCK_SCHEMA)
                done = []
        if held is not None:
            yield pa.RecordBatch.from_pylist([close(whole=False)], BLOCK_SCHEMA)

    by = ["conv_id", F.asc_nulls_first("turn")]
    dealt = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by, "role", "text", "copy")
    return dealt.select("conv_id", "kind", "initial").mapInArrow(parse, f"{BLOCK}, {CELLS}")


BLOCK_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("task", pa.int32()), ("first", pa.string()), ("last", pa.string())]
    + [("illegal", pa.int64()), ("whole", pa.bool_())]
    + [
        (f"{name}_{p}{q}", kind)
        for p in range(STATES)
        for q in range(STATES)
        for name, kind in (("cost", pa.int64()), ("audit", pa.string()))
    ]
)


def _cells_of(block) -> Cells:
    cells: Cells = {}
    for p in range(STATES):
        for q in range(STATES):
            cost = block[f"cost_{p}{q}"]
            if not pd.isna(cost):
                cells[p, q] = (int(cost), block[f"audit_{p}{q}"])
    return cells


VERDICT = "conv_id long, illegal long, cost long, audit string"
VERDICT_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]
)


def best_edits(blocks: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit of each conversation, from its blocks in order."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for block in batch.to_pylist():
                cells = {k: v for k, v in _cells_of(block).items() if k[0] == 0}
                cost, audit = best(cells)
                out.append({"conv_id": block["conv_id"], "illegal": block["illegal"], "cost": cost, "audit": audit})
            if out:
                yield pa.RecordBatch.from_pylist(out, VERDICT_SCHEMA)

    def together(blocks: pd.DataFrame) -> pd.DataFrame:
        rows = blocks.sort_values("task").to_dict("records")
        cells, illegal, last = NOTHING, 0, None
        for row in rows:
            cells = combine(cells, _cells_of(row))
            illegal += row["illegal"] + (last is not None and last + row["first"] not in NEXT)
            last = row["last"]
        cost, audit = best(cells)
        conv_id = rows[0]["conv_id"]
        found = pd.DataFrame({"conv_id": [conv_id], "illegal": [illegal], "cost": [cost], "audit": [audit]})
        return found.astype({"conv_id": "Int64"})

    whole = blocks.filter("whole").mapInArrow(alone, VERDICT)
    return whole.unionByName(blocks.filter("NOT whole").groupBy("conv_id").applyInPandas(together, VERDICT))


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations, inserted rows included.

    Audit and rows of a conversation meet in one task, in order, and pass through it as a stream.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, odd = "", 0, 0, 0
        out: list[dict] = []
        conv_id = None

        def put(row_role: str | None, text: str) -> None:
            nonlocal place
            # The form fixes the roles: a leading system row if their number is odd, then in turns.
            role = row_role or ("user" if (place + odd) % 2 == 0 else "assistant")
            out.append({"conv_id": conv_id, "place": place, "role": role, "text": text})
            place += 1

        def insertions() -> None:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                put(None, "")
                at += 1

        for batch in slices(batches):
            for row in batch.to_pylist():
                if row["audit"] is not None:
                    conv_id, audit, at, place = row["conv_id"], row["audit"], 0, 0
                    odd = sum(audit.count(x) for x in "KRI") % 2
                    insertions()
                    continue
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(row["role"] if edit == "K" else None, row["text"])
                insertions()
            if out:
                yield pa.RecordBatch.from_pylist(out, REPAIRED_SCHEMA)
                out = []

    none = F.lit(None).cast("string")
    audits = edits.select(
        "conv_id", F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"),
        none.alias("text"), F.lit(0).alias("copy"), "audit",
    )
    texts = rows.select("conv_id", F.lit(1).alias("_kind"), "turn", "role", "text", "copy", none.alias("audit"))
    order = ["conv_id", "_kind", F.asc_nulls_first("turn"), "role", "text", "copy"]
    dealt = audits.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return dealt.select("conv_id", "role", "text", "audit").mapInArrow(
        apply, "conv_id long, place long, role string, text string"
    )


REPAIRED_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 over `role:text` joined by newlines; each task has whole conversations in order."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv_id, done = None, None, []
        schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
        for batch in slices(batches):
            for row in batch.to_pylist():
                if state is None or row["place"] == 0:
                    if state is not None:
                        done.append({"conv_id": conv_id, "repaired_sha256": state.hexdigest()})
                    state, conv_id = hashlib.sha256(), row["conv_id"]
                else:
                    state.update(b"\n")
                state.update(f"{row['role']}:{row['text']}".encode())
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "repaired_sha256": state.hexdigest()}], schema)

    return rows.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


def repair_conversations(conversations: DataFrame, damaged: bool = True, tasks: int | None = None) -> DataFrame:
    """One row per conversation: faults counted, the cheapest edits and the repaired conversation's digest.

    Without `damaged` the rows are repaired as they are.
    """
    spark = conversations.sparkSession
    rows = damage(conversations) if damaged else conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(0).alias("copy"),
    )
    rows = staged(with_faults(rows), "conversation-rows")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    edits = staged(best_edits(parse_blocks(rows, tasks)), "edits")

    def number(condition):
        return F.count(F.when(condition, 1))

    counts = rows.groupBy("conv_id").agg(
        *[number(F.col("fault") == fault).alias(fault) for fault in ("blank", "duplicate", "truncated")],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
    )
    named = {"conv_id": "_conv"}

    def same(other: DataFrame):
        return F.col("conv_id").eqNullSafe(other["_conv"])

    result = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (counts, edits, digests(repaired(rows, edits))):
        part = part.withColumnsRenamed(named)
        result = result.join(part, same(part), "left").drop("_conv")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return result.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
