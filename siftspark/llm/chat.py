"""Chat logs as events: fold them into final messages, render them, and read them back.

An event is (conv_id, seq, message, kind, role, text); `seq` orders a conversation's events.
Kinds: `start` opens a message, `delta` appends text, `edit` replaces the text,
`regenerate` empties the message and takes back the messages opened after it so far.

A conversation may hold a third of all events, so none is gathered: events are folded by
message (a message's own events are all that meet), messages taken back are found by a running
maximum along the conversation, and rendering and reading stream over sorted partitions with one
message in memory. The rendered form is one segment per turn; a conversation's text is their
concatenation.

The template marks turns with control strings. In a text, the escape character is doubled, and a
control string is broken by the escape after its first character, so no text can end a turn.

Defined results: NULL texts are empty, NULL roles the empty role, any other role is marked by name;
events tied in `seq` are taken by kind, then text; messages tied in it by role, then text;
a message without `start` begins at its first event; an empty log gives no segments.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ESCAPE = "\\"
# The control strings of the template.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<ROLE>>", "<</ROLE>>"]
AROUND = {
    "user": ("[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
    "system": ("<<SYS>>", "<</SYS>>"),
}
TRAINED = "assistant"

_SPECIAL = re.compile("|".join(map(re.escape, [ESCAPE, *CONTROLS])))
_ESCAPED = re.compile(re.escape(ESCAPE) + "(.)", re.DOTALL)
_OTHER = re.compile(r"<<ROLE>>(.*?)<</ROLE>>(.*)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render_turn(role: str, text: str, first: bool) -> tuple[str, int, int]:
    """The segment of a turn, and where in it the text under the loss mask lies."""
    if role in AROUND:
        before, after = AROUND[role]
    else:
        before, after = f"<<ROLE>>{escape(role)}<</ROLE>>", "</s>"
    before = "<s>" * first + before
    body = escape(text)
    end = len(before) + len(body)
    return before + body + after, len(before) if role == TRAINED else end, end


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    bare = segment.removeprefix("<s>")
    for role, (before, after) in AROUND.items():
        if bare.startswith(before) and bare.endswith(after):
            return role, unescape(bare[len(before) : len(bare) - len(after)])
    found = _OTHER.fullmatch(bare)
    if found is None:
        raise ValueError("a rendered turn is expected")
    return unescape(found[1]), unescape(found[2])


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, began, role, text: the messages that stand once all events are applied."""
    event = F.struct(
        F.col("seq"), F.col("kind"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    resets = F.col("kind") != "delta"
    folded = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("began"),
        F.coalesce(F.max(F.when(F.col("kind") == "start", F.col("role"))), F.lit("")).alias("role"),
        F.max(F.when(resets, event)).alias("_reset"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("_again"),
        F.array_sort(F.collect_list(event)).alias("_events"),
    )
    standing = F.filter(
        "_events", lambda e: F.col("_reset").isNull() | (e >= F.col("_reset"))
    )
    messages = folded.withColumn(
        "text", F.array_join(F.transform(standing, lambda e: e["text"]), "")
    )
    # What began together with a regenerated message is no answer to it.
    earlier = Window.partitionBy("conv_id").orderBy("began").rangeBetween(Window.unboundedPreceding, -1)
    taken_back = F.coalesce(F.max("_again").over(earlier) > F.col("began"), F.lit(False))
    return (
        messages.withColumn("_gone", taken_back)
        .filter(~F.col("_gone"))
        .select("conv_id", "began", "role", "text")
    )


def render(messages: DataFrame) -> DataFrame:
    """conv_id, turn, segment, loss_start, loss_end: one row per turn, in order per partition."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("turn", pa.int64()),
            ("segment", pa.string()),
            ("loss_start", pa.int64()),
            ("loss_end", pa.int64()),
        ]
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turn = object(), 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text"))):
                turn = turn + 1 if conv == held else 0
                held = conv
                segment, start, end = render_turn(role, text, turn == 0)
                rows.append((conv, turn, segment, start, end))
            columns = zip(*rows) if rows else [[]] * 5
            arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ordered = messages.repartition("conv_id").sortWithinPartitions(
        "conv_id", "began", "role", "text"
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(
        segments, "conv_id long, turn long, segment string, loss_start long, loss_end long"
    )


def digests(segments: DataFrame) -> DataFrame:
    """What a reader finds in the rendered form, per conversation.

    Takes the segments in the order `render` leaves them; hashes run on from batch to batch.
    """
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    names = ("conv_id", "turn", "segment", "loss_start", "loss_end")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def row() -> dict:
            conv, n, turns, chars, loss, formatted = state
            return dict(
                zip(schema.names, (conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))
            )

        for batch in batches:
            done = []
            for conv, turn, segment, start, end in zip(*(batch[c].to_pylist() for c in names)):
                if turn == 0:
                    if state is not None:
                        done.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(segment)
                masked = unescape(segment[start:end])
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(masked)
                state[4].update(masked.encode())
                state[5] += len(segment)
            yield pa.RecordBatch.from_pylist(done, schema)
        if state is not None:
            yield pa.RecordBatch.from_pylist([row()], schema)

    return segments.mapInArrow(
        read,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def events_of_rows(rows: DataFrame, piece: int = 64) -> DataFrame:
    """The log a chat service could have kept for (conv_id, turn, role, text) rows.

    Assistant texts are streamed as a draft that is regenerated in pieces; others are typed as a
    draft and edited. Rows of one turn stay apart; rows without a turn come before all others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.coalesce(F.col("turn") * F.lit(1 << 32), F.lit(-(1 << 62)))
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(piece))
    nothing = F.lit(None).cast("string")

    def event(step, kind, body):
        return F.struct(
            (base + step).alias("seq"), F.lit(kind).alias("kind"), body.alias("text")
        )

    pieces = F.transform(
        starts,
        lambda at: event(at.cast("long") + 3, "delta", F.substr(text, at, F.lit(piece))),
    )
    draft = event(F.lit(1), "delta", F.substr(text, F.lit(1), F.lit(piece)))
    streamed = F.concat(F.array(draft, event(F.lit(2), "regenerate", nothing)), pieces)
    typed = F.array(draft, event(F.lit(2), "edit", text))
    start = F.array(event(F.lit(0), "start", nothing))
    log = F.concat(start, F.when(F.col("role") == TRAINED, streamed).otherwise(typed))
    return (
        rows.withColumn("_message", F.monotonically_increasing_id())
        .select(
            F.col("conv_id"),
            F.col("_message").alias("message"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.explode(log).alias("_event"),
        )
        .select("conv_id", "message", "role", "_event.*")
    )
