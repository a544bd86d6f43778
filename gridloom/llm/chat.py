"""Chat formatting by event-sourced reconstruction.

A log holds events of conversations: conv_id, seq, kind, turn, role, text.
Logs are partitioned by conversation, sorted by sequence and folded, event by
event, into final messages, which are then rendered with a template that marks
turns.  ``read_back`` parses rendered conversations again.

Kinds of event
    message     opens a message
    delta       appends text to the last open message of that turn, or opens one
    edit        replaces the text (and the role, if one is given) of that
                message, or opens one
    regenerate  drops that turn and all after it, then opens the message anew

Edge cases.  Null texts and roles are empty; a null kind is ``message``; an
unknown kind raises.  An event without conv_id belongs to no conversation that could
be told from others: it is folded alone and gives a row of its own, with a null
conv_id.  A null seq comes first.  Events of equal seq are ordered by turn, kind,
role and text, so repeated rows of kind ``message`` stay as repeated messages.  A
conversation whose messages were all dropped can't occur, as regenerate opens one.
An empty log gives no rows.  Extra columns of the log are ignored.  Ids are carried
as whole numbers beside nulls.

The fold streams: a task holds the messages of one conversation at a time, which
is what one row of the result holds anyway, and each event takes constant time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
KINDS = ("message", "delta", "edit", "regenerate")
_MESSAGE = re.compile(re.escape(TURN) + r"(.*?)" + re.escape(TEXT) + r"(.*?)" + re.escape(END), re.S)
_ESCAPED = re.compile(r"([\\<\[])\\")


def escape(text: str) -> str:
    """Puts a backslash after each backslash, < and [.  No control string that begins so, nor any mark of the template, is left."""
    return re.sub(r"[\\<\[]", r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Fold:
    """Final messages [turn, role, text parts] of one conversation's events so far, in order."""

    def __init__(self):
        self.messages: list[list] = []
        self.at: dict[int | None, list[int]] = {}  # places of each turn's messages

    def add(self, kind: str, turn: int | None, role: str, text: str) -> None:
        own = self.at.get(turn)
        if kind == "regenerate":
            first = own[0] if own else len(self.messages)
            role = role or (self.messages[first][1] if own else "assistant")
            while len(self.messages) > first:
                gone = self.messages.pop()[0]
                self.at[gone].pop()
                if not self.at[gone]:
                    del self.at[gone]
            own = None
        elif kind not in KINDS:
            raise ValueError(f"unknown kind of event: {kind!r}")
        if kind in ("delta", "edit") and own:
            last = self.messages[own[-1]]
            if kind == "delta":
                last[2].append(text)
            else:
                last[1:] = [role or last[1], [text]]
            return
        self.at.setdefault(turn, []).append(len(self.messages))
        self.messages.append([turn, role, [text]])


def fold(events: Iterator[tuple]) -> list[list]:
    made = Fold()
    for event in events:
        made.add(*event)
    return made.messages


def render(messages: list[list], learn: str = "assistant") -> tuple[str, list[list[int]]]:
    """The formatted conversation and the spans (code points) of the loss mask: the texts of the role that is learnt."""
    out, spans, at = [], [], 0
    for _, role, parts in messages:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape("".join(parts))
        if role == learn:
            spans.append([at + len(head), at + len(head) + len(body)])
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages (role, text) of a formatted conversation."""
    out, at = [], 0
    for m in _MESSAGE.finditer(formatted):
        if m.start() != at:
            break
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no message at {at}")
    return out


def from_rows(conversations: DataFrame) -> DataFrame:
    """A table of finished rows (conv_id, turn, role, text) as a log of message events."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), "turn", "role", "text")


def replayed(conversations: DataFrame) -> DataFrame:
    """A log of streamed events whose fold is a table of finished rows (conv_id, turn, role, text).

    Rows of a conversation are numbered by turn, role and text; in the log, a
    row's number stands for its turn.  By a hash, a row comes as a message that
    deltas complete, as a draft that an edit replaces, or as a draft that is
    streamed for a while and then regenerated in deltas.  A row without conv_id is
    one event.
    """
    empty = F.lit("")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    number = F.row_number().over(Window.partitionBy(*_group("turn")).orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long")
    third = F.ceil(F.length("text") / 3).cast("int")
    one, two, three = (F.substring("text", F.lit(1) + i * third, third) for i in range(3))
    draft, role = F.reverse("text"), F.col("role")

    def event(kind: str, text: Column, said: Column = empty) -> Column:
        return F.struct(F.lit(kind).alias("kind"), said.alias("role"), text.alias("text"))

    streamed = F.array(event("message", one, role), event("delta", two), event("delta", three))
    edited = F.array(event("message", draft, role), event("delta", one), event("edit", F.col("text")))
    again = F.array(event("message", draft, role), event("delta", two), event("regenerate", one, role), event("delta", two), event("delta", three))
    way = F.pmod(F.xxhash64("role", "text"), F.lit(3))
    log = rows.withColumn("number", number).select("conv_id", "number", F.posexplode(F.when(F.col("conv_id").isNull(), F.array(event("message", F.col("text"), role))).when(way == 0, streamed).when(way == 1, edited).otherwise(again)).alias("step", "event"))
    return log.select("conv_id", (8 * F.col("number") + F.col("step")).alias("seq"), "event.kind", F.col("number").alias("turn"), "event.role", "event.text")


def _group(*others: str) -> list[Column]:
    """What deals rows to tasks: conv_id; rows without it, which don't belong together, by their other columns."""
    return [F.col("conv_id"), F.when(F.col("conv_id").isNull(), F.xxhash64(*others, "role", "text"))]


def _order() -> list[Column]:
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.lit(0))
    return [F.col("conv_id"), F.col("seq").asc_nulls_first(), F.col("turn").asc_nulls_first(), rank, F.col("role"), F.col("text")]


def format_conversations(log: DataFrame, learn: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, loss_spans (array of [start, end), code points)."""
    empty = F.lit("")
    log = log.select("conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    dealt = log.repartition(*_group("seq", "turn")).sortWithinPartitions(*_order()).select("conv_id", "kind", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, rows = Fold(), None, []

        def made() -> pa.RecordBatch:
            types = [pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["conv_id", "formatted", "loss_spans"])

        for batch in batches:
            for c, *event in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if held.messages and (c is None or c != key):
                    rows.append((key, *render(held.messages, learn)))
                    held = Fold()
                key = c
                held.add(*event)
            if rows:
                yield made()
                rows = []
        if held.messages:
            rows.append((key, *render(held.messages, learn)))
            yield made()

    return dealt.mapInArrow(run, "conv_id long, formatted string, loss_spans array<array<long>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of formatted conversations, computed from their text and loss spans alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, spans in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                turns = parse(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                learnt = "".join(unescape(text[a:b]) for a, b in spans)
                rows.append((key, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
