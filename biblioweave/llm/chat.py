"""Chat formatting from an event log: fold deltas, edits and regenerations, then render with reversible escapes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import batch_of

START, MID, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of common templates. One more tilde after the first character makes an ordinary text of them,
# one less brings them back; so texts that hold an escaped control string survive too.
_CONTROL = re.compile(r"([<\[])(~*)(\|[a-z_]+\||/?s>|</?SYS>>|/?SYS>>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])~(~*)(\|[a-z_]+\||/?s>|</?SYS>>|/?SYS>>|/?INST\])")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(MID) + "(.*?)" + re.escape(END), re.DOTALL)

MESSAGES = "conv_id long, message long, role string, text string"
RENDERED = "conv_id long, message long, role string, rendered string, loss_start long, loss_end long"
_MESSAGES = pa.schema([("conv_id", pa.int64()), ("message", pa.int64()), ("role", pa.string()), ("text", pa.string())])
_RENDERED = pa.schema([
    ("conv_id", pa.int64()), ("message", pa.int64()), ("role", pa.string()), ("rendered", pa.string()),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()),
])


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1~\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def by_conversation(df: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, in order; the sort spills, so no conversation must fit in memory."""
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def fold(events: DataFrame) -> DataFrame:
    """Final messages (``conv_id, message, role, text``) of an event log, still partitioned and sorted by conversation.

    Events are ``conv_id, message, seq, kind, role, text`` and, where one number stands for several messages, ``copy``.
    In the order of ``seq`` within a message: ``delta`` appends its text, ``edit`` replaces all text so far,
    ``regenerate`` discards it and what follows builds it anew, ``delete`` removes the message unless a later
    event brings it back. The last role given holds. Null texts are empty, null roles give none, unknown kinds
    are ignored. Equal ``seq`` values are taken in the order of kind, role and text. The fold holds one message
    at a time, so a conversation of any length streams. An empty log gives no message.
    """
    copy = F.col("copy").cast("long") if "copy" in events.columns else F.lit(0).cast("long")
    rows = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("message").cast("long").alias("message"),
        copy.alias("copy"), "seq", "kind", "role", F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, role, parts, alive, out = None, None, [], False, []
        for batch in batches:
            for *place, _, kind, r, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place != key:
                    if alive:
                        out.append((key[0], key[1], role, "".join(parts)))
                    key, role, parts, alive = place, None, [], False
                if kind == "delta":
                    parts.append(text)
                elif kind == "edit":
                    parts = [text]
                elif kind in ("regenerate", "delete"):
                    parts = []
                else:
                    continue
                alive = kind != "delete"
                role = r if r is not None else role
            if out:
                yield batch_of(_MESSAGES, *zip(*out))
                out = []
        if alive:
            yield batch_of(_MESSAGES, *([v] for v in (key[0], key[1], role, "".join(parts))))

    return by_conversation(rows, "message", "copy", "seq", "kind", "role", "text").mapInArrow(run, MESSAGES)


def render(messages: DataFrame) -> DataFrame:
    """One rendered piece per message with the code points ``[loss_start, loss_end)`` that count for the loss.

    The conversation's text is the pieces joined in their order. Only assistant texts count. Order and
    partitions stay as ``fold`` left them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, message, roles, bodies = (c.to_pylist() for c in batch.columns)
            out, starts, ends = [], [], []
            for role, body in zip(roles, bodies):
                head = START + escape(role or "") + MID
                inner = escape(body)
                out.append(head + inner + END)
                counts = role == "assistant"
                starts.append(len(head) if counts else 0)
                ends.append(len(head) + len(inner) if counts else 0)
            yield batch_of(_RENDERED, conv, message, roles, out, starts, ends)

    return messages.mapInArrow(run, RENDERED)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


def digests(rendered: DataFrame) -> DataFrame:
    """What can be read back from rendered conversations, one row each; pieces stream, nothing is joined in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, state, n = None, None, 0

        def closed():
            turns, loss, counts = state
            return [open_key[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]]

        for batch in batches:
            out = []
            for conv, piece, start, end in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_start", "loss_end"))):
                if open_key != (conv,):
                    if state:
                        out.append(closed())
                    open_key, state = (conv,), (hashlib.sha256(), hashlib.sha256(), [0, 0, 0])
                turns, loss, counts = state
                for role, body in _TURN.findall(piece):
                    turns.update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                    counts[0] += 1
                if end > start:
                    text = unescape(piece[start:end])
                    loss.update(text.encode())
                    counts[1] += len(text)
                counts[2] += len(piece)
            if out:
                yield batch_of(_DIGEST, *zip(*out))
        if state:
            yield batch_of(_DIGEST, *([v] for v in closed()))

    return rendered.mapInArrow(run, DIGEST)


def table_events(rows: DataFrame, delta_chars: int = 512) -> DataFrame:
    """The log of a table ``conv_id, turn, role, text``: every row is a message, streamed in deltas of ``delta_chars``.

    Rows of one turn number stay messages of their own, in the order of role and text. A long text is cut into stretches of
    about the root of its deltas first, so no delta is looked up from the start of the whole text.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pieces = F.greatest(F.lit(1), F.ceil(F.length("text") / delta_chars).cast("int"))
    same_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    numbered = rows.select("conv_id", F.col("turn").alias("message"), "role", text.alias("text"), "turn").withColumn(
        "copy", F.row_number().over(same_turn)
    )
    place = ("conv_id", "message", "copy", "role")
    sized = numbered.select(*place, "text", pieces.alias("pieces"), F.greatest(F.lit(16), F.ceil(F.sqrt(pieces))).cast("int").alias("run"))
    stretches = sized.select(*place, "text", "pieces", "run", F.explode(F.expr("sequence(0, pieces - 1, run)")).alias("first")).select(
        *place, "first", F.least("run", F.col("pieces") - F.col("first")).alias("held"),
        F.substr("text", F.col("first") * delta_chars + 1, F.col("run") * delta_chars).alias("stretch"),
    )
    return stretches.select("*", F.explode(F.expr("sequence(0, held - 1)")).alias("next")).select(
        "conv_id", "message", "copy", (F.col("first") + F.col("next")).alias("seq"), F.lit("delta").alias("kind"), "role",
        F.substr("stretch", F.col("next") * delta_chars + 1, F.lit(delta_chars)).alias("text"),
    )
