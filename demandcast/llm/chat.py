"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events sorted by (turn, sequence):

=============  ===========================================================
``message``    a new message of the turn with its role and text
``delta``      text streamed onto the turn's latest message
``edit``       the latest message's text is replaced
``regenerate`` the latest message starts again; its text so far is dropped
``delete``     the latest message is withdrawn
=============  ===========================================================

:func:`fold` turns logs into final messages, :func:`render` into segments of
formatted text, one per message, with the span under the loss mask, and
:func:`read_back` parses segments into messages again. Folding deals events
out by (conversation, turn), so one long conversation is many groups, and
holds one message at a time. Only what is defined over a whole conversation
in order (:func:`conversation_digests`) reads it in one task, as a stream.

:func:`streamed_rows` writes a table of finished messages as such a log. Digests
are taken from the joined text: it is parsed by the template's marks alone, and
a text that does not end with a message raises.

Template: ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``. Inside texts a backslash is
doubled and every control string is broken by a backslash after its first
character, so no control string occurs in a formatted text but the template's
own, and removing the backslashes gives the text back.

Cases: null text and null role are empty; kinds are read without case and
surrounding spaces, a null kind is ``message``, and events of any other kind
(logs carry reactions, pings and the like) change nothing; deltas, edits and regenerations without a message before
them start one; rows that tie in (turn, sequence) are taken by kind, role,
text; repeated ``message`` rows are messages of their own; a null
conversation id is a conversation; an empty log gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandcast.llm.common import map_arrow, pick, rows_in

# Control strings of public chat templates.
BEGIN, END = "<|im_start|>", "<|im_end|>"
CONTROL = (BEGIN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_BACKSLASH = re.compile(r"\\(\\?)")
KINDS = ("message", "delta", "edit", "regenerate", "delete")
ROWS_AT_A_TIME = 1024
PIECES = 4  # deltas a text is streamed in


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _BACKSLASH.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def format_message(role: str, text: str) -> tuple[str, int, int]:
    """(formatted segment, start, end of the escaped text in it)."""
    head = f"{BEGIN}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


_HEAD = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.DOTALL)


def parse_message(segment: str) -> tuple[str, str]:
    """(role, text) of one formatted segment."""
    if not segment.startswith(BEGIN) or not segment.endswith(END + "\n"):
        raise ValueError("not a formatted message")
    inner = segment[len(BEGIN):-len(END) - 1]
    head = _HEAD.match(inner)
    if head is None:
        raise ValueError("a formatted message without a role line")
    return unescape(head[1]), unescape(inner[head.end():])


def parse_conversation(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the messages of joined formatted text."""
    at = 0
    while at < len(text):
        end = text.find(END + "\n", at)
        if end < 0:
            raise ValueError("formatted text ends inside a message")
        end += len(END) + 1
        yield parse_message(text[at:end])
        at = end


def events_of_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished messages as a log: one ``message`` event per row."""
    return pick(df, conv, turn, role, text).toDF("conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.lit(0).cast("long").alias("seq"), F.lit("message").alias("kind"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def streamed_rows(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished messages as the log a chat service leaves: texts come
    in deltas. By a hash of (conversation, turn) a third of them are begun,
    dropped and regenerated, a third broken off and edited."""
    rows = events_of_rows(df, conv, turn, role, text)
    size = F.ceil(F.length("text") / F.lit(PIECES)).cast("int")
    pieces = F.array(*[F.substring(F.col("text"), F.lit(i) * size + F.lit(1), size) for i in range(PIECES)])
    event = lambda kind, t: F.struct(F.lit(kind).alias("kind"), t.cast("string").alias("text"))
    deltas = F.transform(pieces, lambda t: event("delta", t))
    begun = [event("message", F.lit("")), event("delta", pieces[0])]
    way = F.crc32(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).cast("binary")) % 3
    log: Column = (
        F.when(way == 0, F.concat(F.array(*begun, event("regenerate", F.lit(None))), deltas))
        .when(way == 1, F.array(*begun, event("edit", F.col("text"))))
        .otherwise(F.concat(F.array(begun[0]), deltas)))
    # rows of one turn are messages one after the other
    place = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")) * F.lit(PIECES + 3)
    return rows.withColumn("place", place).select("conv_id", "turn", "place", "role", F.posexplode(log).alias("step", "event")).select(
        "conv_id", "turn", (F.col("place") + F.col("step")).cast("long").alias("seq"), F.col("event.kind").alias("kind"),
        F.when(F.col("event.kind") == "message", F.col("role")).alias("role"), F.col("event.text").alias("text"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, turn, part, role, text) of a log sorted by (conv, turn, seq)."""
    key, part, role, text = None, 0, None, []
    for batch in batches:
        for conv, turn, _, kind, r, t in zip(*[c.to_pylist() for c in batch.columns]):
            kind, r, t = (kind or "message").strip().lower(), r or "", t or ""
            if kind not in KINDS:
                continue
            new_turn = key != (conv, turn)
            if new_turn or kind == "message":
                if role is not None:
                    yield (*key, part, role, "".join(text))
                part = 0 if new_turn else part + (role is not None)
                key, role, text = (conv, turn), None if kind == "delete" else r, []
            elif role is None and kind != "delete":
                role = r
            if kind == "delete":
                role, text = None, []
            elif kind in ("message", "edit"):
                text = [t]
            elif kind == "regenerate":
                text = [t] if t else []
            else:
                text.append(t)
    if role is not None:
        yield (*key, part, role, "".join(text))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = ROWS_AT_A_TIME) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()), ("segment", pa.string()),
                       ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def render(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Segments (conv_id, turn, part, segment, loss_start, loss_end) of the
    final messages of ``events`` (conv_id, turn, seq, kind, role, text); the
    loss span is empty for other roles. A conversation's formatted text is its
    segments in order of (turn, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv, turn, part, role, text in _folded(rows_in(batches, ROWS_AT_A_TIME)):
                segment, start, end = format_message(role, text)
                yield conv, turn, part, segment, start, end if role == loss_role else start

        yield from _in_batches(rows(), _SEGMENTS)

    order = ["conv_id", "turn", "seq", "kind", "role", "text"]
    log = pick(events, *order)
    dealt = log.repartition("conv_id", "turn").sortWithinPartitions(*order)
    return map_arrow(dealt, run, "conv_id long, turn long, part long, segment string, loss_start long, loss_end long")


def read_back(segments: DataFrame) -> DataFrame:
    """Messages (conv_id, turn, part, role, text, loss_text) parsed from segments."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int64()),
                        ("role", pa.string()), ("text", pa.string()), ("loss_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in rows_in(batches, ROWS_AT_A_TIME):
                for conv, turn, part, segment, start, end in zip(*[c.to_pylist() for c in batch.columns]):
                    yield (conv, turn, part, *parse_message(segment), unescape(segment[start:end]))

        yield from _in_batches(rows(), schema)

    return map_arrow(segments, run, "conv_id long, turn long, part long, role string, text string, loss_text string")


def conversation_digests(segments: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted segments: n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def runs(batches):
        """(conversation, its joined text in a batch, loss spans in that)."""
        for batch in rows_in(batches, ROWS_AT_A_TIME):
            columns = [batch.column(i).to_pylist() for i in (0, 3, 4, 5)]
            for conv, group in groupby(zip(*columns), key=lambda row: row[0]):
                texts, spans, at = [], [], 0
                for _, segment, start, end in group:
                    texts.append(segment)
                    spans.append((at + start, at + end))
                    at += len(segment)
                yield conv, "".join(texts), spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for conv, parts in groupby(runs(batches), key=lambda part: part[0]):
                n, chars, loss, turns, lost = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                for _, text, spans in parts:
                    for role, said in parse_conversation(text):
                        turns.update(f"{role}\n{said}\n".encode())
                        n += 1
                    for start, end in spans:
                        masked = unescape(text[start:end])
                        lost.update(masked.encode())
                        loss += len(masked)
                    chars += len(text)
                yield conv, n, turns.hexdigest(), loss, lost.hexdigest(), chars

        yield from _in_batches(rows(), schema)

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part")
    return map_arrow(ordered, run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
