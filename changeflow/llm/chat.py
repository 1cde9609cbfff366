"""Chat formatting from event logs.

A log row opens a message, streams a piece of one (``delta``), replaces its text
(``edit``) or starts it over (``regenerate``). Folding the rows in sequence gives the final
messages, each of which is rendered with the template below; assistant texts carry the loss.

Template: ``[INST] text [/INST]`` for the user, ``<s> text </s>`` for the assistant,
``<<SYS>> text <</SYS>>`` for the system and ``[ROLE name] text [/ROLE]`` for other roles, the name
percent-encoded. A control string inside a text gets a backslash in front of it and of
the backslashes before it, which ``read_back`` takes off again, so every text survives.

Scale: rows meet by conversation and message, so the deltas of a conversation that holds a
third of all rows are folded on many tasks, in one pass, holding one message at a time. Rendering is per
message. Only the digest reads a whole conversation in order, as a stream: a hash over its
turns is sequential by definition, and a task holds one turn.

Defined cases: a null text is empty; a null role is an empty name; null sequences come
first and ties go by role and text; a row that repeats another opens a message of its
own; events for a message that was never opened open it; null conversations are one conversation; a
conversation's id is of any type and keeps it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", " </s>"), "system": ("<<SYS>> ", " <</SYS>>")}
_OPEN_ROLE, _CLOSE_ROLE = "[ROLE ", " [/ROLE]"
LOSS_ROLE = "assistant"
_CONTROL = r"(?:</?s>|\[/?INST\]|<</?SYS>>|\[ROLE |\[/ROLE\])"
_TURN = re.compile(r"(?s)(?:\[INST\] (?P<user>.*?) \[/INST\]|<s> (?P<assistant>.*?) </s>"
                   r"|<<SYS>> (?P<system>.*?) <</SYS>>|\[ROLE (?P<name>[^\]]*)\] (?P<other>.*?) \[/ROLE\])")
KINDS = ("message", "delta", "edit", "regenerate")
EXAMPLE = "</s>[INST] ok [/INST]"


def escape(text: str) -> str:
    return re.sub(r"\\*" + _CONTROL, lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\*" + _CONTROL + ")", r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and the span of its escaped text."""
    opening, closing = MARKS.get(role) or (f"{_OPEN_ROLE}{quote(role, safe='', errors='surrogatepass')}] ", _CLOSE_ROLE)
    body = escape(text)
    return opening + body + closing, len(opening), len(opening) + len(body)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation. Inside a text every control string is escaped, and
    marks follow a blank, so the first bare closing mark ends a turn."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}: {formatted[at:at + 40]!r}")
        kind = m.lastgroup
        role = unquote(m["name"], errors="surrogatepass") if kind == "other" else kind
        turns.append((role, unescape(m[kind])))
        at = m.end()
    return turns


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Events (conv, message, seq, kind, role, text), sorted, to messages (conv, message, first seq, role, text)."""
    key, opened = None, None

    def close() -> Iterator[tuple]:
        if opened is not None:
            yield (*key, opened[0], opened[1] or "", "".join(opened[2]))

    for conv, message, seq, kind, role, text in events:
        if opened is None or (conv, message) != key or kind == "message":
            yield from close()
            key, opened = (conv, message), [seq, role, []]
        if opened[1] is None:
            opened[1] = role
        if kind in ("edit", "regenerate"):
            opened[2] = []
        opened[2].append(text or "")
    yield from close()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: pa.Schema, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of a bounded number of characters."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, str))
        if size >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _conversation(rows: DataFrame) -> tuple[pa.DataType, str]:
    """The type of the conversation id, as Arrow's and as Spark's."""
    kind = rows.schema["conv_id"].dataType
    return to_arrow_type(kind), kind.simpleString()


def final_messages(events: DataFrame) -> DataFrame:
    """Log rows (conv_id, message_id, seq, kind, role, text) -> (conv_id, message_id, seq, role, text), one row per
    final message; ``seq`` is where it was opened."""
    typed = events.select("conv_id", F.col("message_id").cast("string"), F.col("seq").cast("long"),
                          "kind", "role", "text")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.coalesce("kind", F.lit("delta")))
    dealt = typed.repartition("conv_id", "message_id").sortWithinPartitions(
        "conv_id", "message_id", F.col("seq").asc_nulls_first(), order, "role", "text")
    conv, kind = _conversation(events)
    out = pa.schema([("conv_id", conv), ("message_id", pa.string()), ("seq", pa.int64()), ("role", pa.string()),
                     ("text", pa.string())])
    return dealt.mapInArrow(lambda batches: _batches(fold(_rows(batches)), out),
                            f"conv_id {kind}, message_id string, seq bigint, role string, text string")


def format_messages(messages: DataFrame) -> DataFrame:
    """Messages -> (conv_id, seq, message_id, piece, loss_start, loss_end): the formatted turn, and the span of the
    loss mask in it (null outside assistant turns). A conversation's text is its pieces in order."""
    conv, kind = _conversation(messages)
    out = pa.schema([("conv_id", conv), ("seq", pa.int64()), ("message_id", pa.string()), ("piece", pa.string()),
                     ("loss_start", pa.int64()), ("loss_end", pa.int64())])

    def rendered(batches):
        for conv, message, seq, role, text in _rows(batches):
            piece, a, b = render(role or "", text or "")
            span = (a, b) if role == LOSS_ROLE else (None, None)
            yield (conv, seq, message, piece, *span)

    return messages.select("conv_id", "message_id", "seq", "role", "text").mapInArrow(
        lambda batches: _batches(rendered(batches), out),
        f"conv_id {kind}, seq bigint, message_id string, piece string, loss_start bigint, loss_end bigint")


def digest(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted pieces: (conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars)."""
    dealt = pieces.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("seq").asc_nulls_first(), "message_id", "piece")
    conv, kind = _conversation(pieces)
    out = pa.schema([("conv_id", conv), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digests(batches):
        state = None
        for conv, _, _, piece, a, b in _rows(batches):
            if state is None or conv != state[0]:
                if state is not None:
                    yield _closed(state)
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_back(piece):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if a is not None:
                loss = unescape(piece[a:b])
                state[3] += len(loss)
                state[4].update(loss.encode("utf-8", "surrogatepass"))
            state[5] += len(piece)
        if state is not None:
            yield _closed(state)

    return dealt.select("conv_id", "seq", "message_id", "piece", "loss_start", "loss_end").mapInArrow(
        lambda batches: _batches(digests(batches), out),
        f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint")


def _closed(state: list) -> tuple:
    return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])


def turn_events(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """A table of finished turns as a log: every row opens a message."""
    def col(c: str) -> Column:
        return F.col(f"`{c}`")
    return conversations.select(col(conv_col).alias("conv_id"), col(turn_col).cast("string").alias("message_id"),
                                col(turn_col).alias("seq"), F.lit("message").alias("kind"),
                                col(role_col).alias("role"), col(text_col).alias("text"))


def example_turns(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts look like the template."""
    return spark.createDataFrame([(-1, k, role, EXAMPLE) for k, role in enumerate(("user", "assistant"))],
                                 "conv_id bigint, turn bigint, role string, text string")
