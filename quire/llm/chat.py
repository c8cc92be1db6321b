"""Chat formatting from an event log.

A log has events of conversations: whole messages, streamed deltas, edits and regenerations. It is
partitioned by conversation and sorted by sequence; windows find which events still count, and a
streaming pass folds those into final messages and renders them, one message in memory at a time.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings inside roles and texts are
broken by a backslash after their first character, and a backslash itself is doubled, so the output
reads back to what went in.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import tune

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that chat templates use as control.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_BREAK = re.compile(r"\\|" + "|".join(map(re.escape, CONTROL)))
_JOIN = re.compile(r"\\(.)", re.S)

MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _JOIN.sub(r"\1", text)


def escape_role(role: str) -> str:
    """A role ends at its line's end, so its own line ends are written as a backslash and n."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _JOIN.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def render(role: str, text: str) -> str:
    return f"{START}{escape_role(role)}\n{escape(text)}{END}\n"


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn; begin and end bound the escaped text in formatted."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        yield unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end]), line + 1, end
        at = end + len(END) + 1


def live(events: DataFrame) -> DataFrame:
    """The events that the final messages are made of.

    events (conv_id, seq, kind, turn, role, text): a message, an edit or a regeneration gives its turn's
    text anew, a delta adds to it. Further columns are kept. A regeneration also drops every turn after its own, and what its own
    turn held. Sequence numbers order the events of a conversation; ties go by turn, role and text.
    """
    order = [F.col(c).desc_nulls_last() for c in ("seq", "turn", "role", "text")]
    later = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = events.withColumn("reset", F.min(F.when(F.col("kind") == REGENERATE, F.col("turn"))).over(later)).where("reset is null or turn < reset or turn is null")
    after = Window.partitionBy("conv_id", "turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("anew", F.max((F.col("kind") != DELTA).cast("int")).over(after)).where("anew is null or anew = 0").drop("reset", "anew")


def _folded(rows: Iterable[tuple]) -> Iterator[tuple[object, str, str]]:
    """(conv_id, role, text) of each final message, from live events in order."""
    key, role, text = None, "", []
    for conv, turn, r, t in rows:
        if key == (conv, turn):
            text.append(t or "")
            role = role or r or ""
        else:
            if key is not None:
                yield key[0], role, "".join(text)
            key, role, text = (conv, turn), r or "", [t or ""]
    if key is not None:
        yield key[0], role, "".join(text)


def _sorted(events: DataFrame) -> DataFrame:
    """Live events, each conversation in one task and in order. It is read row by row, never held.

    The rows are dealt by conversation again after live()'s windows. Where they lie so already, the planner leaves
    that shuffle out; where it dealt them otherwise, no conversation is torn.
    """
    tune(events.sparkSession)
    return live(events).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", "role", "text").select("conv_id", "turn", "role", "text")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def formatted(events: DataFrame) -> DataFrame:
    """(conv_id, turn_no, segment, loss_begin, loss_end): the rendered turns in order; joined they are the conversation.

    The loss mask covers the characters loss_begin to loss_end of a segment: an assistant's text. It is
    empty for other roles. A conversation stays in segments, so that none has to fit in one row. Null texts
    and roles are empty; further columns of events are left out, whatever their names; no events give no rows.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()), ("segment", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            before, no = object(), 0
            for conv, role, text in _folded(_rows(batches)):
                before, no = conv, no + 1 if conv == before else 0
                s = render(role, text)
                begin = len(START) + len(escape_role(role)) + 1
                yield conv, no, s, begin, len(s) - len(END) - 1 if role == "assistant" else begin

        return _batches(segments(), schema)

    return _sorted(events).mapInArrow(run, "conv_id bigint, turn_no bigint, segment string, loss_begin bigint, loss_end bigint")


def read_back(segments: DataFrame, together: bool = False) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of what formatted() wrote.

    together: each conversation lies in one partition, as formatted() itself returns it. Segments that were
    stored and read again don't; they are dealt by conversation first. An empty table gives no rows.
    """
    if not together:
        segments = segments.repartition("conv_id")
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            state = None
            for conv, _, segment, begin, end in _rows(batches):
                if state is None or state[0] != conv:
                    if state:
                        yield state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(segment):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                loss = unescape(segment[begin:end])
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(segment)
            if state:
                yield state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

        return _batches(digests(), schema)

    return segments.sortWithinPartitions("conv_id", "turn_no").mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def as_events(conversations: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log of one message each.

    Turns are numbered anew by turn, role and text, nulls first, so that turns with one number stay apart.
    """
    no = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return conversations.select("conv_id", no.alias("seq"), F.lit(MESSAGE).alias("kind"), no.alias("turn"), "role", "text")


def digests(conversations: DataFrame) -> DataFrame:
    """What read_back() finds of conversations, one row each.

    A null text or role is the empty one; a null conv_id is a conversation of its own. Repeated rows are
    turns of their own. An empty table gives no rows.
    """
    return read_back(formatted(as_events(conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text"))), together=True)

