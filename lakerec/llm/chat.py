"""Chat formatting whose output parses back to the turns it was made from.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. It is rendered as it stands and read again by a deterministic parser.
If what comes back is not the turn, its conflicting strings are escaped and it is rendered again, until it is: a
control string ``<|im_end|>`` becomes ``<\\|im_end|>``, and one that has backslashes already gets one more; in a role,
line feeds and backslashes are written with a backslash. The parser takes one backslash off again.

Turns are rendered and checked one by one where they lie; the output is one row per turn (a segment), and a
conversation's text is its segments in order. No control string stands in a segment but its own, so segments that
parse alone parse together. The loss mask is a span of each assistant's segment, the text without its frame.

Digests of whole conversations run over their turns in order, so one conversation's segments pass through one task;
they are sorted by Spark, which spills, and hashed as a stream that holds one turn at a time, however long the
conversation is. All other work on a hot conversation is spread over its rows.

Defined cases: a null text or role is empty; turns go by number, nulls first, and equal numbers by segment; repeated
rows are turns of their own; a null conversation id is one conversation. Extra columns are dropped. An empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")
_BARE = re.compile(r"<\|im_(?:start|end)\|>")
_BACKSLASHED = re.compile(r"\\(.)", re.DOTALL)

SEGMENTS = "conv_id bigint, turn bigint, segment string, loss_start int, loss_length int"


class Malformed(ValueError):
    """The text does not follow the grammar."""


def escape_text(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|im_\2|>", text)


def unescape_text(text: str) -> str:
    return _ESCAPED.sub(r"<\1|im_\2|>", text)


def escape_role(role: str) -> str:
    return escape_text(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _BACKSLASHED.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape_text(role))


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """``(role, text, start, length)`` of each turn; start and length are those of the text as written.

    conversation = turn*;  turn = START role "\\n" text END "\\n";  neither part holds a bare control string.
    """
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise Malformed(f"no turn at {at}")
        begin = at + len(START)
        control = _BARE.search(formatted, begin)
        if control is None or control[0] != END:
            raise Malformed(f"the turn at {at} does not end")
        header = formatted.find("\n", begin, control.start())
        if header < 0 or not formatted.startswith("\n", control.end()):
            raise Malformed(f"the turn at {at} lacks a line feed")
        written = formatted[header + 1 : control.start()]
        turns.append((unescape_role(formatted[begin:header]), unescape_text(written), header + 1, len(written)))
        at = control.end() + 1
    return turns


def frame(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def _recovers(formatted: str, role: str, text: str) -> bool:
    try:
        turns = parse(formatted)
    except Malformed:
        return False
    return len(turns) == 1 and turns[0][:2] == (role, text)


def render(role: str, text: str) -> str:
    """The turn's segment: what conflicts is escaped, first in the text, then in the role, until it parses back."""
    for written_role, written_text in (
        (role, text),
        (role, escape_text(text)),
        (escape_role(role), text),
        (escape_role(role), escape_text(text)),
    ):
        formatted = frame(written_role, written_text)
        if _recovers(formatted, role, text):
            return formatted
    raise Malformed("a turn that cannot be escaped")  # escaping undoes exactly


def _render_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        segments, starts, lengths = [], [], []
        for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            segment = render(role or "", text or "")
            _, _, start, length = parse(segment)[0]
            segments.append(segment)
            starts.append(start if role == LOSS_ROLE else None)
            lengths.append(length if role == LOSS_ROLE else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(segments, pa.string())]
            + [pa.array(starts, pa.int32()), pa.array(lengths, pa.int32())],
            names=[c.split()[0] for c in SEGMENTS.split(", ")],
        )


def formatted(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, segment, loss_start, loss_length)`` per row of ``turns (conv_id, turn, role, text)``.

    The loss span counts code points of the segment and is null where the turn is under no loss.
    """
    rows = turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    return rows.mapInArrow(_render_rows, SEGMENTS)


_DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def closed(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    current, state = None, None  # state: turns, their hash, loss characters, their hash, characters
    rows: list[tuple] = []
    for batch in batches:
        for conv, segment, start, length in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if state is None or conv != current:
                if state is not None:
                    rows.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in parse(segment):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if start is not None:
                masked = unescape_text(segment[start : start + length])
                state[2] += len(masked)
                state[3].update(masked.encode())
            state[4] += len(segment)
        if len(rows) >= 1000:
            yield closed(rows)
            rows = []
    if state is not None:
        rows.append((current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
    if rows:
        yield closed(rows)


def digests(segments: DataFrame) -> DataFrame:
    """Per conversation what the parser reads from its segments: number and digest of the turns, and of the loss text."""
    rows = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return rows.select("conv_id", "segment", "loss_start", "loss_length").mapInArrow(_read_back, _DIGESTS)
