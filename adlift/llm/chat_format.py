"""Chat formatting with a grammar round trip.

A conversation becomes one text in which markers open and close every turn::

    conversation := turn*
    turn  := "<<SYS>>" text "<</SYS>>"          role system
           | "[INST]" text "[/INST]"             role user
           | "<s>" text "</s>"                   role assistant
           | "<<TURN>>" role "<<:>>" text "<</TURN>>"   any other role

Inside role and text a backslash before ``\\``, ``<`` or ``[`` is an escape. A
turn is first rendered as it is, read again by the parser below, and compared
with its source. As long as they differ, the text is escaped more: first only
where a marker stands, then at every character that can begin one. The last
level always comes back identical, so plain texts stay as they are.

Turns are rendered row by row, without a shuffle, so that one huge conversation
is spread over all tasks. ``assemble`` then sorts by conversation and turn and
streams: a conversation longer than ``PART_CHARS`` comes as several numbered
parts, cut between turns, and no conversation is ever held whole.

Null text and null role are empty; null turns come first; rows that repeat a
turn number are ordered by role and text and all stay; null conversation ids
form one conversation. Other columns are not read. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from adlift.llm.frames import ship_package

PART_CHARS = 1 << 20
OPEN = {"system": "<<SYS>>", "user": "[INST]", "assistant": "<s>"}
CLOSE = {"system": "<</SYS>>", "user": "[/INST]", "assistant": "</s>"}
OTHER, NAMED, END = "<<TURN>>", "<<:>>", "<</TURN>>"
MARKERS = sorted([*OPEN.values(), *CLOSE.values(), OTHER, NAMED, END], key=len, reverse=True)

_MARKER = re.compile("|".join(map(re.escape, MARKERS)))
_TOKEN = re.compile(r"\\[\\<\[]|" + _MARKER.pattern)
_SPECIAL = re.compile(r"[\\<\[]")
_ESCAPED = re.compile(r"\\([\\<\[])")

#: How much of a text is escaped, level after level.
LEVELS = (
    lambda text: text,
    lambda text: _MARKER.sub(lambda m: "\\" + m[0], text),
    lambda text: _SPECIAL.sub(lambda m: "\\" + m[0], text),
)

FORMATTED = "conv_id long, part int, text string, turn_starts array<int>, loss_starts array<int>, loss_ends array<int>"


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(text: str) -> list[tuple[str, str, int, int]] | None:
    """Role, text, and the place of the raw text of each turn; None if the text is not in the grammar."""
    turns, at, closes = [], 0, {CLOSE[r]: r for r in CLOSE}
    tokens = (m for m in _TOKEN.finditer(text) if m[0][0] != "\\")
    for opened in tokens:
        role = next((r for r, mark in OPEN.items() if mark == opened[0]), None)
        if opened.start() != at or (role is None and opened[0] != OTHER):
            return None
        start, end = opened.end(), next(tokens, None)
        if role is None:
            if end is None or end[0] != NAMED:
                return None
            role, start, end = unescape(text[start : end.start()]), end.end(), next(tokens, None)
            if end is None or end[0] != END or role in OPEN:
                return None
        elif end is None or closes.get(end[0]) != role:
            return None
        turns.append((role, unescape(text[start : end.start()]), start, end.start()))
        at = end.end()
    return turns if at == len(text) else None


def _turn(role: str, text: str, escape) -> str:
    if role in OPEN:
        return OPEN[role] + escape(text) + CLOSE[role]
    return OTHER + escape(role) + NAMED + escape(text) + END


def render(role: str, text: str) -> str:
    """One turn, escaped as little as the round trip allows."""
    for escape in LEVELS:
        rendered = _turn(role, text, escape)
        found = parse(rendered)
        if found is not None and [t[:2] for t in found] == [(role, text)]:
            return rendered
    raise ValueError("a turn does not survive its round trip")


def format_turns(chats: DataFrame) -> DataFrame:
    """Every row with its rendered turn and the place of its text there; no shuffle."""
    ship_package(chats.sparkSession)

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = [r or "" for r in batch.column(2).to_pylist()]
            out = [render(r, t or "") for r, t in zip(roles, batch.column(3).to_pylist())]
            columns = [*batch.columns[:2], pa.array(roles, pa.string()), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "role", "rendered"])

    rows = chats.select(
        chats["conv_id"].cast("long").alias("conv_id"),
        chats["turn"].cast("long").alias("turn"),
        chats["role"].cast("string").alias("role"),
        chats["text"].cast("string").alias("text"),
    )
    return rows.mapInArrow(rendered, "conv_id long, turn long, role string, rendered string")


class _Parts:
    """Gathers turns into parts; a part ends with its conversation or at ``PART_CHARS``."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.key, self.part = None, -1
        self._begin()

    def _begin(self) -> None:
        self.text, self.length, self.turns, self.starts, self.ends = [], 0, [], [], []

    def flush(self) -> None:
        if self.turns:
            self.rows.append((self.key, self.part, "".join(self.text), self.turns, self.starts, self.ends))
        self._begin()

    def add(self, key, role: str, rendered: str) -> None:
        if self.part < 0 or key != self.key:
            self.flush()
            self.key, self.part = key, 0
        elif self.length >= PART_CHARS:
            self.flush()
            self.part += 1
        self.turns.append(self.length)
        if role == "assistant":
            self.starts.append(self.length + len(OPEN[role]))
            self.ends.append(self.length + len(rendered) - len(CLOSE[role]))
        self.text.append(rendered)
        self.length += len(rendered)


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    ints = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.int32(), pa.string(), ints, ints, ints]
    names = ["conv_id", "part", "text", "turn_starts", "loss_starts", "loss_ends"]
    columns = zip(*rows) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def assemble(turns: DataFrame) -> DataFrame:
    """Formatted conversations: text, where its turns begin, and the spans under the loss mask."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = _Parts()
        for batch in batches:
            keys, roles, texts = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for key, role, text in zip(keys, roles, texts):
                parts.add(key, role, text)
            yield _part_batch(parts.rows)
            parts.rows = []
        parts.flush()
        yield _part_batch(parts.rows)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "rendered")
    return ordered.mapInArrow(joined, FORMATTED)


def format_chats(chats: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as formatted parts, each conversation's in order."""
    return assemble(format_turns(chats))


class _Digest:
    def __init__(self, key) -> None:
        self.key, self.turns, self.loss_chars, self.chars = key, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, starts: list[int], ends: list[int]) -> None:
        found = parse(text)
        if found is None:
            raise ValueError(f"conversation {self.key} cannot be read back")
        for role, said, _, _ in found:
            self.all.update(f"{role}\n{said}\n".encode())
        for start, end in zip(starts, ends):
            said = unescape(text[start:end])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.turns += len(found)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.key, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: turns and masked text as the parser finds them in the output of ``format_chats``.

    Reads the parts in the order in which ``format_chats`` leaves them, one at a time.
    """

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in READ.split(", ")]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                key, part, text = (batch.column(j)[i].as_py() for j in range(3))
                if part == 0:
                    if current is not None:
                        rows.append(current.row())
                    current = _Digest(key)
                current.add(text, batch.column(4)[i].as_py(), batch.column(5)[i].as_py())
            yield batch_of(rows)
        if current is not None:
            yield batch_of([current.row()])

    return formatted.mapInArrow(digests, READ)
