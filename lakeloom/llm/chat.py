"""Chat formatting by a finite-state machine over roles and a declarative template.

A template says how a turn opens and closes, in which state a role may speak and to which
state it leads, and which roles' texts are trained on. A conversation becomes rows of text
segments in order, each with a flag for the training loss; their concatenation is the
formatted conversation. Texts and roles that look like a control string are escaped so that
only the template's own marks are marks, and the way back gives the very texts.

Turns are shuffled and sorted by conversation and then stream through the machine, whose
state is the only thing kept between rows, so a conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``{role}`` in ``opening`` stands for the role. ``moves`` maps (state, role) to the next
    state; a turn without a move, or in a conversation that broke before, is not valid."""

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    start: str = "begin"
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("begin", "system"): "briefed",
            ("begin", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    trained: frozenset[str] = frozenset({"assistant"})


CHAT_ML = Template()
SEGMENTS = ("open", "text", "close")

# A control string starts "<|". Text gets one backslash more between the two signs, however
# many there are, and the way back takes one away.
_LIKE_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _LIKE_CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role fits on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def turn_segments(role: str, text: str, template: Template = CHAT_ML) -> list[tuple[str, bool]]:
    """A turn's text segments with their loss flags, in order."""
    return [
        (template.opening.replace("{role}", escape_role(role)), False),
        (escape(text), role in template.trained),
        (template.closing, False),
    ]


def _sorted_turns(conversations: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    rows = conversations.select(F.col(key).alias("_key"), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("_role"), F.coalesce(text, F.lit("")).alias("_text"))
    return rows.repartition("_key").sortWithinPartitions("_key", "_turn", "_role", "_text")


def format_turns(
    conversations: DataFrame,
    template: Template = CHAT_ML,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Segments of every turn: the conversation's id, ``position`` (of the turn, from 0),
    ``segment`` (0 to 2), ``content``, ``loss`` and ``valid`` (the turn follows the template).

    Turns go by ``turn``, ties by role and text, nulls first; repeated rows stay. A null
    text or role counts as empty; rows with a null id form one conversation. Every
    conversation is formatted, valid or not. Other columns are not read.
    """
    kind = conversations.schema[key].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position = object(), template.start, 0
        for batch in batches:
            keys, positions, segments, contents, losses, valids = [], [], [], [], [], []
            for k, _, r, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != current:
                    current, state, position = k, template.start, 0
                state = template.moves.get((state, r), "broken")
                for i, (content, loss) in enumerate(turn_segments(r, t, template)):
                    keys.append(k)
                    positions.append(position)
                    segments.append(i)
                    contents.append(content)
                    losses.append(loss)
                    valids.append(state != "broken")
                position += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(positions, pa.int64()), pa.array(segments, pa.int32()), pa.array(contents, pa.string()), pa.array(losses, pa.bool_()), pa.array(valids, pa.bool_())],
                [key, "position", "segment", "content", "loss", "valid"],
            )

    schema = f"`{key}` {kind}, position bigint, segment int, content string, loss boolean, valid boolean"
    return _sorted_turns(conversations, key, turn, role, text).mapInArrow(run, schema)


class _Reader:
    """Reads formatted text back, segment by segment, and digests what it says."""

    def __init__(self, template: Template):
        before, after = template.opening.split("{role}")
        self._turn = re.compile(f"{re.escape(before)}([^\n]*?){re.escape(after)}(.*?){re.escape(template.closing)}", re.S)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.valid = True
        self._open = ""

    def add(self, content: str, loss: bool, valid: bool) -> None:
        self.chars += len(content)
        self.valid &= valid
        if loss:
            trained = unescape(content)
            self.loss_chars += len(trained)
            self.loss.update(trained.encode())
        self._open += content
        found = self._turn.fullmatch(self._open)
        if found:
            self.turns.update(f"{unescape_role(found[1])}\n{unescape(found[2])}\n".encode())
            self.n_turns += 1
            self._open = ""

    def row(self) -> tuple:
        if self._open:
            raise ValueError("formatted text ends inside a turn")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid


def read_back(segments: DataFrame, template: Template = CHAT_ML, key: str = "conv_id") -> DataFrame:
    """One row for each conversation, from its formatted segments alone: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``, ``valid``.

    ``segments`` are rows of ``format_turns``, in its partitions and order or stored and
    sorted anew by the caller."""
    kind = segments.schema[key].dataType.simpleString()
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader, key_type = None, None, None

        def batch_of(rows: Sequence[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], key_type), *(pa.array(c, t) for c, t in zip(columns[1:], types, strict=True))], names)

        for batch in batches:
            key_type, rows = batch.schema.field(0).type, []
            for k, content, loss, valid in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or k != current:
                    if reader is not None:
                        rows.append((current, *reader.row()))
                    current, reader = k, _Reader(template)
                reader.add(content, loss, valid)
            if rows:
                yield batch_of(rows)
        if reader is not None:
            yield batch_of([(current, *reader.row())])

    schema = f"`{key}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"
    return segments.select(key, "content", "loss", "valid").mapInArrow(run, schema)
