"""Chat formatting: a state machine over roles, and segments with loss flags from a template.

A template names, for each role, what stands before and after a turn's text and whether the text is
trained on, and the turns that may follow in each state. A conversation's turns become segments,
head, text and tail, whose concatenation is the formatted text. Strings that steer a reader are
escaped inside roles and texts, so that the text can be read back.

A conversation is a sequence, so its turns pass through one task in order; they pass as a sorted
stream, and a task holds one turn at a time, however long the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD, MIDDLE, TAIL = "### ", ": ", "</turn>\n"
_STEERING = re.compile(r"\\|###|</turn>")
_STEERING_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(
    r"### (?P<role>(?:\\.|[^\\:])*): (?P<text>(?:\\.|[^\\])*?)</turn>\n", re.DOTALL
)


def escaped(text: str, steering: re.Pattern = _STEERING) -> str:
    return steering.sub(lambda found: "\\" + found[0], text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Template:
    """``names``: how roles are shown; others are shown as they are. ``trained``: roles whose texts
    are under the loss. ``follows``: for each state the roles that may come; a turn's state is its
    role, or ``stray`` if no state has that name, and the first state is ``start``. ``ends``: states
    in which a conversation may stop."""

    names: dict[str, str] = field(default_factory=dict)
    trained: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(default_factory=dict)
    ends: frozenset[str] = frozenset({"assistant"})

    def after(self, role: str) -> str:
        return role if role in self.follows and role not in ("start", "stray") else "stray"

    def shown(self, role: str) -> str:
        """A role as it is written. One that is spelled like another's name is escaped as a whole, so
        it is not read back as that."""
        written = escaped(self.names.get(role, role), _STEERING_ROLE)
        taken = role not in self.names and role in self.names.values()
        return "\\" + written if taken else written

    def read(self, shown: str) -> str:
        """The role that was written so."""
        for role in self.names:
            if self.shown(role) == shown:
                return role
        return unescaped(shown)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        head = HEAD + self.shown(role) + MIDDLE
        return [(head, False), (escaped(text), role in self.trained), (TAIL, False)]


STANDARD = Template(
    names={"system": "System", "user": "User", "assistant": "Assistant"},
    follows={
        "start": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
        "stray": frozenset({"user"}),
    },
)


def chat_segments(
    turns: DataFrame,
    template: Template = STANDARD,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``id_column, position, part, segment, loss, allowed, state``: the segments of each
    conversation, three a turn, in order within a partition.

    ``allowed`` says whether the state machine lets the turn come; a turn that it does not is
    formatted all the same, and the machine goes on from it. Turns come by number, a null one last,
    those alike by role and text; repeated rows are turns of their own. A null role or text counts
    as empty; a null id is a conversation. Further columns are not read; an empty table gives an
    empty one.
    """
    rows = turns.select(
        F.col(id_column).alias("id"),
        F.col(turn_column).alias("turn"),
        F.coalesce(role_column, F.lit("")).alias("role"),
        F.coalesce(text_column, F.lit("")).alias("text"),
    )
    in_order = ["id", F.col("turn").asc_nulls_last(), "role", "text"]
    ordered = rows.repartition("id").sortWithinPartitions(*in_order).select("id", "role", "text")
    names = ["id", "position", "part", "segment", "loss", "allowed", "state"]

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, now, position, state = False, None, 0, "start"
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = part.column("id")
                out: list[tuple] = []
                keys = []
                for k, (key, role, text) in enumerate(
                    zip(*(c.to_pylist() for c in part.columns), strict=True)
                ):
                    if not started or key != now:
                        started, now, position, state = True, key, 0, "start"
                    allowed = role in template.follows.get(state, ())
                    state = template.after(role)
                    for which, (segment, loss) in zip(
                        ("head", "text", "tail"), template.segments(role, text), strict=True
                    ):
                        keys.append(k)
                        out.append((position, which, segment, loss, allowed, state))
                    position += 1
                kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_(), pa.string()]
                columns = zip(*out, strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(keys)), *arrays], names)

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    schema = schema.add("position", "long").add("part", "string").add("segment", "string")
    schema = schema.add("loss", "boolean").add("allowed", "boolean").add("state", "string")
    return ordered.mapInArrow(form, schema).withColumnRenamed("id", id_column)


class _Reading:
    """A conversation, read back from its formatted text as it comes."""

    def __init__(self) -> None:
        self.turns = self.formatted = self.trained = 0
        self.pending = ""
        self.every, self.loss = hashlib.sha256(), hashlib.sha256()
        self.valid, self.state = True, "start"

    def add(self, segment: str, loss: bool, allowed: bool, state: str, template: Template) -> None:
        self.formatted += len(segment)
        self.valid &= allowed
        self.state = state
        if loss:
            plain = unescaped(segment)
            self.trained += len(plain)
            self.loss.update(plain.encode())
        self.pending += segment
        if not segment.endswith(TAIL):
            return
        end = 0
        while found := _TURN.match(self.pending, end):
            self.turns += 1
            role = template.read(found["role"])
            for part in (role, "\n", unescaped(found["text"]), "\n"):
                self.every.update(part.encode())
            end = found.end()
        self.pending = self.pending[end:]


def chat_digests(
    segments: DataFrame, template: Template = STANDARD, id_column: str = "conv_id"
) -> DataFrame:
    """What is read back of each conversation of ``chat_segments``, in whose order the segments
    have to come: ``id_column, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid``; ``valid`` if the state machine lets all its turns come and lets it stop there."""
    rows = segments.withColumnRenamed(id_column, "id")
    names = "id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars valid".split()
    read = ["id", "position", "part", "segment", "loss", "allowed", "state"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reading, kind = None, None, None

        def emitted(done: list[tuple]) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names
            )

        def row() -> tuple:
            if reading.pending:
                raise ValueError(f"conversation {now}: {reading.pending[:80]!r} cannot be read")
            return (
                *(now, reading.turns, reading.every.hexdigest()),
                *(reading.trained, reading.loss.hexdigest(), reading.formatted),
                reading.valid and reading.state in template.ends,
            )

        for batch in batches:
            kind = batch.column(0).type
            done: list[tuple] = []
            for key, _, _, segment, loss, allowed, state in zip(
                *(batch.column(c).to_pylist() for c in read), strict=True
            ):
                if reading is None or key != now:
                    if reading is not None:
                        done.append(row())
                    now, reading = key, _Reading()
                reading.add(segment, loss, allowed, state, template)
            if done:
                yield emitted(done)
        if reading is not None:
            yield emitted([row()])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    schema = schema.add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long")
    schema = schema.add("loss_sha256", "string").add("formatted_chars", "long").add("valid", "boolean")
    return rows.mapInArrow(digest, schema).withColumnRenamed("id", id_column)
