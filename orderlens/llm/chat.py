"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

The template says for each role what stands before and after its text, whether the text bears
loss, and which role may follow. Rows of one conversation pass through the machine in turn order
as a stream, so a conversation of any length needs the memory of one turn. Control strings inside
texts are broken up by a backslash after their first character, and backslashes are doubled, so
the output is read back exactly."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_rows


@dataclass(frozen=True)
class Mark:
    """What surrounds a role's text, and whether the text bears loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """``marks`` by role, each beginning with a control string of its own; ``other`` marks any other
    role, whose name stands between its two opening strings; ``follows`` by state (the last role, or
    ``START``) has the roles that may come next; ``final`` the states a conversation may end in."""

    marks: dict[str, Mark]
    other: tuple[str, str, str]
    follows: dict[str, frozenset[str]]
    final: frozenset[str]
    control: tuple[str, ...] = field(default=())

    def __hash__(self) -> int:
        return hash((tuple(sorted(self.marks)), self.other, self.control))

    def controls(self) -> tuple[str, ...]:
        own = {s.strip() for m in self.marks.values() for s in (m.before, m.after)} | set(self.other) | set(self.control)
        return tuple(sorted(own, key=lambda s: (-len(s), s)))


START = ""
#: The instruction marks of a public chat format, one opening and closing mark a role.
INSTRUCT = Template(
    marks={
        "system": Mark("<<SYS>>", "<</SYS>>"),
        "user": Mark("[INST] ", " [/INST]"),
        "assistant": Mark("<s>", "</s>", loss=True),
    },
    other=("<|role|>", "<|text|>", "<|end|>"),
    follows={START: frozenset({"system", "user"}), "system": frozenset({"user"}), "user": frozenset({"assistant"}),
             "assistant": frozenset({"user"})},
    final=frozenset({"assistant"}),
)


@lru_cache(maxsize=8)
def _control(template: Template) -> re.Pattern:
    return re.compile("|".join(map(re.escape, template.controls())))


def escape(text: str, template: Template = INSTRUCT) -> str:
    return _control(template).sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


_BACKSLASH = re.compile(r"\\(\\?)")


def unescape(text: str) -> str:
    return _BACKSLASH.sub(r"\1", text)


def segments(role: str, text: str, template: Template = INSTRUCT) -> list[tuple[str, bool]]:
    """(text, loss flag) pieces of one turn."""
    mark = template.marks.get(role)
    if mark is None:
        a, b, c = template.other
        return [(a + escape(role, template) + b, False), (escape(text, template), False), (c, False)]
    return [(mark.before, False), (escape(text, template), mark.loss), (mark.after, False)]


def read_turn(formatted: str, template: Template = INSTRUCT) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    for role, mark in template.marks.items():
        if formatted.startswith(mark.before) and formatted.endswith(mark.after):
            return role, unescape(formatted[len(mark.before):len(formatted) - len(mark.after)])
    a, b, c = template.other
    cut = formatted.index(b)
    return unescape(formatted[len(a):cut]), unescape(formatted[cut + len(b):len(formatted) - len(c)])


_SEGMENT = pa.struct([("text", pa.string()), ("loss", pa.bool_())])
_TURN = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("allowed", pa.bool_()), ("segments", pa.list_(_SEGMENT))])


def format_chat(turns: DataFrame, template: Template = INSTRUCT, conv_col: str = "conv_id", turn_col: str = "turn",
                role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn, sorted within partitions: ``conv_id``, ``position`` (from 0), ``allowed``
    (the machine accepts the role here), ``segments`` (text, loss).

    A turn that is out of order is formatted all the same and marked; the machine goes on from its
    role. Null texts and roles count as empty; null turns come first; equal turns are ordered by
    role, then text, repeated rows one after another; rows with a null conv_id form one
    conversation. Extra columns are ignored."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        now, position, state = object(), 0, START
        for conv, role, text in items:
            if conv != now:
                now, position, state = conv, 0, START
            allowed = role in template.follows.get(state, frozenset())
            made = [{"text": t, "loss": x} for t, x in segments(role, text, template)]
            yield (conv, position, allowed, made), 64 + 2 * len(text)
            position, state = position + 1, role

    typed = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ordered = typed.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_rows(ordered, ["conv_id", "role", "text"], run, _TURN)


def in_order(formatted: DataFrame) -> DataFrame:
    """Formatted turns of any origin, dealt out and sorted as :func:`format_chat` leaves them."""
    return formatted.repartition("conv_id").sortWithinPartitions("conv_id", "position")


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_())])


def digest(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation of :func:`format_chat`'s output, read back from it as a stream:
    counts and hashes of its turns and of the text under the loss flags, and ``valid`` (every turn
    allowed, the last one final).

    ``formatted`` must come as :func:`format_chat` leaves it, whole conversations in order within the
    partitions. Turns that were written and read again, or dealt out anew, go through :func:`in_order`
    first; without it a conversation that lies in several partitions gives several, wrong rows."""
    def run(items: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        open_row = None
        for conv, position, allowed, made in items:
            if position == 0:
                if open_row:
                    yield open_row.row(), 200
                open_row = _Open(conv, template)
            open_row.add(allowed, made)
        if open_row:
            yield open_row.row(), 200

    return map_rows(formatted, ["conv_id", "position", "allowed", "segments"], run, _DIGEST)


class _Open:
    """Running counts of a conversation that is being read."""

    def __init__(self, conv: int | None, template: Template):
        self.conv, self.template = conv, template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0
        self.valid, self.role = True, START

    def add(self, allowed: bool, made: list[dict]) -> None:
        whole = "".join(s["text"] for s in made)
        self.role, text = read_turn(whole, self.template)
        self.turns.update(f"{self.role}\n{text}\n".encode())
        for s in made:
            if s["loss"]:
                own = unescape(s["text"])
                self.loss.update(own.encode())
                self.loss_chars += len(own)
        self.n, self.chars, self.valid = self.n + 1, self.chars + len(whole), self.valid and allowed

    def row(self) -> tuple:
        return (self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.valid and self.role in self.template.final)
