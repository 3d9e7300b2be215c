"""Chat formatting: a finite-state machine over roles, a declarative template,
and text segments with a loss flag each.

Turns stream in order through one state machine per conversation; it holds the
last role and a count, so a conversation of any length needs no more memory than
its longest turn. Each turn gives three segments: opening mark, text, closing
mark. Only the texts of roles marked so in the template carry loss.

Escaping is reversible: the escape character is doubled, and where one of the
template's control strings starts inside a text (or role), the escape character
is put after its first character, so no control string is left. ``unescape``
drops every escape character and keeps what follows.

Defined cases: a null text is empty, a null role is the empty role; roles that
the template does not name are written out (``### @role: ``) and are never in
order. Rows with equal turn stand by role and text. A null conversation id is a
conversation of its own. An empty table gives an empty result. Conversations
out of order are formatted like the others and marked ``valid = false``.
"""
from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks, role names, roles with loss and the machine's transitions."""
    head: str = "### "
    tail: str = ": "
    close: str = "</turn>\n"
    escape: str = "\\"
    other: str = "@"
    names: dict = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    loss: tuple = ("assistant",)
    #: role -> roles that may come before it; "" is the start
    after: dict = field(default_factory=lambda: {"system": ("",), "user": ("", "system", "assistant"), "assistant": ("user",)})
    final: tuple = ("assistant",)

    def control(self) -> list[str]:
        """Strings that a text must not contain: turns are found by them."""
        return [self.head, self.close.strip()]


class Format:
    """The compiled template: writes and reads turns."""

    def __init__(self, template: Template):
        t = self.t = template
        marks = t.control()
        if any(len(m) < 2 or t.escape in m for m in marks):
            raise ValueError("control strings need two characters and no escape character")
        starts = "|".join(map(re.escape, marks))
        self.inside = re.compile(f"(?=(?:{starts}))(.)", re.S)
        e = re.escape(t.escape)
        self.escaped = re.compile(f"{e}(.)", re.S)
        self.header = re.compile(f"{re.escape(t.head)}((?:[^{e}]|{e}.)*?){re.escape(t.tail)}", re.S)
        self.roles = {name: role for role, name in t.names.items()}

    def write(self, text: str) -> str:
        e = self.t.escape
        return self.inside.sub(lambda m: m[1] + e, text.replace(e, e + e))

    def unescape(self, text: str) -> str:
        return self.escaped.sub(r"\1", text)

    def opening(self, role: str) -> str:
        name = self.t.names.get(role)
        if name is None:  # every tail inside the role is broken as well
            e, tail = self.t.escape, self.t.tail
            name = self.t.other + self.write(role).replace(tail[0], e + tail[0])
        return self.t.head + name + self.t.tail

    def read(self, turn: str) -> tuple[str, str]:
        """(role, text) of one turn without its closing mark."""
        m = self.header.match(turn)
        if not m:
            raise ValueError(f"no opening mark: {turn[:40]!r}")
        name = m[1]
        role = self.unescape(name[len(self.t.other):]) if name.startswith(self.t.other) else self.roles[name]
        return role, self.unescape(turn[m.end():])

    def follows(self, before: str, role: str) -> bool:
        return before in self.t.after.get(role, ())


SEGMENTS = "conv_id long, turn long, part int, text string, loss boolean, in_order boolean"


def _segments(template: Template):
    def run(batches):
        form = Format(template)
        conv, state, count = object(), "", 0
        for b in batches:
            out = []
            for own, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if own != conv:
                    conv, state, count = own, "", 0
                ok = form.follows(state, role)
                out += [(own, count, 0, form.opening(role), False, ok), (own, count, 1, form.write(text), role in template.loss, ok),
                        (own, count, 2, template.close, False, ok)]
                state, count = role, count + 1
            yield _batch(out, SEGMENTS)
    return run


def _batch(rows, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*[x.split() for x in schema.split(", ")])
    kind = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    columns = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kind[k]) for c, k in zip(columns, kinds)], list(names))


def format_turns(conversations: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """Segments (conv_id, turn, part, text, loss, in_order), a conversation's in
    order and together within a partition. ``turn`` counts from 0."""
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv_id"), F.coalesce(role, F.lit("")).alias("role"),
                                F.coalesce(text, F.lit("")).alias("text"), F.col(turn).alias("turn"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(_segments(template), SEGMENTS)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")


def _read(template: Template):
    def run(batches):
        form = Format(template)
        now = None
        for b in batches:
            out = []
            columns = [b.column(k).to_pylist() for k in (0, 3, 4, 5)]
            for conv, text, loss, ok in zip(*columns):
                if now is None or conv != now.conv:
                    if now:
                        out.append(now.row())
                    now = _Reader(conv, form)
                now.take(text, loss, ok)
            if out:
                yield _batch(out, READ)
        if now:
            yield _batch([now.row()], READ)
    return run


class _Reader:
    """Reads one formatted conversation piece by piece."""

    def __init__(self, conv, form: Format):
        self.conv, self.form, self.rest, self.valid, self.role = conv, form, "", True, ""
        self.turns = self.chars = self.loss_chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, text: str, loss: bool, ok: bool):
        self.chars += len(text)
        self.valid &= ok
        if loss:
            own = self.form.unescape(text)
            self.loss_chars += len(own)
            self.loss.update(own.encode())
        self.rest += text
        if self.form.t.close in self.rest[-len(text) - len(self.form.t.close):]:
            *done, self.rest = self.rest.split(self.form.t.close)
            for turn in done:
                self.role, body = self.form.read(turn)
                self.all.update(f"{self.role}\n{body}\n".encode())
                self.turns += 1

    def row(self):
        if self.rest:
            raise ValueError(f"conversation {self.conv}: text after the last closing mark")
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.valid and self.role in self.form.t.final)


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, read from the formatted text and loss mask of
    :func:`format_turns` (whose row order it needs)."""
    return segments.mapInArrow(_read(template), READ)
