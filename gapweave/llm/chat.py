"""Chat formatting by a finite-state machine over roles and a declarative template.

The template gives each role the strings before and after a turn, whether its
text counts for the loss, and the control strings of the whole format.  The
machine says which role may follow which; a turn that breaks the order is
formatted all the same and marked, as is everything after it in that
conversation.

Control strings inside texts are escaped: a backslash goes after their first
character, and backslashes are doubled.  So a formatted conversation can be
read back exactly, and no text can fake a turn.

A conversation streams through one task in the order of its turns, a batch at
a time, so its length is not bounded by memory: formatting carries only the
machine's state from turn to turn.  Turns with equal numbers follow each other
by role and text; null turns come first.  Null texts are empty, null roles are
the role ''.  Rows without a conversation id form one conversation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import reachable, slices

START, BROKEN = "start", "broken"


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """How turns look, what counts, and which role may follow which."""

    turns: dict[str, Turn]
    other: Turn  # a role outside ``turns``; its name stands escaped between ``named`` strings
    named: tuple[str, str]
    follows: dict[str, frozenset[str]]  # state (last role, or START) -> roles that may come
    begin: str = ""  # before the first turn of a conversation
    controls: tuple[str, ...] = field(default=())

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        return self._control().sub(lambda m: m[0][0] + "\\" + m[0][1:], text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def _control(self) -> re.Pattern:
        return re.compile("|".join(map(re.escape, sorted(self.controls, key=len, reverse=True))))

    def segments(self, role: str, text: str, first: bool) -> list[tuple[str, bool]]:
        """(text, counts for the loss) pieces of one turn."""
        turn = self.turns.get(role)
        head = self.begin if first else ""
        if turn is None:
            turn = self.other
            head += self.named[0] + self.escape(role) + self.named[1]
        return [(head + turn.before, False), (self.escape(text), turn.loss), (turn.after, False)]

    def step(self, state: str, role: str) -> str:
        """The machine: the role if it may come, else BROKEN for good."""
        return role if state != BROKEN and role in self.follows.get(state, frozenset()) else BROKEN

    def parse(self, formatted: str) -> tuple[str, str]:
        """Role and text of one formatted turn."""
        body = formatted.removeprefix(self.begin)
        if body.startswith(self.named[0]):
            end = body.index(self.named[1])
            role, body = self.unescape(body[len(self.named[0]) : end]), body[end + len(self.named[1]) :]
            turn = self.other
        else:
            role, turn = next((r, t) for r, t in self.turns.items() if body.startswith(t.before) and body.endswith(t.after))
        return role, self.unescape(body[len(turn.before) : len(body) - len(turn.after)])


#: Instruction format: system, then user and assistant in turns.
INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>> ", " <</SYS>>"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("[ANSWER] ", " </s>", loss=True),
    },
    other=Turn("[TURN] ", " [/TURN]"),
    named=("[ROLE] ", " [/ROLE]"),
    follows={
        START: frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    begin="<s>",
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ANSWER]", "[ROLE]", "[/ROLE]", "[TURN]", "[/TURN]"),
)


def _turns(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple]:
    for batch in batches:
        for part in slices(batch, text):
            yield from zip(*[c.to_pylist() for c in part.columns])


def _same(a, b) -> bool:
    return a is b or a == b


def format_chats(df: DataFrame, template: Template = INSTRUCT, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per turn, conversations together and in order: ``conv_id, position, valid, segments, formatted``.

    ``segments`` holds (text, loss); ``formatted`` is their text in one string.
    ``valid`` is false from the first turn that breaks the order.
    """
    slim = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = slim.schema["conv_id"].dataType.simpleString()
    ordered = slim.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    pieces = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, position = object(), START, 0
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for key, role_, text_ in zip(*[part.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                    if not _same(key, current):
                        current, state, position = key, START, 0
                    state = template.step(state, role_)
                    found = template.segments(role_, text_, position == 0)
                    rows.append((position, state != BROKEN, [{"text": t, "loss": x} for t, x in found], "".join(t for t, _ in found)))
                    position += 1
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.bool_(), pieces, pa.string()))]
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), *columns], ["conv_id", "position", "valid", "segments", "formatted"])

    return reachable(ordered).mapInArrow(
        run, f"conv_id {kind}, position long, valid boolean, segments array<struct<text: string, loss: boolean>>, formatted string"
    )


def over_conversations(chats: DataFrame, start: Callable[[], object], schema: str, columns: dict[str, pa.DataType]) -> DataFrame:
    """Fold each conversation of ``format_chats`` with the object that ``start`` makes (``add(row)``, ``result()``)."""
    kind = chats.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fold, done = None, None, []

        def batch() -> pa.RecordBatch:
            data = list(zip(*done)) if done else [[]] * (len(columns) + 1)
            arrays = [pa.array(data[0], key_type), *[pa.array(c, k) for c, k in zip(data[1:], columns.values())]]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", *columns])

        key_type = pa.int64()
        for piece in batches:
            key_type = piece.schema.field("conv_id").type
            for part in slices(piece, "formatted"):
                for row in part.to_pylist():
                    if fold is None or not _same(row["conv_id"], key):
                        if fold is not None:
                            done.append((key, *fold.result()))
                        key, fold = row["conv_id"], start()
                    fold.add(row)
            if len(done) >= 1000:
                yield batch()
                done = []
        if fold is not None:
            done.append((key, *fold.result()))
        if done:
            yield batch()

    return reachable(chats).mapInArrow(run, f"conv_id {kind}, {schema}")
