"""Chat formatting by a finite-state machine over roles.

A ``Template`` declares for each role the strings before and after a text and
whether the text bears loss, and which role may follow which.  Turns are range-
partitioned by (conv_id, turn), so a conversation of any length is spread over
tasks.  Each part first gives, for its first and its last conversation, the
state that every state leads to; these few maps (two for each part) are
composed, and each part then runs the machine from the state it is entered in.

Each turn becomes three segments: prefix, text and suffix, each with its loss
flag.  Inside texts an escape character doubles itself and breaks every
control string after its first character, so no text can open or close a turn, and
``unescape`` restores the text.

Defined results: a null text is empty; a null or unknown role is written as it is and
makes the conversation invalid from there; a null conv_id or turn sorts first;
turns that repeat a number follow in the order of role and text; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scratch

START, INVALID = "<start>", "<invalid>"


@dataclass(frozen=True)
class Template:
    """Role headings, which roles' texts bear loss, and the roles that may follow each state."""

    opening: str = "### {role}: "
    closing: str = "</turn>\n"
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    ends: frozenset[str] = frozenset({"assistant"})
    controls: tuple[str, ...] = ("###", "</turn>")
    escape: str = "\\"

    def heading(self, role: str) -> str:
        """A declared role with a capital; any other one, quoted, after an @."""
        return role.capitalize() if role in self.states else "@" + quote(role, safe="")

    def role(self, heading: str) -> str:
        return unquote(heading[1:]) if heading[:1] == "@" else heading.lower()

    def prefix(self, role: str) -> str:
        return self.opening.format(role=self.heading(role))

    @property
    def turn(self) -> re.Pattern:
        """A formatted turn: heading and escaped text."""
        return re.compile(re.escape(self.opening).replace(re.escape("{role}"), "([^:]*)")
                          + "(.*)" + re.escape(self.closing), re.S)

    def escaped(self, text: str) -> str:
        """``text`` without any control string."""
        breaks = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in self.controls)
        return re.sub(f"{re.escape(self.escape)}|{breaks}",
                      lambda m: 2 * self.escape if m[0] == self.escape else m[0] + self.escape, text)

    def unescaped(self, text: str) -> str:
        e = re.escape(self.escape)
        return re.sub(f"{e}({e})?", lambda m: m[1] or "", text)

    def step(self, state: str, role: str | None) -> str:
        return role if role in self.follows.get(state, ()) else INVALID

    @property
    def states(self) -> list[str]:
        return sorted({START, INVALID, *self.follows, *(r for x in self.follows.values() for r in x)})


TEMPLATE = Template()

_ORDER = ["conv_id", "turn", "role", "text"]
_SEGMENTS = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("conv_id", pa.int64()), ("turn", pa.int64()),
                       ("role", pa.string()), ("kind", pa.string()), ("text", pa.string()), ("loss", pa.bool_()),
                       ("state", pa.string())])
_DDL = ("part int, row long, conv_id long, turn long, role string, kind string, text string, "
        "loss boolean, state string")
_KINDS = ("prefix", "text", "suffix")


def _ordered(turns: DataFrame) -> DataFrame:
    """The turns in order, written once, with their part."""
    order = [F.col(c).asc_nulls_first() for c in _ORDER]
    rows = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                         "role", F.coalesce("text", F.lit("")).alias("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for b in batches:
            n = len(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), *b.columns],
                names=["part", "row", *_ORDER])
            row += n

    return scratch.materialise(
        rows.mapInArrow(number, "part int, row long, conv_id long, turn long, role string, text string"), "turns")


def _edges(ordered: DataFrame, template: Template) -> list:
    """For each part its first and last conversation and the state that each state leads to in them."""
    states = template.states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, seen, moved = None, None, 0, dict(zip(states, states, strict=True))
        out = []

        def close() -> None:
            if seen:
                edge = (part, seen, conv, [moved[s] for s in states])
                out[1 if out else 0:] = [edge]

        for b in batches:
            for p, c, role in zip(*(b.column(k).to_pylist() for k in ("part", "conv_id", "role")), strict=True):
                if not seen or c != conv:
                    close()
                    part, conv, seen, moved = p, c, seen + 1, dict(zip(states, states, strict=True))
                moved = {s: template.step(t, role) for s, t in moved.items()}
        close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 4,
                                            (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string())), strict=True)],
            names=["part", "nth", "conv_id", "moved"])

    # A written file may hold several input splits; a window in file order would differ, so parts meet whole.
    rows = ordered.select("part", "row", "conv_id", "role").repartition("part").sortWithinPartitions("part", "row")
    per_part = rows.mapInArrow(_by_part(run), "part int, nth long, conv_id long, moved array<string>")
    return per_part.orderBy("part", "nth").collect()  # bounded: two rows for each part


def _by_part(run):
    """Apply ``run`` to the batches of each part in turn; the input is sorted by part."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = iter(batches)
        held: list[pa.RecordBatch] = []

        def cut(b: pa.RecordBatch) -> list[pa.RecordBatch]:
            parts = b.column("part").to_numpy()
            ends = [*(i for i in range(1, len(parts)) if parts[i] != parts[i - 1]), len(parts)]
            return [b.slice(a, e - a) for a, e in zip([0, *ends], ends, strict=False) if e > a]

        def one(first: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            part = first.column("part")[0].as_py()
            yield first
            while True:
                if not held:
                    b = next(rest, None)
                    if b is None:
                        return
                    held.extend(cut(b))
                    continue
                if held[0].column("part")[0].as_py() != part:
                    return
                yield held.pop(0)

        while True:
            if not held:
                b = next(rest, None)
                if b is None:
                    return
                held.extend(cut(b))
                continue
            yield from run(one(held.pop(0)))

    return split


def segments(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """Three rows for each turn: part, row, conv_id, turn, role, kind, text, loss and the machine's
    state after it; rows with kind ``text`` hold the escaped text."""
    ordered = _ordered(turns)
    entered: dict[int, tuple[int | None, str]] = {}
    conv, state, first = None, START, True
    for edge in _edges(ordered, template):
        if edge["nth"] == 1:
            entered[edge["part"]] = (edge["conv_id"], state if not first and edge["conv_id"] == conv else START)
        same = not first and edge["conv_id"] == conv
        state = dict(zip(template.states, edge["moved"], strict=True))[state if same else START]
        conv, first = edge["conv_id"], False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, begun = None, START, False
        for b in batches:
            columns: list[list] = [[] for _ in _SEGMENTS]
            for part, row, c, turn, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not begun:
                    (conv, state), begun = entered[part], True
                if c != conv:
                    conv, state = c, START
                state = template.step(state, role)
                texts = (template.prefix(role or ""), template.escaped(text), template.closing)
                for kind, t in zip(_KINDS, texts, strict=True):
                    for column, v in zip(columns, (part, row, c, turn, role, kind, t,
                                                   kind == "text" and role in template.loss, state), strict=True):
                        column.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _SEGMENTS.types, strict=True)], schema=_SEGMENTS)

    rows = (ordered.select("part", "row", *_ORDER).repartition("part").sortWithinPartitions("part", "row"))
    return rows.mapInArrow(_by_part(run), _DDL)


def read_turns(pieces: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """The turns read back from formatted segments, one row per conversation: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars, valid.

    Texts pass as a stream, a segment at a time; a digest over a conversation is a sequence
    by its nature, so its conversation meets in one task, which holds only the running hash.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("valid", pa.bool_())])
    pattern = template.turn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        conv, begun, n, loss, chars, ok, state, turn = None, False, 0, 0, 0, True, START, ""
        whole, masked = hashlib.sha256(), hashlib.sha256()

        def close() -> None:
            if begun:
                out.append((conv, n, whole.hexdigest(), loss, masked.hexdigest(), chars, ok and state in template.ends))

        for b in batches:
            for c, kind, text, flag, after in zip(*(b.column(k).to_pylist() for k in
                                                    ("conv_id", "kind", "text", "loss", "state")), strict=True):
                if not begun or c != conv:
                    close()
                    conv, begun, n, loss, chars, ok = c, True, 0, 0, 0, True
                    whole, masked = hashlib.sha256(), hashlib.sha256()
                chars += len(text)
                state, ok = after, ok and after != INVALID
                turn = text if kind == "prefix" else turn + text
                if kind == "suffix":
                    heading, body = pattern.fullmatch(turn).groups()
                    whole.update(f"{template.role(heading)}\n{template.unescaped(body)}\n".encode())
                    n += 1
                if flag:
                    plain = template.unescaped(text)
                    masked.update(plain.encode())
                    loss += len(plain)
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)

    kinds = F.element_at(F.create_map(*[F.lit(x) for p in zip(_KINDS, range(3), strict=True) for x in p]), F.col("kind"))
    rows = (pieces.select("conv_id", "part", "row", kinds.alias("nth"), "kind", "text", "loss", "state")
            .repartition("conv_id").sortWithinPartitions("conv_id", "part", "row", "nth"))
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, valid boolean")
