"""Chat formatting through a template that is only ever called, never looked into.

A template turns a list of (role, text) into one string. The operator renders successive
prefixes of a conversation and compares each output with the one before: what is new is the
span of the last turn. If an output does not begin with the one before, the template rewrites
history; the row is closed with the older output, which the older turns' spans refer to, and
a new row goes on with the output of the longer prefix. Where the text stands within a turn's
span is found by rendering two other one-letter texts in its place: what these outputs have
in common before and after the letter is the template's.

Conversations are streamed in order (sorted by conversation and turn, one partition each), so
a task holds one part of one conversation: up to ``PART_TURNS`` turns or ``PART_CHARS``
characters. A longer conversation goes on in further rows, each rendered after all turns
before it, so that neither texts nor rewrites depend on where rows end. A template that sets
``by_turn`` says that its output is that of each turn alone, joined; its rows are rendered by
themselves. Any other is called with the whole conversation so far, which the task holds.

``Marked`` is the built-in template. Its control strings inside roles and texts get a
backslash, so that they cannot end or begin a turn, and ``parse`` takes it off again.

Defined cases: a null role or text is empty; turns are ordered by number, role and text,
nulls first, so ties and repeated rows have one order; rows without a conversation id form one
conversation; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procrisk.llm.common import narrow, reachable

Message = tuple[str, str]
Template = Callable[[list[Message]], str]

PART_TURNS = 64
PART_CHARS = 1 << 20

FORMATTED = (
    "conv_id long, part int, first_turn int, formatted string, rewrites boolean, "
    "roles array<string>, spans array<struct<start int, end int, text_start int, text_end int, altered boolean>>"
)


@dataclass(frozen=True)
class Marked:
    """``### role: text</turn>`` and a line end per turn."""

    by_turn = True
    opening: str = "### "
    middle: str = ": "
    closing: str = "</turn>\n"
    #: What a text must not contain as it is; the backslash that hides the others included.
    control: re.Pattern = re.compile(r"\\|</turn>|###")
    in_role: re.Pattern = re.compile(r"\\|</turn>|###|:")
    hidden: re.Pattern = re.compile(r"\\(\\|</turn>|###|:)")
    turn: re.Pattern = re.compile(r"### ((?:[^\\:]+|\\.)*): ((?:[^\\<]+|\\[\s\S]|<(?!/turn>))*)</turn>\n")

    def __call__(self, messages: list[Message]) -> str:
        return "".join(
            f"{self.opening}{self.escape(role, True)}{self.middle}{self.escape(text)}{self.closing}"
            for role, text in messages
        )

    def escape(self, text: str, role: bool = False) -> str:
        return (self.in_role if role else self.control).sub(r"\\\g<0>", text)

    def unescape(self, text: str) -> str:
        return self.hidden.sub(r"\1", text)

    def parse(self, formatted: str) -> Iterator[Message]:
        """The turns of a formatted text."""
        at = 0
        for found in self.turn.finditer(formatted):
            if found.start() != at:
                break
            at = found.end()
            yield self.unescape(found[1]), self.unescape(found[2])
        if at != len(formatted):
            raise ValueError(f"no turn begins at {at}")


def common_prefix(a: str, b: str) -> int:
    """Characters that both begin with, found by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[low:half] == b[low:half] else (low, half - 1)
    return low


@dataclass
class Part:
    """Rendering of some turns in a row, after ``before`` them, whose output is ``lead``."""

    template: Template
    before: list[Message] = field(default_factory=list)
    lead: str = ""
    messages: list[Message] = field(default_factory=list)
    output: str = ""
    spans: list[tuple] = field(default_factory=list)
    rewritten: bool = False

    def with_turn(self, message: Message, full: bool = False) -> Part | None:
        """Adds a turn, or returns the part that must go on because this one is ``full`` or its
        history was rewritten."""
        if full and getattr(self.template, "by_turn", False):
            after = Part(self.template)
            after.with_turn(message)
            return after
        longer = [*self.before, *self.messages, message]
        output = self.template(longer)
        begin = common_prefix(self.output, output)
        self.rewritten = begin < len(self.output)
        if full or self.rewritten:
            after = Part(self.template, longer[:-1], output[:begin], [message], output)
            after._locate(longer, output, begin)
            return after
        self.messages.append(message)
        self._locate(longer, output, begin)
        self.output = output
        return None

    def _locate(self, messages: list[Message], output: str, begin: int) -> None:
        role, text = messages[-1]
        one, two = (self.template([*messages[:-1], (role, probe)]) for probe in "ab")
        head = common_prefix(one, two)
        tail = len(one) - head - 1
        # A template may drop or change a text, or render none.
        placed = len(one) == len(two) and one[head : head + 1] == "a" and two[head : head + 1] == "b"
        placed = placed and head + tail <= len(output) and one[:head] == output[:head]
        placed = placed and one[head + 1 :] == output[len(output) - tail :]
        start, end = (head, len(output) - tail) if placed else (len(output), len(output))
        self.spans.append((begin, len(output), start, end, not placed))

    def row(self, conv_id, part: int, first: int) -> tuple:
        """Spans count from the beginning of the part's own text."""
        cut = len(self.lead)
        spans = [(a - cut, b - cut, c - cut, d - cut, altered) for a, b, c, d, altered in self.spans]
        roles = [role for role, _ in self.messages]
        return conv_id, part, first, self.output[cut:], self.rewritten, roles, spans


def render(
    conv_id, messages: Iterable[Message], template: Template, part_turns: int = PART_TURNS
) -> Iterator[tuple]:
    """Rows of ``FORMATTED`` of one conversation."""
    number, first, count, part = 0, 0, 0, Part(template)
    for message in messages:
        full = len(part.messages) >= part_turns or len(part.output) - len(part.lead) >= PART_CHARS
        after = part.with_turn(message, full)
        if after is not None:
            yield part.row(conv_id, number, first)
            number, first, part = number + 1, count, after
        count += 1
    if part.messages:
        yield part.row(conv_id, number, first)


def format_conversations(
    conversations: DataFrame, template: Template | None = None, part_turns: int = PART_TURNS
) -> DataFrame:
    """conv_id, part and formatted text of every conversation, its turns' roles, their spans
    and those of their texts; ``rewrites`` tells that the next turn changed this output."""
    reachable(conversations.sparkSession)
    template = template or Marked()
    names = ["conv_id", "part", "first_turn", "formatted", "rewrites", "roles", "spans"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def turns() -> Iterator[tuple]:
            for frame in frames:
                yield from zip(frame["known"], frame["conv"], frame["role"], frame["text"], strict=True)

        rows, size, stream = [], 0, turns()
        for key, messages in _runs(stream):
            for row in render(None if key[0] == 0 else key[1], messages, template, part_turns):
                rows.append(row)
                size += len(row[3])
                if size >= PART_CHARS:
                    yield _table(rows, names)
                    rows, size = [], 0
        yield _table(rows, names)

    # Ids travel without nulls, which would turn them into inexact floats.
    sent = narrow(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").isNotNull().cast("int").alias("known"),
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["known", "conv"]
    in_order = sent.repartition(*keys).sortWithinPartitions(*keys, "turn", "role", "text")
    return in_order.drop("turn").mapInPandas(run, FORMATTED)


def _table(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    """A frame whose ids stay integers beside a null."""
    out = pd.DataFrame([row[1:] for row in rows], columns=names[1:])
    out.insert(0, names[0], pd.array([row[0] for row in rows], dtype="Int64"))
    return out


def _runs(stream: Iterator[tuple]) -> Iterator[tuple]:
    """Keys with the messages of their rows, which are read from the stream one by one."""
    held = next(stream, None)

    def of(key: tuple) -> Iterator[Message]:
        nonlocal held
        while held is not None and (held[0], held[1]) == key:
            role, text = held[2], held[3]
            held = next(stream, None)
            yield role, text

    while held is not None:
        key = (held[0], held[1])
        yield key, of(key)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame, template: Marked | None = None, loss_role: str = "assistant") -> DataFrame:
    """Per conversation of a formatted table: turns and their digest as parsed from the text,
    and characters and digest of the text under the mask of ``loss_role``."""
    reachable(formatted.sparkSession)
    template = template or Marked()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, state, held = [], None, None
        for frame in frames:
            for key, known, text, roles, spans in zip(
                frame["conv"], frame["known"], frame["formatted"], frame["roles"], frame["spans"], strict=True
            ):
                if (known, key) != held:
                    if held is not None:
                        rows.append(state.row())
                    held, state = (known, key), _Digest(key if known else None)
                state.add(text, template, roles, spans, loss_role)
            yield _digests(rows)
            rows = []
        if held is not None:
            yield _digests([state.row()])

    sent = formatted.select(
        F.col("conv_id").isNotNull().alias("known"),
        F.coalesce("conv_id", F.lit(0)).alias("conv"),
        "part", "formatted", "roles", "spans",
    )
    keys = ["known", "conv"]
    in_order = sent.repartition(*keys).sortWithinPartitions(*keys, "part")
    return in_order.mapInPandas(run, DIGESTS)


def _digests(rows: list[tuple]) -> pd.DataFrame:
    return _table(rows, [f.split()[0] for f in DIGESTS.split(", ")])


class _Digest:
    """Sums over the parts of a conversation, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, template: Marked, roles, spans, loss_role: str) -> None:
        self.chars += len(text)
        for role, said in template.parse(text):
            self.turns += 1
            self.all.update(f"{role}\n{said}\n".encode())
        for role, span in zip(roles, spans, strict=True):
            if role == loss_role:
                said = template.unescape(text[span["text_start"] : span["text_end"]])
                self.loss_chars += len(said)
                self.loss.update(said.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
