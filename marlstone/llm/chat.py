"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string.
Successive prefixes of a conversation are rendered and consecutive outputs
compared: what is new is the turn's span.  If the earlier output is not a
prefix of the later one, the template rewrites history, and the conversation
is marked so.  The place of a turn's text inside its span is found by two more
renderings with probe texts, which differ from their first character on.

Prefixes and probes are whole, whatever the conversation's length, so its
results never depend on it.  The time grows with the square of the number of
turns (a black box can be asked for a prefix only by rendering it); a task
holds a few copies of one conversation's output.  A caller that knows its
template may bound both with ``whole_chars``: a conversation with a longer
output then streams on with the last ``window`` turns only, and the same turn
must render alike from both starts wherever the window moves, else the
conversation is marked as rewritten.  There, and only there, a template that
rewrites only what is further back is not detected, and one that numbers its
turns is marked wrongly.  The registered query sets no such bound.  (A
conversation's digests are sequential by definition, so it is one task's work.)

Defined results: a null role or text is empty.  Turns are ordered by (turn,
role, text), nulls first; repeated rows are repeated turns.  Rows with a null
conv_id form one conversation.  An empty table gives no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Fixed control strings of the template below.
CONTROLS = ("[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[TEXT]", "<s>", "</s>")
_CONTROL = re.compile("|".join(re.escape(c) for c in (*CONTROLS, "\\")))
_ESCAPED = re.compile(r"\\(\\?)")
WHOLE_CHARS, WINDOW = None, 32  # None: prefixes are always whole
CACHE_CHARS = 1 << 23  # of rendered turns that the template below keeps
BATCH_ROWS, BATCH_CHARS = 2000, 1 << 22


def escape(text: str) -> str:
    """No control string is left; ``unescape`` undoes it.

    A backslash is doubled; a control string gets one after its first character.
    """
    if "[" not in text and "<" not in text and "\\" not in text:
        return text
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _instruct_turn(role: str, text: str) -> str:
    if role == "user":
        return f"[INST] {escape(text)} [/INST]"
    if role == "assistant":
        return f"<s>{escape(text)}</s>"
    return f"[ROLE]{escape(role)}[TEXT]{escape(text)}[/ROLE]"


class _Rendered(dict):
    """Rendered turns by (role, text); emptied where they get too many, which costs only time."""

    chars = 0

    def __missing__(self, turn: Turn) -> str:
        out = _instruct_turn(*turn)
        self.chars += len(out) + 100
        if self.chars > CACHE_CHARS:
            self.clear()
            self.chars = len(out) + 100
        self[turn] = out
        return out


_rendered = _Rendered()


def instruct_template(turns: list[Turn]) -> str:
    return "".join(map(_rendered.__getitem__, turns))


_TURN = re.compile(r"\[INST\] (?P<u>.*?) \[/INST\]|<s>(?P<a>.*?)</s>|\[ROLE\](?P<r>.*?)\[TEXT\](?P<t>.*?)\[/ROLE\]", re.S)


def parse_instruct(formatted: str) -> list[Turn]:
    """The turns, read back from the output of ``instruct_template``."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at character {at}")
        if m["u"] is not None:
            turns.append(("user", unescape(m["u"])))
        elif m["a"] is not None:
            turns.append(("assistant", unescape(m["a"])))
        else:
            turns.append((unescape(m["r"]), unescape(m["t"])))
        at = m.end()
    return turns


def _common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Renderer:
    """Feeds the turns of one conversation to a template, one by one."""

    def __init__(self, template: Template, whole_chars: int | None = WHOLE_CHARS, window: int = WINDOW):
        self.template, self.whole_chars, self.window = template, whole_chars, max(2, window)
        self.turns: list[Turn] = []
        self.out = ""  # the rendering of self.turns
        self.before = 0  # characters of the output before self.turns
        self.rewrites = False

    def _move(self) -> None:
        keep = self.turns[-(self.window // 2) :]
        moved = self.template(keep)
        last, before = self.template(self.turns[:-1]), self.template(keep[:-1])
        self.rewrites |= not moved.startswith(before) or self.out[len(last) :] != moved[len(before) :]
        self.before += len(self.out) - len(moved)
        self.turns, self.out = keep, moved

    def _text_in(self, span: str, begun: int, role: str) -> tuple[int, int] | None:
        """Where the text stands in the span, which begins there, by two probes after the same turns."""
        a, b = (self.template([*self.turns, (role, p)])[begun:] for p in ("0", "1"))
        head = _common_prefix(a, b)
        tail = _common_prefix(a[head:][::-1], b[head:][::-1])
        ok = head + tail <= len(span) and span[:head] == a[:head] and (not tail or span[len(span) - tail :] == a[len(a) - tail :])
        return (head, len(span) - tail) if ok else None

    def add(self, role: str, text: str) -> tuple[str, int, int, int]:
        """The turn's span, where it starts in the output so far, and where its text starts and ends in the span (-1: not found)."""
        if self.whole_chars is not None and len(self.out) > self.whole_chars and len(self.turns) >= self.window:
            self._move()
        now = self.template([*self.turns, (role, text)])
        same = _common_prefix(self.out, now)
        self.rewrites |= same < len(self.out)
        span = now[same:]
        a, b = self._text_in(span, same, role) or (-1, -1)
        self.turns.append((role, text))
        self.out = now
        return span, self.before + same, a, b


SPANS = "conv_id long, turn_no long, role string, span string, span_start long, text_start long, text_end long, loss boolean, rewrites boolean, last boolean"


def render_turns(conversations: DataFrame, template: Template = instruct_template, whole_chars: int | None = WHOLE_CHARS, window: int = WINDOW, loss_role: str = "assistant") -> DataFrame:
    """One row a turn: its span of the formatted text, and where in the span its text lies.

    ``conv_id``; ``turn_no`` from 0; ``span`` (unless history is rewritten, the
    spans of a conversation in order are its formatted text); ``span_start``:
    where the span begins in the rendering up to this turn; ``text_start`` and
    ``text_end`` inside the span; ``loss``: the text counts for the loss;
    ``rewrites``: the template has rewritten history so far; ``last``: it is
    the conversation's last turn.  Rows stay sorted inside their partition.
    """
    rows = common.pick(conversations, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    @common.trims
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, renderer, held, out, number, size = None, None, None, [], 0, 0

        def flush(rows):
            cols = list(zip(*rows)) if rows else [[] for _ in range(10)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
            names = [x.split()[0] for x in SPANS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=names)

        for batch in batches:
            for c, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                if renderer is None or c != conv:
                    if held:
                        out.append((*held, True))
                        held = None
                    conv, renderer, number = c, Renderer(template, whole_chars, window), 0
                if held:
                    out.append((*held, False))
                role, text = role or "", text or ""
                span, start, a, b = renderer.add(role, text)
                held = (c, number, role, span, start, a, b, role == loss_role and a >= 0, renderer.rewrites)
                number += 1
                size += len(span)
                if len(out) >= BATCH_ROWS or size >= BATCH_CHARS:
                    yield flush(out)
                    out, size = [], 0
        if held:
            out.append((*held, True))
        if out:
            yield flush(out)

    return rows.mapInArrow(run, SPANS)
