"""Chat formatting with spans found by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string.
Conversations are streamed in turn order.  For each turn the template renders the
turns so far and the turns so far with the new one; what the second output adds
to the first is the span of the turn, and its offsets lie in the second output.  If the
second does not begin with the first, the template rewrote history: the turn is
flagged, and the span is what follows the common beginning.

Prefixes are whole by default, so rendering costs the square of a conversation's turns.  A
caller who knows that a template adds each turn independently of all but the last few may
give a ``window``: a turn is then rendered after the last ``window`` turns only, and at the end of each
conversation longer than that the joined spans are compared with one whole rendering; where
they differ its last turn is flagged.

The template of this module marks every turn and escapes control strings inside
roles and texts, so the turns can be read back from the output alone.

Defined cases: null text is empty; a null role is marked as absent and reads as
empty; turns with the same number are ordered by role, then text, nulls first;
rows without conv_id are one conversation; ``read_back`` refuses spans of other templates.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, TURN, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = (BEGIN, TURN, BODY, END)
SPANS = "conv_id bigint, span string, start bigint, stop bigint, rewrites boolean"

Template = Callable[[list[tuple]], str]

_CONTROL = re.compile("|".join(re.escape(x) for x in CONTROLS))
_ESCAPED = re.compile(r"\\(\\|-)")


def escape(text: str) -> str:
    """Doubles backslashes and breaks control strings after their first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\-" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1].replace("-", ""), text)


def instruct_template(turns: list[tuple]) -> str:
    """``<s>``, then per turn ``[INST]role[/INST]text</s>``."""
    return BEGIN + "".join(f"{TURN}{escape(role or '')}{BODY}{escape(text or '')}{END}" for role, text in turns)


_TURN = re.compile(
    f"(?:{re.escape(BEGIN)})?{re.escape(TURN)}(.*?){re.escape(BODY)}(.*?){re.escape(END)}", re.DOTALL
)


def parse_span(span: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    found = _TURN.fullmatch(span)
    if found is None:
        raise ValueError(f"not a turn of this module's template: {span[:80]!r}")
    return unescape(found[1]), unescape(found[2])


def _shared(before: str, after: str) -> int:
    """Length of the common beginning."""
    if after.startswith(before):
        return len(before)
    low, high = 0, min(len(before), len(after))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if before[:middle] == after[:middle] else (low, middle - 1)
    return low


class _Conversation:
    """One conversation's rendering so far.  With a window, ``whole`` holds all turns for the last check."""

    def __init__(self, template: Template, window: int | None):
        self.template, self.window = template, window
        self.turns: list[tuple] = []
        self.whole: list[tuple] = []
        self.spans: list[str] = []
        self.before, self.moved = "", 0  # the last rendering, and how much of the conversation precedes it

    def add(self, turn: tuple) -> tuple[str, int, int, bool]:
        """Span, start, stop, and whether history was rewritten."""
        if self.window is not None:
            self.whole.append(turn)
            if len(self.turns) > self.window:
                self.turns = self.turns[-self.window :]
                shorter = self.template(self.turns)
                self.moved += len(self.before) - len(shorter)
                self.before = shorter
        self.turns.append(turn)
        after = self.template(self.turns)
        shared = _shared(self.before, after)
        rewrites = shared < len(self.before)
        self.before = after
        if self.window is not None:
            self.spans.append(after[shared:])
        return after[shared:], self.moved + shared, self.moved + len(after), rewrites

    def differs(self) -> bool:
        """Whether windows hid something that one whole rendering shows."""
        return len(self.whole) > (self.window or 0) + 1 and self.template(self.whole) != "".join(self.spans)


def _render(template: Template, window: int | None):
    names = ["conv_id", "span", "start", "stop", "rewrites"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, last = (), None, None  # the last row waits for the end of its conversation
        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "role", "text")]
            for conv, role, text in zip(*columns, strict=True):
                if (conv,) != current:
                    if last is not None:
                        out.append((*last[:4], last[4] or state.differs()))
                    current, state, last = (conv,), _Conversation(template, window), None
                if last is not None:
                    out.append(last)
                last = (conv, *state.add((role, text)))
            yield rows(out)
        if last is not None:
            yield rows([(*last[:4], last[4] or state.differs())])

    return run


def formatted_turns(conversations: DataFrame, template: Template = instruct_template, window: int | None = None) -> DataFrame:
    """A row per turn, in order inside each partition: its piece of the formatted conversation, where
    it lies in the rendering that ends with it, and whether history was rewritten."""
    order = ["conv_id", "turn", "role", "text"]
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_render(template, window), SPANS)


def _read_back(trained_role: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        current, state = (), None

        def row() -> tuple:
            return (current[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        def rows(out: list) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            out = []
            columns = [batch.column(n).to_pylist() for n in ("conv_id", "span", "stop", "rewrites")]
            for conv, span, stop, rewrites in zip(*columns, strict=True):
                if (conv,) != current:
                    if current:
                        out.append(row())
                    current, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                role, text = parse_span(span)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if role == trained_role:
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4], state[5] = stop, state[5] or rewrites
            if out:
                yield rows(out)
        if current:
            yield rows([row()])

    return run


def read_back(spans: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Per conversation, from its formatted text alone: turns, their digest, the text
    under the loss mask (that of ``trained_role``), and the formatted length.

    ``spans`` must be as ``formatted_turns`` returns them, whole and in order.
    """
    return spans.mapInArrow(
        _read_back(trained_role),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, rewrites boolean",
    )
