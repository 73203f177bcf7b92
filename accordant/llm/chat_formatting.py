"""Chat formatting: conversations as budgeted, turn-aligned training windows.

Prefix sums of turn tokens choose the spans by bisection: a window takes new turns while they fit the
budget, opens with the system turn, and repeats the latest turns before its span as history as far as a
share of the budget allows. Assistant turns are targets; repeated ones are masked, so each is under
the loss once. The template marks turns with control strings, and control strings inside roles and texts
are broken by an escape that `read_windows` undoes.

One shuffle by conversation and a sort by turn; after that a partition is one stream of turns, and
memory holds the system turn, the history and some windows' turns, however long a conversation is.

Defined results: a null text or role is empty; rows of one turn number, and repeated rows, are turns
of their own in order of turn (nulls first), role, text; rows with a null conversation id form one
conversation of their own, whatever ids stand beside it; a turn larger than the budget is a window of its
own, never cut; an empty table gives no windows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .best_fit_packing import load
from .common import id_columns

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that a tokenizer may read as control, whether this template uses them or not.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_ESCAPED = re.compile(r"\\(\\?)")
_ESCAPED_ROLE = re.compile(r"\\([\\n]?)")
_TURN = re.compile(rf"{re.escape(START)}([^\n]*)\n(.*?){re.escape(END)}\n", re.DOTALL)

WINDOW_SCHEMA = "conv_id long, window long, text string, n_repeated int, loss_starts array<int>, loss_ends array<int>, n_tokens long"
#: Tokens of a window, and the share of them that repeated history may take.
BUDGET, HISTORY = 2048, 0.25
#: Windows' worth of tokens that are held of a conversation before windows are made.
HELD = 16


def escape(text: str) -> str:
    """Double backslashes, then part the first character of each control string from its rest by one."""
    return _CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    """A role stands in one line: a line break is a backslash and n, which no escape above gives."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED_ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's markup, and where its text stands in it."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def count_bytes(marked: str) -> int:
    """An upper bound of a byte-level tokenizer's tokens, where none is named."""
    return max(1, len(marked.encode("utf-8", "surrogatepass")))


def tokens_of(path: str) -> Callable[[str], int]:
    """Counts by the byte-level tokenizer at `path`. A turn's markup ends in a line break, so turns' counts add up to the window's."""

    def count(marked: str) -> int:
        return len(load(path).encode([marked])[0]) // 4

    return count


def span(before: np.ndarray, i: int, budget: int, history: int, system: int, earliest: int) -> tuple[int, int, bool]:
    """(first history turn, end, whether the system turn is kept) of the window whose first new turn is i.

    `before` are the prefix sums of turn tokens: before[n] is the sum of the turns before n. `system` is
    the system turn's size, 0 where there is none to repeat; history starts at `earliest` at the earliest.
    """
    own = int(before[i + 1] - before[i])
    kept = bool(system) and system + own <= budget
    room = budget - own - (system if kept else 0)
    past = max(0, min(history, room))
    low = min(i, max(earliest, int(np.searchsorted(before, before[i] - past, side="left"))))
    room -= int(before[i] - before[low])
    end = max(i + 1, int(np.searchsorted(before, before[i + 1] + room, side="right")) - 1)
    return low, end, kept


class _Conversation:
    """The windows of one conversation, from its turns in order; of them it holds the history and about HELD windows."""

    def __init__(self, conv_id, budget: int, history: int, tokens: Callable[[str], int]):
        self.id, self.budget, self.most, self.tokens = conv_id, budget, history, tokens
        self.turns: list[tuple] = []
        self.system, self.seen, self.made, self.at, self.held, self.earliest = None, 0, 0, 0, 0, 0

    def add(self, role: str, text: str) -> Iterator[tuple]:
        marked, a, b = render(role, text)
        turn = (marked, a, b, role == "assistant", self.tokens(marked))
        if not self.seen and role == "system":
            self.system, self.earliest = turn, 1  # repeated as such, not as history
        self.seen += 1
        self.turns.append(turn)
        self.held += turn[4]
        if self.held > HELD * self.budget:
            yield from self.flush(False)

    def flush(self, last: bool) -> Iterator[tuple]:
        """The windows whose end is known; with `last`, all that are left."""
        before = np.concatenate(([0], np.cumsum([t[4] for t in self.turns], dtype=np.int64)))
        while self.at < len(self.turns):
            low, end, kept = span(before, self.at, self.budget, self.most if self.made else 0, self.system[4] if self.made and self.system else 0, self.earliest)
            if end == len(self.turns) and not last:
                break  # the next turn may fit, too
            yield self.window([self.system] * kept + self.turns[low : self.at], self.turns[self.at : end])
            self.at = end
        drop = max(0, min(self.at, int(np.searchsorted(before, before[self.at] - self.most, side="left"))))
        self.turns, self.at, self.earliest = self.turns[drop:], self.at - drop, max(0, self.earliest - drop)
        self.held = int(before[-1] - before[drop])

    def window(self, repeated: list[tuple], new: list[tuple]) -> tuple:
        parts, starts, ends, at = [], [], [], 0
        for n, (marked, a, b, target, _) in enumerate(repeated + new):
            if target and n >= len(repeated):
                starts.append(at + a)
                ends.append(at + b)
            parts.append(marked)
            at += len(marked)
        self.made += 1
        return (self.id, self.made - 1, "".join(parts), len(repeated), starts, ends, sum(t[4] for t in repeated + new))


def _ids(batch: pd.DataFrame) -> list:
    return [None if null else i for i, null in zip(batch["conv_id"].tolist(), batch["conv_id_null"].tolist())]


def format_conversations(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", budget: int = BUDGET, history: float = HISTORY, tokens: Callable[[str], int] = count_bytes) -> DataFrame:
    """Windows (WINDOW_SCHEMA). Those of a conversation stand together and in order in one partition."""
    rows = turns.select(*id_columns(key, "conv_id"), F.col(f"`{order}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "conv_id_null", "turn", "role", "text")
    names = [x.split()[0] for x in WINDOW_SCHEMA.split(", ")]
    most = int(budget * history)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            out = []
            for conv, r, t in zip(_ids(batch), batch["role"], batch["text"]):
                if now is None or now.id != conv:
                    if now is not None:
                        out += now.flush(True)
                    now = _Conversation(conv, budget, most, tokens)
                out += now.add(r, t)
            yield _frame(out, names)
        if now is not None:
            yield _frame(list(now.flush(True)), names)

    return rows.select("conv_id", "conv_id_null", "role", "text").mapInPandas(windows, WINDOW_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame([r[1:] for r in rows], columns=names[1:])
    frame.insert(0, names[0], pd.array([r[0] for r in rows], dtype="Int64"))
    return frame


READ_SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_windows(windows: DataFrame) -> DataFrame:
    """What the windows hold, read back from their text and loss spans alone: a row per conversation.

    Digests run over the stream, so a conversation is never held as a whole. The windows must
    come as `format_conversations` leaves them, each conversation's together and in order.
    """
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, state = None, None

        def result():
            turns, all_turns, chars, loss, total = state
            return (conv, turns, all_turns.hexdigest(), chars, loss.hexdigest(), total)

        for batch in batches:
            out = []
            for c, text, repeated, starts, ends in zip(_ids(batch), batch["text"], batch["n_repeated"], batch["loss_starts"], batch["loss_ends"]):
                if state is None or conv != c:
                    if state is not None:
                        out.append(result())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for n, m in enumerate(_TURN.finditer(text)):
                    if n >= repeated:
                        state[0] += 1
                        state[1].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            yield _frame(out, names)
        if state is not None:
            yield _frame([result()], names)

    own = [c for c in windows.columns if c != "conv_id"]
    return windows.select(*id_columns("conv_id", "conv_id"), *own).mapInPandas(read, READ_SCHEMA)
