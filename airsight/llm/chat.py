"""Chat formatting in budgeted, turn-aligned windows with reversible escapes and a loss mask."""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsight.llm.common import whole

#: Tokens of a window, and of the history that it repeats, at most.
BUDGET, HISTORY = 1024, 192
#: Tokens of a turn's marks.
TURN_TOKENS = 4

# The template's marks, and the control strings of common templates that a text must not contain.
OPEN, CLOSE = "<|turn|>", "<|end|>\n"
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<unk>", "<pad>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>"]

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Double backslashes, and put one behind the first character of every control string."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def turn_tokens(text: Column) -> Column:
    """Words and marks of a text: the default token count, made before texts are moved."""
    return F.regexp_count(whole(text), F.lit(r"\w+|[^\w\s]")).cast("long") + TURN_TOKENS


Turn = tuple[str, str, int]  # role, text, tokens


@dataclass
class _Conversation:
    """The windows of one conversation, turn by turn. It holds the system turns, the history and the open window."""

    conv_id: int | None
    budget: int
    history: int
    system: list[Turn] = field(default_factory=list)
    open: list[Turn] = field(default_factory=list)
    past: deque[Turn] = field(default_factory=deque)
    repeated: int = 0
    windows: int = 0
    turns: int = 0
    head: bool = True  # only system turns so far
    used: int = 0  # prefix sum of tokens from the window's first turn on

    def add(self, turn: Turn) -> dict | None:
        """Take the next turn; the window that it closes, if it does not fit any more."""
        done = None
        if self.head and turn[0] == "system":
            self.system.append(turn)
        else:
            self.head = False
            if len(self.open) > self.repeated and self.used + turn[2] > self.budget:
                done = self.close()
                self.begin(turn[2])
        self.open.append(turn)
        self.used += turn[2]
        return done

    def begin(self, coming: int) -> None:
        """A new window: the system turns, then as many of the last turns as both limits allow with the turn to come."""
        room = min(self.history, self.budget - sum(t[2] for t in self.system) - coming)
        total = sum(t[2] for t in self.past)
        while self.past and total > room:
            total -= self.past.popleft()[2]
        self.open = [*self.system, *self.past]
        self.repeated = len(self.open)
        self.used = sum(t[2] for t in self.open)

    def close(self) -> dict:
        parts, spans, at = [], [], 0
        for i, (role, text, _) in enumerate(self.open):
            head, body = f"{OPEN}{escape_role(role)}\n", escape(text)
            if role == "assistant" and i >= self.repeated:
                spans.append({"start": at + len(head), "stop": at + len(head) + len(body)})
            parts += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        new = self.open[self.repeated :]
        out = {
            "conv_id": self.conv_id, "window": self.windows, "first_turn": self.turns, "n_turns": len(new), "repeated": self.repeated,
            "n_tokens": self.used, "text": "".join(parts), "loss": spans,
        }
        self.windows += 1
        self.turns += len(new)
        self.past.extend(t for i, t in enumerate(new) if self.windows > 1 or i >= len(self.system))
        total = sum(t[2] for t in self.past)
        while self.past and total > self.history:
            total -= self.past.popleft()[2]
        return out


WINDOW_SCHEMA = "conv_id long, window int, first_turn long, n_turns int, repeated int, n_tokens long, text string, loss array<struct<start:int,stop:int>>"
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int32()), ("first_turn", pa.int64()), ("n_turns", pa.int32()), ("repeated", pa.int32()), ("n_tokens", pa.int64()),
    ("text", pa.string()), ("loss", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
])


def _windows(budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            out = []
            for conv_id, role, text, tokens in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens"))):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.close())
                    now = _Conversation(conv_id, budget, history)
                closed = now.add((role, text, tokens))
                if closed:
                    out.append(closed)
            if out:
                yield pa.RecordBatch.from_pylist(out, _ARROW)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.close()], _ARROW)

    return run


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """Windows of conversations: conv_id, window, first_turn, n_turns, repeated, n_tokens, text, loss.

    ``turns`` has conv_id, turn, role and text. Running sums of turn tokens (``tokens``, else ``turn_tokens``) choose the windows: each takes
    the next whole turns that fit into ``budget``, and at least one. From the second on a window begins with the conversation's leading
    system turns and with as many of the turns before it as fit into ``history`` tokens and leave room for the next turn; these are the
    ``repeated`` turns. A turn over the budget, or one that a long system turn leaves no room for, has a window of its own that exceeds it.

    ``text`` marks every turn and escapes control strings in roles and texts reversibly. ``loss`` has the code point spans of the texts of
    assistant turns that are not repeated, so every assistant text is a target exactly once.

    Conversations are dealt out by id and sorted on disk if need be; a task holds one window, one history and the system turns, however
    long a conversation is. A null id is a conversation of its own, null roles and texts are empty, and turns with equal numbers are
    ordered by role and text. Repeated rows are turns each. No rows give no rows. Other columns are ignored.
    """
    text = whole(F.col("text"))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), whole(F.col("role")).alias("role"), text.alias("text"),
        (turn_tokens(F.col("text")) if tokens is None else tokens).alias("tokens"),
    )
    together = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return together.mapInArrow(_windows(budget, history), WINDOW_SCHEMA)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window; the inverse of the template."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError(f"no turn begins at {at}")
        line = text.index("\n", at)
        end = text.index(CLOSE, line)
        out.append((unescape(text[at + len(OPEN) : line]), unescape(text[line + 1 : end])))
        at = end + len(CLOSE)
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    now, seen, turns, loss, numbers = None, False, None, None, [0, 0, 0, 0]

    def row() -> tuple:
        return now, numbers[0], turns.hexdigest(), numbers[1], loss.hexdigest(), numbers[2], numbers[3]

    for batch in batches:
        out = []
        for conv_id, repeated, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "repeated", "text", "loss"))):
            if not seen or conv_id != now:
                if seen:
                    out.append(row())
                now, seen, turns, loss, numbers = conv_id, True, hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0]
            for role, body in parse(text)[repeated:]:
                turns.update(f"{role}\n{body}\n".encode())
                numbers[0] += 1
            for span in spans:
                target = unescape(text[span["start"] : span["stop"]])
                loss.update(target.encode())
                numbers[1] += len(target)
            numbers[2] += len(text)
            numbers[3] += 1
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(), kinds)], names=names)


def read_back(windows: DataFrame, together: bool = False) -> DataFrame:
    """Per conversation what its windows hold: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows.

    Turns are parsed from the texts and unescaped, without the repeated ones; targets are cut out by the mask. Digests run over a conversation in order,
    one window in memory. ``together`` says that each conversation's windows follow one another in a partition, as
    ``format_conversations`` leaves them; otherwise they are shuffled and sorted first.
    """
    if not together:
        windows = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    return windows.mapInArrow(_digests, kinds)
