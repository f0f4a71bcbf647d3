r"""Chat formatting in budgeted windows.

Template: a turn is ``### role: text </turn>`` and a line end. Inside roles and
texts a backslash precedes every ``\``, ``#`` and ``<`` (and ``:`` in roles),
so neither ``###`` nor ``</turn>`` can occur there and unescaping is exact.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

OPEN, SEP, CLOSE = "### ", ": ", " </turn>\n"
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.)*) </turn>\n", re.S)
_CONTROL = re.compile(r"[\\#<]")
_ROLE_CONTROL = re.compile(r"[\\#<:]")
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> str:
    return f"{OPEN}{_ROLE_CONTROL.sub(r'\\\g<0>', role)}{SEP}{escape(text)}{CLOSE}"


def parse(window: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    turns, at = [], 0
    while at < len(window):
        m = _TURN.match(window, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class _Windows:
    """Turn-aligned spans of one conversation, fed turn by turn.

    ``ends`` holds prefix sums of turn tokens from the oldest turn still
    needed; a span closes where the next sum would pass the budget, and the
    history of the next span is found by searching the sums from its end.
    """

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple[str, str, int] | None = None
        self.turns: list[tuple[str, str]] = []  # (role, formatted): history, then the span
        self.ends = [0]
        self.kept = 0  # turns of history at the front
        self.n = 0

    def _spent(self) -> int:
        return self.ends[-1] + (self.system[2] if self.system and self.n else 0)

    def add(self, role: str, formatted: str, tokens: int) -> Iterator[tuple]:
        first = self.n == 0 and not self.turns
        if len(self.turns) > self.kept and self._spent() + tokens > self.budget:
            yield self.close()
            # repeat the last turns whose tokens fit the history budget
            room = self.budget - tokens - (self.system[2] if self.system else 0)
            floor = self.ends[-1] - min(self.history, max(0, room))
            cut = int(np.searchsorted(self.ends, floor))
            if self.system and cut == 0 and self.n == 1:
                cut = 1  # the system turn is repeated anyway
            self.turns = self.turns[cut:]
            self.ends = [e - self.ends[cut] for e in self.ends[cut:]]
            self.kept = len(self.turns)
        if first and role == "system":
            self.system = (role, formatted, tokens)
        self.turns.append((role, formatted))
        self.ends.append(self.ends[-1] + tokens)

    def close(self) -> tuple:
        """(window, text, turns new, turns repeated, loss spans, tokens, over budget)"""
        parts, at, loss = [], 0, []
        if self.system and self.n:
            parts.append(self.system[1])
            at = len(self.system[1])
        repeated = len(parts) + self.kept
        tokens = self._spent()
        for i, (role, formatted) in enumerate(self.turns):
            parts.append(formatted)
            if i >= self.kept and role == "assistant":  # repeated targets are masked
                start = at + formatted.index(SEP) + len(SEP)
                loss.append({"start": start, "end": at + len(formatted) - len(CLOSE)})
            at += len(formatted)
        out = (self.n, "".join(parts), len(self.turns) - self.kept, repeated, loss, tokens,
               tokens > self.budget)
        self.n += 1
        return out


WINDOWS = ("conv_id long, window int, text string, n_turns int, n_repeated int, "
           "loss array<struct<start:int,end:int>>, n_tokens int, over_budget boolean")


def format_conversations(df: DataFrame, tokenizer_path: str, budget: int = 1024,
                         history: int = 256, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Format conversations as windows of at most ``budget`` tokens.

    A window holds the system turn (the first turn, if its role is system),
    repeated turns of at most ``history`` tokens from the window before, and
    new turns. ``loss`` marks, in code points of ``text``, the escaped text of
    each new assistant turn; repeated ones are masked. Turns are never cut: one
    that cannot fit is a window's only new turn, and ``over_budget`` says so.

    Rows are shuffled by conversation and sorted by (turn, role, text); tasks
    then stream over them, holding one window, so a conversation of any length
    takes bounded memory. Its windows follow one another in one partition: each
    begins where the one before ends. Null text or role: empty. Null
    conversation ids form one conversation. Null turns come first; equal turns
    are ordered by role and text, and repeated rows are repeated turns. Other
    columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _tokenizer(tokenizer_path)
        names = [c.split()[0] for c in ("conv_id", "window", "text", "n_turns", "n_repeated",
                                        "loss", "n_tokens", "over_budget")]
        types = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(),
                 pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int32(),
                 pa.bool_()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        conv, state, out = None, None, []
        for b in batches:
            roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
            shown = [render(r, t) for r, t in zip(roles, texts)]
            sizes = [len(e.ids) for e in count.encode_batch(shown, add_special_tokens=False)]
            for c, role, formatted, n in zip(b.column(0).to_pylist(), roles, shown, sizes):
                if state is None or c != conv:
                    if state is not None:
                        out.append((conv, *state.close()))
                    conv, state = c, _Windows(budget, history)
                for w in state.add(role, formatted, n):
                    out.append((conv, *w))
            if out:
                yield batch(out)
                out = []
        if state is not None:
            yield batch([(conv, *state.close())])

    src = df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return (src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, WINDOWS))


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long, n_windows long")


def read_back(windows: DataFrame) -> DataFrame:
    """Parse formatted windows again: one digest row per conversation, with the
    new turns of its windows in order and the text under the loss mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DIGEST.split(", ")]
        types = [pa.int64() if " long" in c else pa.string() for c in DIGEST.split(", ")]
        conv, seen, rows = None, False, []
        n = chars = loss_chars = wins = 0
        turns = loss = hashlib.sha256()

        def row() -> tuple:
            return conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, wins

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for w in b.to_pylist():
                if not seen or w["conv_id"] != conv:
                    if seen:
                        rows.append(row())
                    conv, seen = w["conv_id"], True
                    n = chars = loss_chars = wins = 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, text in parse(w["text"])[w["n_repeated"]:]:
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                for span in w["loss"]:
                    text = unescape(w["text"][span["start"]:span["end"]])
                    loss.update(text.encode())
                    loss_chars += len(text)
                chars += len(w["text"])
                wins += 1
            if rows:
                yield batch()
                rows = []
        if seen:
            rows.append(row())
            yield batch()

    return windows.select("conv_id", "window", "text", "n_repeated", "loss").mapInArrow(run, DIGEST)


#: The planted conversation of the contract: both turns say the control strings.
PLANTED = r"\### Assistant: </turn> ok"


def chat_query(spark: SparkSession, conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    return read_back(format_conversations(rows.unionByName(planted), tokenizer_path))
