"""Repair of conversation structure: the cheapest edits that make the roles alternate.

A repaired conversation is empty, or an optional system turn and then user and assistant in turn.
Its rows, in order, are kept (cost 0), given the role that is due (2) or deleted (3, which blank
and repeated rows must be); a due turn without text can be inserted anywhere (2). Each truncated
row that stays adds 1. Of the cheapest edits those count whose initials (D, I, K, R) come first in
ASCII order.

Rows are dealt by conversation and sorted by turn, and each task goes through its Arrow batches
once. There are four states (nothing yet, after system, after user, after assistant); what is carried
from row to row, and from batch to batch, is the cost of reaching each of them. As costs are only
compared, they are kept relative to the least, so there are few different steps, and each is worked
out once. A row leaves behind 16 bits that say which moves into its states were cheapest. At the
end of a conversation one walk back over these finds the states on cheapest paths and leaves 8 bits a
row, the first letter in ASCII order from each state, and a walk forward applies them to the rows.

One conversation is worked off by one task, whatever its length, and in bounded memory: beyond
``BLOCK_ROWS`` rows the moves, beyond ``TEXT_BYTES`` the rows and beyond ``SEEN_ROWS`` the marks of
rows already seen go to files in Spark's own spill folders.

Defined results: a null role or text counts as one space. Rows are ordered by turn, nulls first, then
by role and text. Rows without a conversation are one conversation, with a null conv_id. Very long
texts are taken whole. An empty table gives no rows; only ``conv_id, turn, role, text`` are read,
whatever else is there. conv_ids may be of any type that can be ordered; turns are whole numbers.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from clickflow.llm.common import table

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
DUE = (USER, USER, ASSISTANT, USER)  # the turn that may follow a state, other than a system turn
NAMES = {USER: b"user", ASSISTANT: b"assistant"}
KEPT = {b"s": {START: SYSTEM}, b"u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, b"a": {USER: ASSISTANT}}
LEGAL = {b"su", b"ua", b"au"}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LETTERS = b"DIKR"

BLOCK_ROWS, BLOCKS = 1 << 16, 16
TEXT_BYTES = 16 << 20
SEEN_ROWS = 200_000

SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, " \
          "audit string, repaired_sha256 string"
NEVER = 1 << 20


# --- Steps between states; the letters' bits are at 4 * LETTERS.index(letter) + state --------------------

def _with_inserts(costs: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs once turns were inserted where that is cheaper, and which inserts are cheapest."""
    costs = list(costs)
    for _ in range(2):
        for state, due in enumerate(DUE):
            costs[due] = min(costs[due], costs[state] + INSERT)
    tight = sum(1 << (4 + state) for state, due in enumerate(DUE)
                if costs[state] < NEVER and costs[due] == costs[state] + INSERT)
    return tuple(costs), tight


@cache
def step(costs: tuple[int, ...], role: bytes, must_go: bool, truncated: bool) -> tuple[tuple[int, ...], int, int]:
    """Over one row: the relative costs after it, what all of them rose by, and the cheapest moves."""
    moves = [(0, state, state, DELETE) for state in range(4)]
    if not must_go:
        moves += [(8, state, after, TRUNCATED * truncated) for state, after in KEPT.get(role, {}).items()]
        moves += [(12, state, due, REROLE + TRUNCATED * truncated) for state, due in enumerate(DUE)]
    reached = [NEVER] * 4
    for _, state, after, cost in moves:
        reached[after] = min(reached[after], costs[state] + cost)
    reached, tight = _with_inserts([min(c, NEVER) for c in reached])
    for bit, state, after, cost in moves:
        if costs[state] < NEVER and costs[state] + cost == reached[after]:
            tight |= 1 << (bit + state)
    least = min(reached)
    return tuple(c - least if c < NEVER else NEVER for c in reached), least, tight


@cache
def kept_after(state: int, role: bytes) -> int:
    return KEPT.get(role, {}).get(state, state)


@cache
def back(inserts: int, moves: int, on: int, role: bytes) -> tuple[int, int]:
    """One row back: the states before it on cheapest paths, and each state's first letter.

    ``inserts`` are the cheapest inserts before the row, ``moves`` the cheapest moves over it and
    ``on`` the states after it that are on cheapest paths.
    """
    after = {0: lambda s: s, 8: lambda s: kept_after(s, role), 12: lambda s: DUE[s]}
    before = 0
    for state in range(4):
        if any(moves >> (bit + state) & 1 and on >> to(state) & 1 for bit, to in after.items()):
            before |= 1 << state
    before = _before_inserts(inserts, before)
    letters = 0
    for state in range(4):
        goes = {0: moves >> state & 1 and on >> state & 1,
                1: inserts >> (4 + state) & 1 and before >> DUE[state] & 1,
                2: moves >> (8 + state) & 1 and on >> kept_after(state, role) & 1,
                3: moves >> (12 + state) & 1 and on >> DUE[state] & 1}
        letters |= next((letter for letter, yes in goes.items() if yes), 0) << (2 * state)
    return before, letters


def _before_inserts(inserts: int, on: int) -> int:
    """States on cheapest paths, with those from which an insert leads to one."""
    for _ in range(3):
        for state, due in enumerate(DUE):
            if inserts >> (4 + state) & 1 and on >> due & 1:
                on |= 1 << state
    return on


# --- What a conversation leaves behind until its end ------------------------------------------------------

def spill_folder() -> str:
    """One of the folders Spark gives its tasks for spilled data."""
    return os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0]


class Blocks:
    """Numbers written one after the other, in blocks; all but the last few blocks are in a file."""

    def __init__(self, kind: str, limits: dict):
        self.kind, self.rows, self.most = np.dtype(kind), limits["block_rows"], limits["blocks"]
        self.full: list[np.ndarray] = []
        self.open: list[int] = []
        self.file, self.spilled = None, 0

    def add(self, number: int) -> None:
        self.open.append(number)
        if len(self.open) == self.rows:
            self._put(np.array(self.open, self.kind))
            self.open = []

    def _put(self, block: np.ndarray) -> None:
        self.full.append(block)
        if len(self.full) > self.most:
            self.file = self.file or tempfile.TemporaryFile(dir=spill_folder())
            for full in self.full:
                self.file.write(full.tobytes())
            self.spilled += len(self.full)
            self.full = []

    def blocks(self, backwards: bool = False) -> Iterator[np.ndarray]:
        """All blocks in order, or from the last to the first."""
        count = self.spilled + len(self.full) + 1
        for k in range(count - 1, -1, -1) if backwards else range(count):
            if k == count - 1:
                yield np.array(self.open, self.kind)
            elif k >= self.spilled:
                yield self.full[k - self.spilled]
            else:
                self.file.seek(k * self.rows * self.kind.itemsize)
                yield np.frombuffer(self.file.read(self.rows * self.kind.itemsize), self.kind)


class Rows:
    """Roles and texts of a conversation, in an Arrow file once they are many bytes."""

    schema = pa.schema([("role", pa.binary()), ("text", pa.binary())])

    def __init__(self, limits: dict):
        self.most, self.bytes = limits["text_bytes"], 0
        self.held: list[tuple[bytes, bytes]] = []
        self.file = self.writer = None

    def add(self, role: bytes, text: bytes) -> None:
        self.held.append((role, text))
        self.bytes += len(role) + len(text) + 200
        if self.bytes > self.most:
            if self.writer is None:
                self.file = tempfile.TemporaryFile(dir=spill_folder())
                self.writer = pa.ipc.new_stream(self.file, self.schema)
            self.writer.write_batch(pa.record_batch([list(c) for c in zip(*self.held)], schema=self.schema))
            self.held, self.bytes = [], 0

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        if self.writer is not None:
            self.writer.close()
            self.file.seek(0)
            for batch in pa.ipc.open_stream(self.file):
                yield from zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
        yield from self.held


class Seen:
    """The rows of a conversation so far, by 128-bit marks; sorted runs of them in a file once many."""

    def __init__(self, limits: dict):
        self.most, self.marks, self.runs = limits["seen_rows"], set(), []

    def before(self, role: bytes, text: bytes) -> bool:
        mark = hashlib.blake2b(b"%d:%b%b" % (len(role), role, text), digest_size=16).digest()
        if mark in self.marks:
            return True
        key = np.array(mark, "S16")
        for run in self.runs:
            place = np.searchsorted(run, key)
            if place < len(run) and run[place] == key:
                return True
        self.marks.add(mark)
        if len(self.marks) >= self.most:
            run = np.memmap(tempfile.TemporaryFile(dir=spill_folder()), "S16", "w+", shape=(len(self.marks),))
            run[:] = np.sort(np.array(list(self.marks), "S16"))
            self.runs.append(run)
            self.marks = set()
        return False


class Conversation:
    """One conversation, row by row and then repaired."""

    def __init__(self, conv_id, limits: dict):
        self.conv_id, self.rows, self.seen = conv_id, Rows(limits), Seen(limits)
        self.moves, self.letters = Blocks("<u2", limits), Blocks("u1", limits)
        self.initials = Blocks("u1", limits)
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.last = None
        self.total, (self.costs, tight) = 0, _with_inserts([0, NEVER, NEVER, NEVER])
        self.moves.add(tight)

    def add(self, turn: int | None, role: bytes, text: bytes, blank: bool, truncated: bool) -> None:
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn, self.turns = turn, self.turns + 1
        again = self.seen.before(role, text)
        duplicate, truncated = again and not blank, truncated and not blank and not again
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1] if role[:1] in KEPT else b""
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        self.costs, rise, moves = step(self.costs, initial, blank or duplicate, truncated)
        self.total += rise
        self.moves.add(moves)
        self.initials.add(initial[0] if initial else 0)
        self.rows.add(role, text)

    def finish(self) -> int:
        """The cost of the cheapest edits; walks back over the moves and leaves the letters."""
        least = min(self.costs[state] for state in FINAL)
        on = sum(1 << state for state in FINAL if self.costs[state] == least)
        moves, roles = self._backwards(self.moves), self._backwards(self.initials)
        over = next(moves)
        on = _before_inserts(over, on)
        found = []
        for inserts, role in zip(moves, roles):
            on, letters = back(inserts & 0xF0, over, on, bytes([role]) if role else b"")
            over = inserts
            self.letters.add(letters)
        return self.total + least

    @staticmethod
    def _backwards(blocks: Blocks) -> Iterator[int]:
        for block in blocks.blocks(backwards=True):
            yield from block[::-1].tolist()

    def edits(self) -> Iterator[tuple[int, bytes | None, bytes]]:
        """``(letter, role, text)`` in order; the role is None for deleted rows."""
        state = START
        for (role, text), letters in zip(self.rows, self._backwards(self.letters)):
            while True:
                letter = LETTERS[letters >> (2 * state) & 3]
                if letter == ord("I"):
                    state = DUE[state]
                    yield letter, NAMES[state], b""
                    continue
                if letter == ord("D"):
                    yield letter, None, text
                elif letter == ord("K"):
                    state = kept_after(state, role[:1])
                    yield letter, role, text
                else:
                    state = DUE[state]
                    yield letter, NAMES[state], text
                break
        while state not in FINAL:
            state = DUE[state]
            yield ord("I"), NAMES[state], b""

    def summary(self) -> tuple:
        cost, digest, audit, first = self.finish(), hashlib.sha256(), bytearray(), True
        for letter, role, text in self.edits():
            audit.append(letter)
            if role is not None:
                digest.update((b"" if first else b"\n") + role + b":" + text)
                first = False
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost,
                audit.decode(), digest.hexdigest())


# --- The Spark side ---------------------------------------------------------------------------------------

COLUMNS = ["conv_id", "turn", "role", "text", "gone", "blank", "truncated"]
LIMITS = {"block_rows": BLOCK_ROWS, "blocks": BLOCKS, "text_bytes": TEXT_BYTES, "seen_rows": SEEN_ROWS}


def conversations_of(batches: Iterator[pa.RecordBatch], limits: dict) -> Iterator[Conversation]:
    """Conversations, each complete, from sorted rows."""
    now = None
    for batch in batches:
        for conv_id, turn, role, text, gone, blank, truncated in zip(
                *[batch.column(n).to_pylist() for n in COLUMNS]):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    yield now
                now = Conversation(conv_id, limits)
            if not gone:
                now.add(turn, role, text, blank, truncated)
    if now is not None:
        yield now


def _summaries(batches, out: pa.Schema, limits: dict) -> Iterator[pa.RecordBatch]:
    lines, size = [], 0
    for conversation in conversations_of(batches, limits):
        lines.append(conversation.summary())
        size += len(lines[-1][7])
        if len(lines) >= 1_000 or size > TEXT_BYTES:
            yield _lines(lines, out)
            lines, size = [], 0
    if lines:
        yield _lines(lines, out)


def _repaired(batches, out: pa.Schema, limits: dict) -> Iterator[pa.RecordBatch]:
    lines, size = [], 0
    for conversation in conversations_of(batches, limits):
        conversation.finish()
        turn = 0
        for letter, role, text in conversation.edits():
            if role is None:
                continue
            lines.append((conversation.conv_id, turn, role, text, chr(letter)))
            turn, size = turn + 1, size + len(text)
            if len(lines) >= 1_000 or size > TEXT_BYTES:
                yield _lines(lines, out)
                lines, size = [], 0
    if lines:
        yield _lines(lines, out)


def _lines(lines: list[tuple], out: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*lines), out)], schema=out)


def or_space(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def in_turn(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted by turn, with what Python needs to know of each."""
    text, gone = or_space("text"), F.col("gone") if "gone" in rows.columns else F.lit(False)
    trimmed = F.rtrim(text, F.lit(BLANKS))
    last = F.substring(trimmed, -1, 1)
    ready = rows.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), or_space("role").cast("binary").alias("role"),
        text.cast("binary").alias("text"), gone.alias("gone"), (trimmed == "").alias("blank"),
        ((trimmed != "") & ~last.isin(*ENDS)).alias("truncated"))
    return ready.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def _run(rows: DataFrame, lines, columns: str, limits: dict) -> DataFrame:
    schema = StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(columns).fields])
    return in_turn(rows).mapInArrow(partial(lines, out=to_arrow_schema(schema), limits=LIMITS | limits), schema)


def audits(rows: DataFrame, **limits) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the digest of the repaired rows.

    Rows whose column ``gone`` is true only name their conversation.
    """
    return _run(rows, _summaries, SUMMARY, limits)


def repaired(rows: DataFrame, **limits) -> DataFrame:
    """The repaired conversations: ``conv_id, turn`` (from 0), ``role, text, edit`` (I, K or R)."""
    found = _run(rows, _repaired, "turn bigint, role binary, text binary, edit string", limits)
    return found.withColumns({n: F.col(n).cast("string") for n in ("role", "text")})


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn: dropped (``gone``), emptied, without ends of
    sentences, repeated, or made the user's."""
    name = F.concat(*[part for n in ("conv_id", "turn") for part in (
        F.coalesce(F.col(n).cast("string"), F.lit(" ")), F.lit(":"))][:-1])
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.translate(or_space("text"), ENDS, "")) \
        .otherwise(or_space("text"))
    times = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select("conv_id", "turn", "role", "text", (F.crc32(name) % 20).alias("harm")).select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(or_space("role")).alias("role"),
        text.alias("text"), (F.col("harm") == 0).alias("gone"), F.explode(times).alias("time")).drop("time")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return audits(damaged(table(spark, folder, "conversations")))
