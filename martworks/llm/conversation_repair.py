"""Conversation structure repair: the cheapest edits that turn a conversation into pairs of user and assistant turns,
after a system turn or without one.

Rows are repartitioned by conversation and sorted by turn, and stream through ``mapInPandas``, last turn first. What is
carried from batch to batch is the least cost of the turns seen so far from each state of the pattern. These costs,
less the smallest of them, take few different values, so a row costs one look-up, and its backpointer, the edits that
are best from each state, is a small number. At the first turn the edits are read off in order. A conversation
whose texts and backpointers exceed a bound goes to files in the shared folder block by block and is read back in
order. So a task holds a bounded part of a conversation, whatever its length.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from martworks.session import scratch

from .common import BLANKS

#: Costs of edits. A row without text, or said before, can only be deleted.
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Characters and rows of a conversation that a task holds before it writes a block.
HELD_CHARS = 32 << 20
HELD_ROWS = 500_000

ROLES = {"u": "user", "a": "assistant"}
LEGAL = frozenset(("su", "ua", "au"))
#: The pattern ``(s?(ua)+)?``: at the start, after s, after u, after a. What may follow, and where it leads.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWS = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
MADE = tuple(next(c for c in follows if c in ROLES) for follows in FOLLOWS)
FINAL = (START, AFTER_A)

NONE, BLANK, DUPLICATE, CUT = range(4)


class Edits:
    """Least costs from each state of the pattern, as numbered vectors, and the best edits from there.

    A choice has, per state, the edits up to and with the row: its letters, the roles of the turns inserted, the
    row's own role if it is kept with another, and the state after it. Of equally cheap edits those whose letters come
    first are taken: a state and a letter lead to one state only, so the first differing letter decides.
    """

    def __init__(self):
        self._number: dict[tuple, int] = {}
        self.vectors: list[tuple] = []
        self.choices: list[tuple] = []
        self._steps: dict[tuple, tuple[int, int, int]] = {}
        least = self._closed([0 if s in FINAL else None for s in range(4)])
        self.end = self._numbered(least)[0]
        self.at_end = self._paths([[("", None, None)] if s in FINAL else [] for s in range(4)], least)

    @staticmethod
    def _closed(costs: list) -> list[int]:
        """Costs when turns may be inserted first."""
        costs = list(costs)
        for _ in range(4):
            for s in range(4):
                inserted = costs[FOLLOWS[s][MADE[s]]]
                if inserted is not None and (costs[s] is None or inserted + INSERT < costs[s]):
                    costs[s] = inserted + INSERT
        return costs

    def _numbered(self, costs: list[int]) -> tuple[int, int]:
        """The number of the vector less its smallest cost, and that cost."""
        low = min(costs)
        vector = tuple(c - low for c in costs)
        if vector not in self._number:
            self._number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self._number[vector], low

    @staticmethod
    def _options(state: int, initial: str, fault: int) -> list[tuple[str, int, str | None, int]]:
        """(letter, cost, new role, next state) of the row's own edits."""
        out = [("D", DELETE, None, state)]
        if fault in (BLANK, DUPLICATE):
            return out
        extra = TRUNCATED if fault == CUT else 0
        if initial in FOLLOWS[state]:
            out.append(("K", extra, None, FOLLOWS[state][initial]))
        out.append(("R", RETITLE + extra, ROLES[MADE[state]], FOLLOWS[state][MADE[state]]))
        return out

    @staticmethod
    def _paths(own: list[list[tuple]], least: list[int]) -> tuple:
        """Per state the letters, inserted roles, new role and next state; ``own``: cheapest edits of the row itself."""
        out = []
        for state in range(4):
            letters, inserted, at = "", [], state
            while True:
                row = min(own[at], default=None)
                insert = least[FOLLOWS[at][MADE[at]]] + INSERT == least[at]
                if row and (row[0] < "I" or not insert):
                    out.append((letters + row[0], tuple(inserted), row[1], at if row[2] is None else row[2]))
                    break
                letters += "I"
                inserted.append(ROLES[MADE[at]])
                at = FOLLOWS[at][MADE[at]]
        return tuple(out)

    def step(self, number: int, initial: str, fault: int) -> tuple[int, int, int]:
        """From the vector after a row: the vector before it, the cost to add, and the number of the choice."""
        key = (number, initial, fault)
        if key not in self._steps:
            after = self.vectors[number]
            options = [[(cost + after[to], letter, role, to) for letter, cost, role, to in self._options(s, initial, fault)] for s in range(4)]
            least = self._closed([min(o)[0] for o in options])
            own = [[(letter, role, to) for cost, letter, role, to in options[s] if cost == least[s]] for s in range(4)]
            self.choices.append(self._paths(own, least))
            self._steps[key] = (*self._numbered(least), len(self.choices) - 1)
        return self._steps[key]


class Blocks:
    """Rows of one conversation in the order they came, (choice, role, text); beyond a bound in files of the shared
    folder."""

    def __init__(self, folder: str, chars: int, rows: int):
        self.folder, self.chars, self.rows = folder, chars, rows
        self.held: list[tuple] = []
        self.size, self.files = 0, []

    def add(self, row: tuple) -> None:
        self.held.append(row)
        self.size += len(row[2])
        if self.size > self.chars or len(self.held) >= self.rows:
            self._spill()

    def _spill(self) -> None:
        system, path = pa.fs.FileSystem.from_uri(self.folder)
        system.create_dir(path, recursive=True)
        name = f"{path}/{uuid.uuid4().hex}.arrow"
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in self.held], pa.uint16()), pa.array([r[1] for r in self.held], pa.string()),
             pa.array([r[2] for r in self.held], pa.large_string())], ["choice", "role", "text"])
        with system.open_output_stream(name) as out, pa.ipc.new_file(out, batch.schema) as writer:
            writer.write_batch(batch)
        self.files.append(name)
        self.held, self.size = [], 0

    def backwards(self) -> Iterator[tuple]:
        """The rows from the last that came to the first; the files are removed on the way."""
        yield from reversed(self.held)
        system = pa.fs.FileSystem.from_uri(self.folder)[0] if self.files else None
        for name in reversed(self.files):
            with system.open_input_file(name) as source:
                batch = pa.ipc.open_file(source).get_batch(0)
            yield from zip(*[batch.column(i).to_pylist()[::-1] for i in range(3)])
            system.delete_file(name)


class Conversation:
    """What is carried while the rows of one conversation come in, last turn first."""

    def __init__(self, key, edits: Edits, folder: str, chars: int, rows: int):
        self.key, self.edits = key, edits
        self.vector, self.cost = edits.end, 0
        self.blocks = Blocks(folder, chars, rows)
        self.faults = [0, 0, 0, 0]
        self.illegal, self.later = 0, None
        self.last_turn = self.first_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        self.vector, more, choice = self.edits.step(self.vector, initial if initial in "sua" else "", fault)
        self.cost += more
        self.faults[fault] += 1
        if self.later is not None:
            self.illegal += initial + self.later not in LEGAL
        self.later = initial
        if turn is not None and turn != self.first_turn:
            self.last_turn = turn if self.last_turn is None else self.last_turn
            self.first_turn, self.turns = turn, self.turns + 1
        self.blocks.add((choice, role, text))

    def counts(self) -> dict:
        gaps = 0 if self.turns == 0 else self.last_turn - self.first_turn + 1 - self.turns
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT],
                "illegal": self.illegal, "cost": self.cost + self.edits.vectors[self.vector][START]}

    def edited(self) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) in order, first turn first; role and text are those after the edit, of a deleted row its
        own."""
        state = START
        for choice, role, text in self.blocks.backwards():
            letters, inserted, new, state = self.edits.choices[choice][state]
            for made in inserted:
                yield "I", made, ""
            yield letters[-1], new or role, text
        for made in self.edits.at_end[state][1]:
            yield "I", made, ""


REPORT = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
MESSAGES = "conv string, step long, edit string, role string, text string"


def _report(conversation: Conversation) -> Iterator[dict]:
    letters, digest, begun = io.StringIO(), hashlib.sha256(), False
    for letter, role, text in conversation.edited():
        letters.write(letter)
        if letter != "D":
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True
    yield {"conv": conversation.key, **conversation.counts(), "audit": letters.getvalue(), "repaired_sha256": digest.hexdigest()}


def _messages(conversation: Conversation) -> Iterator[dict]:
    for step, (letter, role, text) in enumerate(conversation.edited()):
        yield {"conv": conversation.key, "step": step, "edit": letter, "role": role, "text": text}


def _streamed(ordered: DataFrame, schema: str, say, chars: int, rows: int) -> DataFrame:
    folder = scratch(ordered.sparkSession, "conversations")
    names = [f.split()[0] for f in schema.split(", ")]

    def frames(found: Iterator[dict]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for row in found:
            held.append(row)
            size += 100 + len(row.get("text", "")) + len(row.get("audit", ""))
            if size > HELD_CHARS:
                yield pd.DataFrame(held, columns=names)
                held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        edits = Edits()

        def found():
            current = None
            for batch in batches:
                for key, here, turn, timed, role, text, fault in zip(*[batch[c].tolist() for c in (
                        "conv", "here", "turn", "timed", "role", "text", "fault")]):
                    key = key if isinstance(key, str) else None
                    if current is None or key != current.key:
                        if current is not None:
                            yield from say(current)
                        current = Conversation(key, edits, folder, chars, rows)
                    if here:
                        current.add(turn if timed else None, role, text, fault)
            if current is not None:
                yield from say(current)

        yield from frames(found())

    return ordered.mapInPandas(run, schema)


def _ordered(rows: DataFrame, here: Column, id_col: str) -> DataFrame:
    """All rows of a conversation in one partition, last turn first, with their faults; rows that are not ``here`` only
    name their conversation. Rows of one turn are in the order of role and text."""
    blank_role = F.coalesce(F.col("role").cast("string"), F.lit(" "))
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    thin = rows.select(F.col(f"`{id_col}`").cast("string").alias("conv"), F.col("turn").cast("long").alias("moment"),
                       blank_role.alias("role"), text.alias("text"), F.coalesce(here, F.lit(False)).alias("here"))
    thin = thin.select("conv", "here", "moment", F.when(F.col("here"), F.col("role")).otherwise("").alias("role"),
                       F.when(F.col("here"), F.col("text")).otherwise("").alias("text")).repartition("conv")
    said = Window.partitionBy("conv", "here", "role", "text").orderBy(F.asc_nulls_first("moment"))
    end = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    fault = (F.when(end == "", BLANK).when(F.col("nth") > 1, DUPLICATE).when(~end.isin(".", "!", "?"), CUT).otherwise(NONE))
    rows = thin.withColumn("nth", F.row_number().over(said)).select(
        "conv", "here", F.coalesce("moment", F.lit(0)).alias("turn"), F.col("moment").isNotNull().alias("timed"), "role", "text", "nth",
        fault.alias("fault"))
    # Nulls are the first turns, so they come last here.
    return rows.sortWithinPartitions("conv", F.desc("timed"), *[F.desc(c) for c in ("turn", "role", "text", "nth")])


def report(rows: DataFrame, here: Column | None = None, *, id_col: str = "conv_id", held_chars: int = HELD_CHARS,
           held_rows: int = HELD_ROWS) -> DataFrame:
    """Per conversation its faults, the cost and the letters of the cheapest edits, and the digest of what they leave.

    ``rows`` have the conversation's id, ``turn``, ``role`` and ``text``; with ``here`` false a row only names its
    conversation. A null role or text is one space, a null turn comes first, a null id is a conversation like any
    other. Rows of one turn follow by role and text. A conversation without rows has zeros, no letters and the
    digest of the empty text; an empty table gives no rows. Other columns are not read.
    """
    kind = rows.schema[id_col].dataType
    found = _streamed(_ordered(rows, F.lit(True) if here is None else here, id_col), REPORT, _report, held_chars, held_rows)
    return found.select(F.col("conv").cast(kind).alias(id_col), *[f.split()[0] for f in REPORT.split(", ")[1:]])


def messages(rows: DataFrame, here: Column | None = None, *, id_col: str = "conv_id", held_chars: int = HELD_CHARS,
             held_rows: int = HELD_ROWS) -> DataFrame:
    """The rows of the repaired conversations: ``step`` (from 0), ``edit`` (K, R, D or I), ``role`` and ``text``. Without the
    deleted ones (``edit`` D) they are the repaired conversation. Input as for :func:`report`."""
    kind = rows.schema[id_col].dataType
    found = _streamed(_ordered(rows, F.lit(True) if here is None else here, id_col), MESSAGES, _messages, held_chars, held_rows)
    return found.select(F.col("conv").cast(kind).alias(id_col), *[f.split()[0] for f in MESSAGES.split(", ")[1:]])


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a checksum of id and turn: dropped rows stay, but are not ``here``; emptied,
    unpunctuated and repeated ones, and ones with the role of the user. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    marked = rows.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text"), kind.cast("int").alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return marked.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("kind") != 0).alias("here"))
