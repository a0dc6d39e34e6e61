"""Repair of conversation structure, in one secondary-sorted stream.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.  The
cheapest edits are found by dynamic programming over four states: nothing put
out yet, after a system, a user or an assistant turn.  Rows are dealt by
conversation and sorted by turn; a Python worker carries the states from batch
to batch, so a conversation of any length takes the memory of four states.
Of each row four bytes remain, one a state: the state before, the inserts and
the edit.  After ``PART`` rows these go out as a row of their own; the parts of
such giant conversations are read again from the last to the first, again as a
sorted stream, to spell out the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Store, pick

PART = 1 << 20

# What edits cost, and the roles that may be inserted or given.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = "user", "assistant"

_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_OTHER = 3  # a role initial that is none of s, u, a; those are 0, 1, 2
_FINE, _BLANK, _REPEATED, _CUT = range(4)  # first faults
_LEGAL = {(0, 1), (1, 2), (2, 1)}  # neighbouring role initials
_EDITS = "DKR"
#: At most a delete and two inserts (10) lead from one state to all that another can still do, so states that cost more than that above the best are dropped.
_APART = DELETE + 2 * INSERT
_END = {_NOTHING: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}  # inserts that end a conversation
_DONE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SCHEMA = _DONE + ", part int, back binary, state int, inserts int"


def _next_role(state: int) -> int:
    """Index in ``ROLES`` of the turn that may be inserted here."""
    return int(state == _USER)


class Step(NamedTuple):
    """What one row does to the states."""

    after: tuple  # of each state: (cost above the best, place in the order of the audits so far) or None
    cost: int  # by which the best grew
    moves: tuple  # of each state: (state before, inserts, edit) or None
    back: bytes  # the same, a byte each


class Machine:
    """Steps by (states, row kind).  Costs are kept relative, so there are few; each is worked out once."""

    start = ((0, 0), None, None, None)

    def __init__(self):
        self.steps: dict[tuple, Step] = {}

    def step(self, states: tuple, initial: int, fault: int) -> Step:
        key = states, initial, fault
        if key not in self.steps:
            self.steps[key] = self._work_out(*key)
        return self.steps[key]

    def _work_out(self, states: tuple, initial: int, fault: int) -> Step:
        best: dict[int, tuple] = {}
        for before, known in enumerate(states):
            if known is None:
                continue
            at = before
            for inserts in range(3):
                cost = known[0] + INSERT * inserts
                for edit, target, more in self._edits(at, initial, fault):
                    # audits so far hold a row's edit last, so that none begins another: their order stays when they grow
                    found = (cost + more, known[1], "I" * inserts + edit, (before, inserts, edit))
                    if target not in best or found < best[target]:
                        best[target] = found
                at = _USER + _next_role(at)
        least = min(x[0] for x in best.values())
        live = {s: x for s, x in best.items() if x[0] <= least + _APART}
        order = {x[1:3]: i for i, x in enumerate(sorted(live.values(), key=lambda x: x[1:3]))}
        after = tuple((live[s][0] - least, order[live[s][1:3]]) if s in live else None for s in range(4))
        moves = tuple(live[s][3] if s in live else None for s in range(4))
        return Step(after, least, moves, bytes(m[0] | m[1] << 2 | _EDITS.index(m[2]) << 4 if m else 255 for m in moves))

    @staticmethod
    def _edits(state: int, initial: int, fault: int) -> Iterator[tuple[str, int, int]]:
        """(edit, state after, cost) that a row allows."""
        yield "D", state, DELETE
        if fault not in (_BLANK, _REPEATED):
            more = TRUNCATED * (fault == _CUT)
            wanted = _next_role(state)
            yield "R", _USER + wanted, RENAME + more
            if initial == 1 + wanted:
                yield "K", _USER + wanted, more
            elif initial == 0 and state == _NOTHING:
                yield "K", _SYSTEM, more


class _Run:
    """One conversation as it streams by."""

    def __init__(self, conv_id: int | None, machine: Machine):
        self.conv_id, self.machine = conv_id, machine
        self.states, self.cost, self.faults, self.illegal = machine.start, 0, [0, 0, 0, 0], 0
        self.hashes: list = [hashlib.sha256(), None, None, None]  # of what each state has put out
        self.back, self.parts, self.last = bytearray(), 0, None
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, role: str, text: str, initial: int, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        self.illegal += self.last is not None and (self.last, initial) not in _LEGAL
        self.last = initial
        self.faults[fault] += 1
        step = self.machine.step(self.states, initial, fault)
        self.hashes = [m and self._hash(m, role, text) for m in step.moves]
        self.states, self.cost = step.after, self.cost + step.cost
        self.back += step.back

    def _hash(self, move: tuple[int, int, str], role: str, text: str):
        state, inserts, edit = move
        if not inserts and edit == "D":
            return self.hashes[state]
        out = self.hashes[state].copy()
        state = self._insert(out, state, inserts)
        if edit != "D":
            role = role if edit == "K" else ROLES[_next_role(state)]
            out.update(f"{chr(10) * (state != _NOTHING)}{role}:{text}".encode())
        return out

    @staticmethod
    def _insert(out, state: int, inserts: int) -> int:
        for _ in range(inserts):
            out.update(f"{chr(10) * (state != _NOTHING)}{ROLES[_next_role(state)]}:".encode())
            state = _USER + _next_role(state)
        return state

    def spill(self) -> dict:
        """The edits so far as a part; the last part also says where to begin."""
        row = {"conv_id": self.conv_id, "part": self.parts, "back": bytes(self.back)}
        self.parts += 1
        self.back.clear()
        return row

    def end(self) -> Iterator[dict]:
        ends = ((known[0] + INSERT * _END[s], known[1], s) for s, known in enumerate(self.states) if known)
        more, _, state = min(ends)
        out = self.hashes[state].copy()
        self._insert(out, state, _END[state])
        audit = None
        if self.parts:
            yield self.spill() | {"state": state, "inserts": _END[state]}
        else:
            audit = spell(self.back, state)[0] + "I" * _END[state]
        gaps = 0 if self.high is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        counts = {"gaps": gaps, "blank": self.faults[_BLANK], "duplicate": self.faults[_REPEATED], "truncated": self.faults[_CUT], "illegal": self.illegal}
        yield {"conv_id": self.conv_id, **counts, "cost": self.cost + more, "audit": audit, "repaired_sha256": out.hexdigest()}


def spell(back: bytes, state: int) -> tuple[str, int]:
    """The edits' initials of rows that end in a state, and the state they began in."""
    out = []
    for at in range(len(back) - 4, -1, -4):
        move = back[at + state]
        out.append("I" * (move >> 2 & 3) + _EDITS[move >> 4])
        state = move & 3
    return "".join(reversed(out)), state


def _streamed(part: int):
    """Rows sorted by conversation and turn to results and, of long conversations, parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, at, schema = Machine(), None, None
        schema = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), ("audit", pa.string()), ("repaired_sha256", pa.string()), ("part", pa.int32()), ("back", pa.binary()), ("state", pa.int32()), ("inserts", pa.int32())])
        for batch in batches:
            out = []
            for conv_id, turn, present, role, text, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if at is None or at.conv_id != conv_id:
                    out += at.end() if at else ()
                    at = _Run(conv_id, machine)
                if present:
                    at.add(turn, role, text, initial, fault)
                    if len(at.back) >= 4 * part:
                        out.append(at.spill())
            yield pa.RecordBatch.from_pylist(out, schema)
        if at:
            yield pa.RecordBatch.from_pylist([*at.end()], schema)

    return run


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of giant conversations, each from the last to the first, to their audits."""
    conv_id, state, pieces, schema = None, 0, [], pa.schema([("conv_id", pa.int64()), ("spelt", pa.string())])

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"conv_id": conv_id, "spelt": "".join(reversed(pieces))}], schema)

    for batch in batches:
        for row in batch.to_pylist():
            if row["state"] is not None:  # a conversation's last part
                if pieces:
                    yield done()
                conv_id, state, pieces = row["conv_id"], row["state"], ["I" * row["inserts"]]
            piece, state = spell(row["back"], state)
            pieces.append(piece)
    if pieces:
        yield done()


def facts(rows: DataFrame) -> DataFrame:
    """Adds ``initial`` (0: s, 1: u, 2: a, else 3), ``fault`` (1: blank, 2: repeated, 3: cut short, else 0) and ``nth`` of its like."""
    initial = F.instr(F.lit("sua"), F.substring("role", 1, 1)) - 1
    initial = F.when(F.col("role") == "", _OTHER).when(initial < 0, _OTHER).otherwise(initial)
    same = F.when(F.col("present"), F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    # dealt by conversation already: the window sorts, but moves nothing
    counted = rows.withColumn("nth", F.row_number().over(Window.partitionBy("conv_id", same).orderBy(F.asc_nulls_first("turn"))))
    fault = (
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), _BLANK)
        .when(F.col("nth") > 1, _REPEATED)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), _CUT)
        .otherwise(_FINE)
    )
    return counted.select("conv_id", "turn", "present", "role", "text", initial.alias("initial"), fault.alias("fault"), "nth")


def repair(rows: DataFrame, part: int = PART) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows``: conv_id, turn, role, text and, if given, a boolean ``present``;
    rows for which it is not true only name their conversation.  Rows count by
    turn (nulls first), then role, then text.  Null roles and texts count as
    one space; a null conv_id is a conversation of its own; an empty text is
    blank; repeated rows are duplicates; other columns are ignored; an empty
    table gives no rows.  ``gaps`` ends at 2^63 - 1.  A conversation of more
    than ``part`` rows sheds its edits as rows; only its audit, one letter a
    row, is ever whole in a task."""
    store = Store(rows.sparkSession, "repair")
    named = pick(rows, "conv_id", "turn", "role", "text", **({"present": "present"} if "present" in rows.columns else {}))
    if "present" not in rows.columns:
        named = named.withColumn("present", F.lit(True))
    present = F.coalesce("present", F.lit(False))
    text = lambda c: F.when(present, F.coalesce(c, F.lit(" ")))
    whole = named.select(F.col("conv_id").cast("long").alias("conv_id"), F.when(present, F.col("turn").cast("long")).alias("turn"), present.alias("present"), text("role").alias("role"), text("text").alias("text"))
    # of rows alike the first one counted comes first
    ordered = facts(whole.repartition("conv_id")).sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "nth")
    found = store.put(ordered.drop("nth").mapInArrow(_streamed(part), _SCHEMA), "repaired")
    parts = found.where("back is not null").select("conv_id", "part", "back", "state", "inserts")
    spelt = parts.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part")).mapInArrow(_read_back, "conv_id long, spelt string").withColumnRenamed("conv_id", "id")
    results = found.where("back is null")
    joined = results.join(spelt, F.col("conv_id").eqNullSafe(F.col("id")), "left").withColumn("audit", F.coalesce("audit", "spelt"))
    return joined.select(*[c.split()[0] for c in _DONE.split(", ")])


def damage(rows: DataFrame, one_in: int = 20) -> DataFrame:
    """Rows damaged by ``crc32(conv_id:turn) % one_in``, null fields read as one space: 0 drops the row (``present`` false), 1 empties its
    text, 2 takes ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes it the user's."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % one_in
    hit = pick(rows, "conv_id", "turn", "role", "text").withColumn("fate", fate)
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return hit.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), (F.col("fate") != 0).alias("present"), times.alias("copy")).drop("copy")
