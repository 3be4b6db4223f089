"""Conversation structure repair by aligning turns with an alternating grammar.

A conversation's turns are edited at least cost so that its role initials read
``(s?(ua)+)?``. For each feasible number of turns the grammar has one target
string, so this is a Wagner-Fischer alignment of turns with targets: keep,
rerole, delete or insert at each step. All targets end alike, so one table of
costs-to-go (turn, targets left) serves every length. The table is banded as by
Ukkonen: the cost of a plain feasible repair is the incumbent, and cells whose
remaining turns and targets differ by more than it can pay for are left out.
Audits of all lengths of least cost are traced back and the ASCII-least is taken; it
names its length and so the target.

A conversation of more than ``LONG_TURNS`` has too wide a band for a table. As the
targets repeat with period two, its cells are folded by the parity of the targets
left, which gives the same costs and audits (tested) in linear time.

Turns are dealt by conversation and sorted, first without text (role, flags,
digest: a few bytes a turn stay in memory until the table is done), then with
text, which streams through the edits. So no conversation's text is held, however long
it is; its digest is a sequential hash, so one conversation is one task's work.

Cases: a null id, turn, role or text counts as one space (a null text is thus
blank, a null role never fits); null turns come first; turns of one number go by
role, then by digest of role and text; repeated rows are turns of their own; null
ids are one conversation; a conversation whose rows were all dropped has zeros and
an empty audit; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tarmac.llm.jobs import prepared

SPACE = "[\\x20\\x09-\\x0D]"
ENDS = ".!?"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LONG_TURNS = 1000
NEVER = 1 << 60
ROLES = {"u": "user", "a": "assistant"}
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class Turn(NamedTuple):
    initial: str
    must_go: bool    # blank or duplicate
    truncated: bool


def _kept(t: Turn, target: str) -> tuple[int, str]:
    """Cost and initial of the edit that makes a turn the target."""
    if t.must_go:
        return NEVER, ""
    fits = t.initial == target
    if target == "s" and not fits:
        return NEVER, ""
    return (0 if fits else REROLE) + TRUNCATED * t.truncated, "K" if fits else "R"


def _incumbent(turns: list[Turn]) -> int:
    """The cost of a plain feasible repair: all turns that may stay alternate,
    with one more at the end if there is an odd number of them; or none stay."""
    cost, n = 0, 0
    for t in turns:
        if t.must_go:
            cost += DELETE
        else:
            cost += _kept(t, "ua"[n % 2])[0]
            n += 1
    return min(cost + INSERT * (n % 2), DELETE * len(turns))


class _Table:
    """Least costs of making turns i.. the last r targets of "...uaua". Rows are
    bands: first targets left, then their costs."""

    def __init__(self, turns: list[Turn]) -> None:
        self.turns = turns
        slack = _incumbent(turns) - DELETE * sum(t.must_go for t in turns)
        rows: list[tuple[int, list[int]]] = []
        may_stay = 0
        for i in range(len(turns), -1, -1):
            if i < len(turns):
                may_stay += not turns[i].must_go
            low, high = max(0, may_stay - slack // DELETE), may_stay + slack // INSERT
            costs: list[int] = []
            for r in range(low, high + 1):
                best = 0 if i == len(turns) and not r else NEVER
                if costs:
                    best = min(best, INSERT + costs[-1])
                if i < len(turns):
                    best = min(best, DELETE + self._cell(rows[-1], r))
                    if r:
                        best = min(best, _kept(turns[i], "au"[r % 2 == 0])[0] + self._cell(rows[-1], r - 1))
                costs.append(best)
            rows.append((low, costs))
        self.rows = rows[::-1]

    @staticmethod
    def _cell(row: tuple[int, list[int]], r: int) -> int:
        return row[1][r - row[0]] if 0 <= r - row[0] < len(row[1]) else NEVER

    def cost(self, i: int, r: int) -> int:
        return self._cell(self.rows[i], r)

    def ends(self, i: int, least: int) -> list[tuple[int, int]]:
        """(cost, targets left) from turn i on, where whole pairs are left."""
        low, costs = self.rows[i]
        return [(c, low + k) for k, c in enumerate(costs) if (low + k) % 2 == 0 and low + k >= least and c < NEVER]

    def trace(self, i: int, r: int) -> str:
        out = []
        while i < len(self.turns) or r:
            now = self.cost(i, r)
            if i < len(self.turns) and DELETE + self.cost(i + 1, r) == now:
                out.append("D")
                i += 1
            elif r and INSERT + self.cost(i, r - 1) == now:
                out.append("I")
                r -= 1
            else:
                out.append(_kept(self.turns[i], "au"[r % 2 == 0])[1])
                i, r = i + 1, r - 1
        return "".join(out)


class _Folded:
    """The same with targets left folded by parity (2 for a whole number of
    pairs that is not 0), for long conversations."""

    def __init__(self, turns: list[Turn]) -> None:
        self.turns = turns
        n = len(turns)
        even, odd, some = [NEVER] * (n + 1), [NEVER] * (n + 1), [NEVER] * (n + 1)
        for i in range(n, -1, -1):
            t = turns[i] if i < n else None
            u, a = (_kept(t, "u")[0], _kept(t, "a")[0]) if t else (NEVER, NEVER)
            e, o, s = (even[i + 1], odd[i + 1], some[i + 1]) if t else (NEVER, NEVER, NEVER)
            # without inserts here, then with one or two
            even[i] = min(0 if not t else NEVER, DELETE + e, u + o)
            odd[i] = min(DELETE + o, a + e)
            some[i] = min(DELETE + s, u + o)
            odd[i] = min(odd[i], INSERT + even[i])
            even[i] = min(even[i], INSERT + odd[i])
            some[i] = min(some[i], INSERT + odd[i])
            odd[i] = min(odd[i], INSERT + even[i])
        self.costs = {0: even, 1: odd, 2: some}

    def cost(self, i: int, r: int) -> int:
        return self.costs[r][i]

    def ends(self, i: int, least: int) -> list[tuple[int, int]]:
        return [(self.costs[2 if least else 0][i], 2 if least else 0)]

    def trace(self, i: int, r: int) -> str:
        out = []
        while i < len(self.turns) or r or self.cost(i, r):
            now, left = self.cost(i, r), 0 if r == 1 else 1
            if i < len(self.turns) and DELETE + self.cost(i + 1, r) == now:
                out.append("D")
                i += 1
            elif INSERT + self.cost(i, left) == now:
                out.append("I")
                r = left
            else:
                out.append(_kept(self.turns[i], "a" if r == 1 else "u")[1])
                i, r = i + 1, left
        return "".join(out)


def align(turns: list[Turn], long_turns: int = LONG_TURNS) -> tuple[int, str]:
    """Least cost and ASCII-least audit of the repairs of a conversation."""
    table = _Table(turns) if len(turns) <= long_turns else _Folded(turns)
    found = [(c, -1, r) for c, r in table.ends(0, 0)]
    for p, t in enumerate(turns):  # a kept system turn, all before it deleted
        if t.initial == "s" and not t.must_go:
            found += [(DELETE * p + _kept(t, "s")[0] + c, p, r) for c, r in table.ends(p + 1, 2)]
    least = min(f[0] for f in found)
    # of equal costs, more deletions first are ASCII-less, so one system turn will do
    last = max(p for c, p, _ in found if c == least)
    audits = ["D" * p + "K" * (p >= 0) + table.trace(p + 1, r) for c, p, r in found if c == least and p in (-1, last)]
    return least, min(audits)


def wanted(audit: str) -> Iterator[tuple[str, str | None]]:
    """Each edit's initial with the role initial that it makes, if any."""
    place = -((len(audit) - audit.count("D")) % 2)  # an odd number begins with a system turn
    for edit in audit:
        if edit == "D":
            yield edit, None
        else:
            yield edit, "s" if place < 0 else "ua"[place % 2]
            place += 1


class _Conversation:
    """What is known of a conversation before its texts come."""

    def __init__(self, name) -> None:
        self.name = name
        self.turns: list[Turn] = []
        self.seen: set[bytes] = set()
        self.numbers: tuple[int, int, int] | None = None  # least, greatest, distinct
        self.counts = dict.fromkeys(COUNTS, 0)
        self.audit: str | None = None

    def note(self, turn: int | None, initial: str, blank: bool, cut_off: bool, digest: bytes) -> None:
        again = digest in self.seen
        self.seen.add(digest)
        fault = "blank" if blank else "duplicate" if again else "truncated" if cut_off else None
        if fault:
            self.counts[fault] += 1
        if self.turns and self.turns[-1].initial + initial not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.turns.append(Turn(initial, blank or again, fault == "truncated"))
        if turn is not None:
            low, high, n = self.numbers or (turn, turn - 1, 0)
            self.numbers = low, turn, n + (turn != high)

    def settle(self) -> None:
        if self.audit is None:
            self.seen.clear()
            if self.numbers:
                low, high, n = self.numbers
                self.counts["gaps"] = high - low + 1 - n
            self.counts["cost"], self.audit = align(self.turns)
            self.edits = wanted(self.audit)
            self.place = 0
            self.turns.clear()

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        """Edits up to the next turn's own, which is left in ``own``."""
        self.own: tuple[str, str | None] | None = None
        for edit, role in self.edits:
            if edit != "I":
                self.own = edit, role
                return
            yield ROLES[role], "", edit

    def repaired(self, role: str | None = None, text: str | None = None) -> Iterator[tuple[str, str, str]]:
        """Repaired turns (role, text, edit) before and with the next turn, or
        after the last if no role is given."""
        self.settle()
        yield from self._inserted()
        if role is not None and self.own[0] != "D":
            yield (ROLES[self.own[1]] if self.own[0] == "R" else role), text, self.own[0]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, Iterator[tuple[str, str, str]]]]:
    """Each conversation with some of its repaired turns, in order; the last
    time with ``None``."""
    now = None
    for batch in batches:
        for name, phase, turn, role, text, blank, cut_off, digest in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or name != now.name:
                if now is not None:
                    yield now, now.repaired()
                    yield now, None
                now = _Conversation(name)
            if phase == 0:
                now.note(turn, role[:1], blank, cut_off, digest)
            elif phase == 1:
                yield now, now.repaired(role, text)
    if now is not None:
        yield now, now.repaired()
        yield now, None


def _audits(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(len(COUNTS) + 3)]
        digest, begun = hashlib.sha256(), False

        def flush() -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds)], names=["conv_id", *COUNTS, "audit", "repaired_sha256"])
            for c in out:
                c.clear()
            return made

        for conversation, turns in _conversations(batches):
            if turns is not None:
                for role, text, _ in turns:
                    digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                    begun = True
                continue
            row = [conversation.name, *conversation.counts.values(), conversation.audit, digest.hexdigest()]
            for c, x in zip(out, row):
                c.append(x)
            digest, begun = hashlib.sha256(), False
            if len(out[0]) >= 10_000:
                yield flush()
        yield flush()

    return run


def _turns(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", kind), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
        out: list[tuple] = []
        size = 0
        for conversation, turns in _conversations(batches):
            for role, text, edit in turns or ():
                out.append((conversation.name, conversation.place, role, text, edit))
                conversation.place += 1
                size += len(text)
            if len(out) >= 10_000 or size > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults by a checksum of ``conv_id:turn`` modulo 20: 0 drops
    the row (``alive`` false), 1 empties the text, 2 removes its sentence ends, 3
    repeats the row, 4 makes the role user."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.encode(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")), "utf-8")) % 20
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("whose"))
    return conversations.select("conv_id", "turn", spaced("role").alias("whose"), spaced("text").alias("said"), code.alias("code")).select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("code") != 0).alias("alive"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1)))).drop("col")


def _dealt(turns: DataFrame) -> DataFrame:
    """Rows as the tasks read them: phase 0 without text, phase 1 with it; a
    row that was dropped only names its conversation."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    end = F.regexp_extract(text, f"([^\\x20\\x09-\\x0D]){SPACE}*\\z", 1)
    alive: Column = F.col("alive") if "alive" in turns.columns else F.lit(True)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("said"), alive.alias("alive"),
                        end.alias("end"), F.unhex(F.md5(F.concat(role, F.lit("\0"), text))).alias("digest"))
    phases = F.when(F.col("alive"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(-1)))
    rows = rows.withColumn("phase", F.explode(phases)).select(
        "conv_id", "phase", "turn", "role", F.when(F.col("phase") == 1, F.col("said")).alias("text"),
        (F.col("end") == "").alias("blank"), (~F.col("end").isin(*ENDS)).alias("cut_off"), "digest")
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "phase", "turn", "role", "digest")


def _kinds(turns: DataFrame):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = turns.schema["conv_id"].dataType
    return kind, to_arrow_type(kind)


def audited(turns: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit and the SHA-256
    of the repaired turns (``role:text``, joined by newlines)."""
    prepared(turns)
    kind, arrow = _kinds(turns)
    return _dealt(turns).mapInArrow(_audits(arrow), StructType(
        [StructField("conv_id", kind)] + [StructField(c, LongType()) for c in COUNTS]
        + [StructField("audit", StringType()), StructField("repaired_sha256", StringType())]))


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired turns: (conv_id, place, role, text, edit)."""
    prepared(turns)
    kind, arrow = _kinds(turns)
    return _dealt(turns).mapInArrow(_turns(arrow), StructType([
        StructField("conv_id", kind), StructField("place", LongType()), StructField("role", StringType()),
        StructField("text", StringType()), StructField("edit", StringType())]))
