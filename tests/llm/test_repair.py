from __future__ import annotations

import collections
import hashlib
import heapq
import random
import re
import zlib

import pytest

from tarmac.llm import repair
from tarmac.llm.repair import Turn

SCHEMA = "conv_id long, turn long, role string, text string, audit string, cost string"
SPACE = " \t\n\v\f\r"
#: States of the grammar: start, after s, u expected or end, a expected.
STEPS = {("start", "s"): "s", ("start", "u"): "a", ("s", "u"): "a", ("a", "a"): "end", ("end", "u"): "a"}


def plain_align(turns):
    """(cost, audit) by Dijkstra's search over turns read and grammar states."""
    heap = [(0, "", 0, "start", ())]
    done = set()
    while heap:
        cost, audit, i, state, roles = heapq.heappop(heap)
        if i == len(turns) and state in ("start", "end"):
            return cost, audit, roles
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in "sua":
            after = STEPS.get((state, role))
            if after is None:
                continue
            if role != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", i, after, (*roles, role)))
            if i < len(turns) and not turns[i].must_go:
                fits = turns[i].initial == role
                if fits or role != "s":
                    heapq.heappush(heap, (cost + 3 * (not fits) + 3 * turns[i].truncated, audit + "KR"[not fits], i + 1, after, (*roles, role)))
        if i < len(turns):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, roles))


def plain(rows):
    """Results by conversation, from the rules alone."""
    out, by = {}, collections.defaultdict(list)
    for i, n, role, text in rows:
        spaced = [" " if x is None else str(x) for x in (i, n)]
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(":".join(spaced).encode()) % 20
        by[i]
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        if code:
            by[i] += [(n, role, text)] * (1 + (code == 3))
    for i, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(f"{t[1]}\0{t[2]}".encode()).digest()))
        seen, made, count = set(), [], collections.Counter()
        for _, role, text in turns:
            said = text.strip(SPACE)
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "none"
            seen.add((role, text))
            count[fault] += 1
            made.append(Turn(role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(made, made[1:]))
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit, roles = plain_align(made)
        roles, rest, lines = iter(roles), iter(turns), []
        for edit in audit:
            turn = next(rest) if edit != "I" else None
            role = next(roles) if edit != "D" else None
            if edit == "K":
                lines.append(f"{turn[1]}:{turn[2]}")
            elif edit != "D":
                lines.append(f"{dict(u='user', a='assistant')[role]}:{turn[2] if turn else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[i] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest)
    return out


def result(df):
    rows = repair.audited(repair.damaged(df)).collect()
    out = {r.conv_id: (*(r[c] for c in repair.COUNTS), r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def random_turns(rng, n):
    return [Turn(rng.choice("suauaux"), rng.random() < 0.15, False) if rng.random() < 0.7 else Turn(rng.choice("ua"), False, True) for _ in range(n)]


@pytest.mark.parametrize("long_turns", [0, 1000])
def test_least_cost_and_least_audit(long_turns):
    rng = random.Random(11)
    for at in range(1500):
        turns = random_turns(rng, rng.randint(0, 12) if at % 50 else rng.randint(30, 60))
        assert repair.align(turns, long_turns) == plain_align(turns)[:2], turns


def test_folded_table_like_the_full_one():
    rng = random.Random(12)
    for _ in range(20):
        turns = random_turns(rng, 300)
        assert repair.align(turns, 0) == repair.align(turns, 300)


def test_long_conversation_in_linear_time():
    turns = random_turns(random.Random(13), 200_000)
    cost, audit = repair.align(turns)
    assert len(audit.replace("I", "")) == len(turns) and cost > 0


def rows_of(seed, conversations):
    rng = random.Random(seed)
    out = []
    for i in range(conversations):
        for n in range(rng.randint(1, 9)):
            if rng.random() < 0.05:
                continue
            role = "system" if not n and rng.random() < 0.3 else ["user", "assistant"][(n + (rng.random() < 0.1)) % 2]
            text = rng.choice(["Yes.", "No!", "what", "A line.\nAnd more? ", "\t", "it ends. \x85", "é!", "same."]) + rng.choice(["", "", " more words."])
            out.append((i, n if rng.random() > 0.03 else None, role, text))
    return out


def test_like_plain_version(spark):
    rows = rows_of(3, 400)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert result(df) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "a."), (None, None, "assistant", "b."), (None, None, None, None), (1, None, "user", "q?"), (1, None, "assistant", "r."),
            (2, 0, "", "x."), (2, 1, "User", "x."), (2, 2, "assistant", ""), (3, -5, "user", "x."), (3, 10**12, "assistant", "y."),
            (4, 0, "user", "same."), (4, 0, "user", "same."), (4, 0, "user", "same."), (5, 0, "system", "only."),
            (6, 0, "system", "s."), (6, 1, "system", "t."), (6, 2, "user", "u."), (6, 3, "assistant", "v"),
            (7, 0, "user", "long " * 200_000 + "."), (7, 1, "assistant", "x" * 100_000)]
    rows += [(i, 0, "user", "x.") for i in range(20, 80)]  # some lose their only row
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = result(df)
    assert got == plain(rows)
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values()


def test_a_third_of_all_rows_in_one_conversation(spark):
    rng = random.Random(9)
    rows = [(1, n, rng.choice(["user", "assistant"]), f"t {rng.randrange(900)}.") for n in range(1500)] + rows_of(4, 500)[:3000]
    assert result(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)) == plain(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.audited(repair.damaged(none)).count() == 0
    assert repair.repaired(none).count() == 0


def test_repaired_turns_and_digest_agree(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows_of(5, 100)], SCHEMA)
    by = collections.defaultdict(list)
    for r in repair.repaired(df).collect():
        by[r.conv_id].append((r.place, r.role, r.text))
    for r in repair.audited(df).collect():
        turns = sorted(by[r.conv_id])
        assert [t[0] for t in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(t[1][:1] for t in turns))
        assert hashlib.sha256("\n".join(f"{t[1]}:{t[2]}" for t in turns).encode()).hexdigest() == r.repaired_sha256
