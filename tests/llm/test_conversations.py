"""Conversation repair against plain shortest paths."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rivulet.llm import conversation_repair as repairs

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(roles, flaws):
    """Least (cost, audit) over all edit paths, row by row."""
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    states = {0: (0, "")}

    def insert(states):
        for _ in range(3):
            for s, (cost, audit) in list(states.items()):
                to = 3 if s == 2 else 2
                states[to] = min(states.get(to, (1 << 40, "")), (cost + 2, audit + "I"))
        return states

    for role, flaw in zip(roles, flaws, strict=True):
        after = {}
        for s, (cost, audit) in insert(states).items():
            moves = [(s, 3, "D")]
            if flaw not in (repairs.BLANK, repairs.DUPLICATE):
                more = int(flaw == repairs.TRUNCATED)
                moves.append((3 if s == 2 else 2, 2 + more, "R"))
                if role in follow[s]:
                    moves.append((follow[s][role], more, "K"))
            for to, price, edit in moves:
                after[to] = min(after.get(to, (1 << 40, "")), (cost + price, audit + edit))
        states = after
    ends = insert(states)
    return min(ends.get(s, (1 << 40, "")) for s in (0, 3))


def brute_report(rows):
    """The whole result in plain Python."""
    out = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if v is None else v for v in (role, text))
            key = ":".join(" " if v is None else str(v) for v in (conv, turn))
            kind = zlib.crc32(key.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        flaws, seen = [], set()
        for _, role, text in own:
            shown = text.strip(" \t\n\v\f\r")
            blank, again = not shown, (role, text) in seen
            seen.add((role, text))
            flaws.append(1 if blank else 2 if again else 0 if shown[-1] in ".!?" else 3)
        roles = [r[1][:1] for r in own]
        cost, audit = plain_repair(roles, flaws)
        lines, state, left = [], 0, list(own)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else left.pop(0)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        turns = {t for t, _, _ in own if t is not None}
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(flaws.count(k) for k in (1, 2, 3)),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def report(spark, rows, block=64):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("key", "fault", "audit", "part", "again")})
    got = repairs.repair_conversations(repairs.damaged(df), block).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_search_finds_the_least_path(block):
    rng = random.Random(block)
    for _ in range(600):
        n = rng.randrange(0, 12)
        roles = rng.choices(["u", "a", "s", "x", ""], weights=[5, 5, 2, 1, 1], k=n)
        flaws = bytes(rng.choices([0, 1, 2, 3], weights=[6, 1, 1, 2], k=n))
        assert repairs.repair(roles, flaws, block) == plain_repair(roles, flaws)


def test_long_conversations_take_linear_time():
    n = 30_000
    assert repairs.repair(["u"] * n, bytes(n))[0] == n
    assert repairs.repair(["s"] * 5000, bytes([3]) * 5000, 64) == repairs.repair(["s"] * 5000, bytes([3]) * 5000, 16)


@pytest.mark.parametrize("block", [2, 64])
def test_reports(spark, block):
    rng = random.Random(5)
    words = ["Yes.", "No!", "Why?", "and then", "", " \t\n", "ü 字.", "ends. \n", None]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choices(["user", "assistant", "system", None, "", "tool"], weights=[6, 6, 2, 1, 1, 1])[0]
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), role, rng.choice(words) if turn % 3 else f"t{turn}."))
    rows += rows[::17]
    rows += [(None, t, "user", "hello.") for t in (None, None, 4, 5, -(2**63), 2**63 - 1)]
    rows += [(1 << 40, 0, "user", "long " * 400_000), (1 << 40, 1, "assistant", "x" * 1_000_000 + ".")]
    assert report(spark, rows, block) | {None: ()} == brute_report(rows) | {None: ()}
    null = report(spark, rows, block)[None]
    assert null[0] == min(brute_report(rows)[None][0], 2**63 - 1) and null[1:] == brute_report(rows)[None][1:]


def test_dropped_and_no_conversations(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert report(spark, [(gone, 0, "user", "Hello.")]) == {gone: (0, 0, 0, 0, 0, 0, "", empty)}
    df = spark.createDataFrame([], SCHEMA)
    assert repairs.repair_conversations(repairs.damaged(df)).count() == 0


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t % 50}.") for t in range(4000)]
    rows += [(c, 0, "user", "Hi.") for c in range(100, 200)]
    assert report(spark, rows) == brute_report(rows)
