"""Repairs against all repairs of short conversations, and against a plain forward search."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256
from itertools import product

import pytest
from pyspark.sql import functions as F

from lisan.llm import repair
from lisan.llm.queries import repaired

SPACE = "\t\n\x0b\x0c\r "
SCHEMA = "conv_id long, turn int, role string, text string, key string, seq int, copy int, audit string"
AFTER = {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
ROLE = {"u": "user", "a": "assistant"}


def damaged(rows: list[tuple]) -> dict:
    """Rows after damage by conversation, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        out[conv]
        if kind:
            new = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            for copy in range(2 if kind == 3 else 1):
                out[conv].append(((turn is not None, turn or 0, role, text, copy), turn, "user" if kind == 4 else role, new))
    return {conv: [r[1:] for r in sorted(found, key=lambda r: r[0])] for conv, found in out.items()}


def faults(turns: list[tuple]) -> list[str]:
    out, seen = [], set()
    for _, role, text in turns:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns: list[tuple], found: list[str]) -> tuple[int, str, list[str]]:
    """Forward search over whole edit strings; equal costs keep the least string."""
    best = {"": (0, "", [])}

    def inserted(states: dict) -> dict:
        out = dict(states)
        for _ in range(4):
            for state, (cost, audit, said) in list(out.items()):
                new = NEXT[state]
                step = (cost + 2, audit + "I", said + [ROLE[new] + ":"])
                if new not in out or step[:2] < out[new][:2]:
                    out[new] = step
        return out

    for (_, role, text), fault in zip(turns, found):
        after: dict = {}
        for state, (cost, audit, said) in inserted(best).items():
            more = fault == "truncated"
            steps = [(state, cost + 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in AFTER:
                    steps.append((role[:1], cost + more, "K", [f"{role}:{text}"]))
                steps.append((NEXT[state], cost + 2 + more, "R", [f"{ROLE[NEXT[state]]}:{text}"]))
            for new, price, edit, line in steps:
                step = (price, audit + edit, said + line)
                if new not in after or step[:2] < after[new][:2]:
                    after[new] = step
        best = after
    ended = inserted(best)
    return min((ended[s] for s in ("", "a") if s in ended), key=lambda e: e[:2])


def every(turns: list[tuple], found: list[str]) -> tuple[int, str]:
    """All edit strings with at most two inserts before each turn and at the end."""
    out = []
    gaps = len(turns) + 1
    for inserts in product(range(3), repeat=gaps):
        for edits in product("DKR", repeat=len(turns)):
            state, cost, audit, right = "", 0, "", True
            for k in range(gaps):
                for _ in range(inserts[k]):
                    state, cost, audit = NEXT[state], cost + 2, audit + "I"
                if k == len(turns):
                    break
                edit, role = edits[k], turns[k][1]
                if edit != "D":
                    right = right and found[k] not in ("blank", "duplicate") and (edit == "R" or (state, role[:1]) in AFTER)
                    cost += found[k] == "truncated"
                    if not right:
                        break
                    state = role[:1] if edit == "K" else NEXT[state]
                cost, audit = cost + {"D": 3, "K": 0, "R": 2}[edit], audit + edit
            if right and state in ("", "a"):
                out.append((cost, audit))
    return min(out)


def conversations(seed: int, most: int = 9) -> list[tuple]:
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u", "Assistant"]
    texts = ["Yes.", "No!", "so", "a? ", "...", "", " \n", None, "Why?", "fine.\n", "end. ", "x" * 5_000 + "."]
    rows = []
    for conv in range(60):
        turn = 0
        for _ in range(r.randrange(most)):
            turn += r.choice([0, 1, 1, 1, 3])
            rows.append((conv, r.choice([turn] * 9 + [None]), r.choice(roles), r.choice(texts)))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Hi."), (None, None, None, None)]
    return rows


def want(rows: list[tuple]) -> set[tuple]:
    out = set()
    for conv, turns in damaged(rows).items():
        found = faults(turns)
        cost, audit, said = cheapest(turns, found) if turns else (0, "", [])
        at = [t for t, _, _ in turns if t is not None]
        gaps = max(at) - min(at) + 1 - len(set(at)) if at else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        counts = [found.count(f) for f in ("blank", "duplicate", "truncated")]
        out.add((conv, gaps, *counts, illegal, cost, audit, sha256("\n".join(said).encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", [1, 2])
def test_repairs(spark, seed):
    rows = conversations(seed)
    df = spark.createDataFrame([(*r, "x", 1, 2, "z") for r in rows], SCHEMA)
    got = repaired(df).select(*COLUMNS).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {tuple(r) for r in got} == want(rows)


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_and_least(seed):
    """Steps from the end, one byte a turn, give the least of all repairs."""
    r = random.Random(seed)
    turns = [(k, r.choice(["user", "assistant", "system", "tool"]), r.choice(["A.", "b", "", "C!"])) for k in range(r.randrange(1, 4))]
    found = faults(turns)
    costs, last = repair.ends()
    total, pointers, kinds = 0, [], []
    for (_, role, _), fault in zip(turns[::-1], found[::-1]):
        kind = "sua".find(role[0]) if role[0] in "sua" else repair.OTHER
        costs, more, packed = repair.step(costs, kind, ["", "blank", "duplicate", "truncated"].index(fault))
        total += more
        pointers.append(packed), kinds.append(kind)
    audit = "".join(repair.follow(reversed(pointers), reversed(kinds), last))
    assert (total + costs[0], audit) == every(turns, found) == cheapest(turns, found)[:2]


def test_pointers_go_to_a_file_and_come_back():
    pointers = repair.Pointers(held=7)
    for k in range(100):
        pointers.add(k)
    assert pointers.file is not None and len(pointers.bytes) < 7
    assert list(pointers.from_last()) == list(range(99, -1, -1))
    pointers.clear()
    assert list(pointers.from_last()) == []


def test_a_giant_conversation_over_many_batches(spark):
    rows = [(1, t, ["user", "assistant", "tool"][t % 3], "Go on." if t % 7 else f"stop {t}") for t in range(3_000)]
    rows += [(2, t, "user", "ok") for t in range(1_000)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame([(*r, "x", 1, 2, "z") for r in rows], SCHEMA)
        got = repaired(df).select(*COLUMNS).collect()
        turns = repair.numbered(repair.damage(df))
        spilled = repair.audits(turns, turns.select("key").distinct(), held=50).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {tuple(r) for r in got} == want(rows)
    assert {r.audit for r in spilled} == {r.audit for r in got}


def test_repaired_turns_follow_the_pattern(spark):
    df = spark.createDataFrame([(*r, "x", 1, 2, "z") for r in conversations(5)], SCHEMA)
    turns = repair.repair(df)[1].groupBy("key").agg(F.sort_array(F.collect_list(F.struct("at", "role"))).alias("t"))
    for row in turns.collect():
        roles = "".join(t["role"][0] for t in row["t"])
        assert [t["at"] for t in row["t"]] == list(range(1, len(roles) + 1))
        assert set(roles.removeprefix("s").replace("ua", "")) == set() and len(roles) > 1


def test_nothing(spark):
    assert repaired(spark.createDataFrame([], SCHEMA)).count() == 0
    dropped = next(t for t in range(1_000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(7, dropped, "user", "Hi.", "", 1, 2, "")], SCHEMA)).select(*COLUMNS).collect()
    assert [tuple(r) for r in got] == [(7, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
