import hashlib
import random
import re
from functools import lru_cache
from itertools import groupby
from zlib import crc32

import numpy as np
import pytest

from tests.conftest import SF_MID
from zonepulse.llm import repair as R
from zonepulse.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, place long, block long, h int, edits int"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA).repartition(parts)


def plain(rows, hurt=True):
    """Another way: one search over (row, state) with whole audit strings."""
    out = {}
    for c in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == c):
            role, text = " " if role is None else role, " " if text is None else text
            d = crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20 if hurt else 9
            if d == 1:
                text = ""
            if d == 2:
                text = re.sub("[.!?]", "", text)
            if d == 4:
                role = "user"
            mine += [(turn is not None, turn or 0, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
        mine.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        faults, seen = [], set()
        for _, _, role, text in mine:
            left = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
            seen.add((role, text))
        n = len(mine)
        ways = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

        @lru_cache(None)
        def best(i, state, inserted=0):
            found = []
            if i == n and state in ("", "a"):
                found.append((0, "", ()))
            if inserted < 3:
                for x in "ua":
                    if x in ways[state]:
                        cost, audit, turns = best(i, x, inserted + 1)
                        found.append((5 + cost, "I" + audit, (f"{R.ROLES[x]}:", *turns)))
            if i < n:
                _, _, role, text = mine[i]
                cost, audit, turns = best(i + 1, state)
                found.append((2 + cost, "D" + audit, turns))
                if faults[i] not in ("blank", "duplicate"):
                    stay = 5 if faults[i] == "truncated" else 0
                    if role[:1] in ways[state]:
                        cost, audit, turns = best(i + 1, role[:1])
                        found.append((stay + cost, "K" + audit, (f"{role}:{text}", *turns)))
                    for x in "ua":
                        if x in ways[state]:
                            cost, audit, turns = best(i + 1, x)
                            found.append((stay + 1 + cost, "R" + audit, (f"{R.ROLES[x]}:{text}", *turns)))
            return min(found, default=(10**9, "", ()))

        for i in range(n, -1, -1):  # from the end, so no recursion goes deep
            for state in ways:
                best(i, state)
        cost, audit, turns = best(0, "")
        numbers = [t for known, t, _, _ in mine if known]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        roles = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        counts = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
        out[c] = (c, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return sorted(out.values(), key=str)


def found(df, damage=R.damaged):
    return sorted(map(tuple, R.report(df, damage).collect()), key=str)


ROLES = ["user", "assistant", "system", "tool", "", None, "u", "agent"]
TEXTS = ["Hi.", "Well?", "cut off", "", " \t\n", None, "So! \r\n", "mid.dle", "é.", "é", "x" * 5000 + "."]


def made_up(seed, conversations, most):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, most)):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.7 else rng.choice(ROLES)
            rows.append((c, rng.choice([t, t, t, t + 2, None]), role, rng.choice(TEXTS) if rng.random() < 0.5 else f"Turn {t}."))
    return rows + [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (None, None, "system", None)] + rows[:5] * 2


@pytest.mark.parametrize("block,hurt", [(4096, True), (3, True), (3, False)])
def test_equals_a_plain_search(spark, monkeypatch, block, hurt):
    monkeypatch.setattr(R, "BLOCK", block)
    rows = made_up(block, 120, 14)
    assert found(frame(spark, rows), R.damaged if hurt else None) == plain(rows, hurt)


def test_the_query_equals_a_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op11_conversation_repair"](spark, SF_MID).collect()), key=str)
    assert got == plain(rows) and len(got) > 90


def test_a_conversation_of_many_rows_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 64)
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{t}" + rng.choice([".", "", "!"])) for t in range(400)]
    rows += [(1, 7, "user", "again.")] * 300 + [(2, 0, "user", "One."), (2, 1, "assistant", "Two.")]
    assert found(frame(spark, rows), None) == plain(rows, False)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 50, 200])
def test_checkpoints_change_no_edit(n):
    """The walk from square-root checkpoints against all vectors at once."""
    rng = random.Random(n)
    codes = bytes(rng.randrange(12) for _ in range(n))
    times = np.array([rng.choice([1, 1, 1, 4]) for _ in range(n)], "<i8")
    for state in R.STATES:
        vectors, v = [R.FINISH], R.FINISH
        for i in reversed(range(n)):
            v = R.before(codes[i], int(times[i]), v)
            vectors.append(v)
        vectors.reverse()
        steps = list(R.walk(codes, times, R.FINISH, state))
        audit = "".join(e for e, _, _ in steps)
        end = steps[-1][2] if steps else state
        kept = sum(5 for (e, _, _), c in zip(steps, codes) if c % 3 == R.SHORT and e.rstrip("D")[-1:] in ("K", "R"))
        cost = audit.count("R") + 2 * audit.count("D") + 5 * audit.count("I") + 5 * len(R.ending(end)) + kept
        assert cost == vectors[0][state]
        assert R.through(R.matrix(codes, times), R.FINISH)[state] == vectors[0][state]


def test_repaired_rows_and_edits(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", ""), (2, 0, "tool", "X."), (2, 1, "assistant", "Y.")]
    repaired, faults = R.repair(frame(spark, rows))
    got = [(r.conv_id, r.turn, r.edits, [tuple(t) for t in r.turns]) for r in repaired.orderBy("conv_id", "place").collect()]
    assert got == [
        (1, 0, "K", [("user", "A.")]),
        (1, 1, "R", [("assistant", "B.")]),
        (1, 2, "D", []),
        (2, 0, "R", [("user", "X.")]),
        (2, 1, "K", [("assistant", "Y.")]),
    ]
    assert sorted(map(tuple, faults.collect())) == [(1, 1, 0, 0, 1), (2, 0, 0, 0, 1)]


def test_no_rows(spark):
    assert found(frame(spark, [])) == []
    gone = next(c for c in range(100) if crc32(f"{c}:0".encode()) % 20 == 0)
    assert found(frame(spark, [(gone, 0, "user", "A.")])) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_a_very_long_text(spark):
    rows = [(1, 0, "user", ". " * 3_000_000), (1, 1, "assistant", " " * 3_000_000 + "x"), (1, 2, "assistant", "ok.")]
    assert found(frame(spark, rows), None) == plain(rows, False)
