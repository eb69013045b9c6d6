"""Conversation repair against a plain search over all edits that keeps the strings themselves."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tastemine.llm import conversation_repair as repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, at string, fault int, cost double, `last` int"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}


def _with_inserts(ways):
    """All ways with up to three inserts behind them; a way is (state, cost, audit, lines)."""
    out, layer = [], list(ways)
    for _ in range(4):
        out += layer
        layer = [(NEXT[p, i], c + 3, a + "I", (*lines, FULL[i] + ":")) for p, c, a, lines in layer for i in "ua" if (p, i) in NEXT]
    return out


def _cheapest(rows):
    """(cost, audit, lines) of rows (role, text, fault)."""
    ways = [("", 0, "", ())]
    for role, text, fault in rows:
        best = {}
        for p, c, a, lines in _with_inserts(ways):
            own = [(p, c + 4, a + "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if (p, role[:1]) in NEXT:
                    own.append((NEXT[p, role[:1]], c + extra, a + "K", (*lines, f"{role}:{text}")))
                own += [(NEXT[p, i], c + extra + 3, a + "R", (*lines, f"{FULL[i]}:{text}")) for i in "ua" if (p, i) in NEXT]
            for way in own:
                if way[0] not in best or way[1:3] < best[way[0]][1:3]:
                    best[way[0]] = way
        ways = list(best.values())
    return min(way[1:] for way in _with_inserts(ways) if way[0] in ("", "a"))


def _brute(rows):
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        for copy in range(2 if hit == 3 else 1):
            found[conv].append((turn is not None, turn or 0, role, text[:64], hashlib.sha256(text.encode()).hexdigest(), copy, text))
    out = {}
    for conv, own in found.items():
        own.sort()
        seen, faults = set(), []
        for _, _, role, _, _, _, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own if r[0]}
        initials = [r[2][:1] for r in own]
        cost, audit, lines = _cheapest([(r[2], r[6], f) for r, f in zip(own, faults, strict=True)])
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def _rows():
    rng = random.Random(5)
    roles, weights = ["user", "assistant", "system", "tool", "", None, "u", "unknown"], [8, 8, 3, 1, 1, 1, 1, 1]
    texts = ["a.", "b", "c!", " ", None, "", "d? ", "e.\n", "f.", "g.", "é\x1c", "x" * 5000 + ".", *[f"{k}." for k in range(12)]]
    rows = []
    for conv in [*range(60), None]:
        n = rng.choice([1, 2, 3, 5, 8, 40])
        rows += [(conv, rng.choice([t, t, t, t + 3, None]), rng.choices(roles, weights)[0], rng.choice(texts)) for t in range(n)]
    rows += [(1000, t, rng.choices(roles, weights)[0], f"{rng.randint(0, 600)}" + rng.choice([".", "?", "", "."])) for t in range(700)]  # spans blocks
    rows += [(2000, 0, "user", "again.")] * 30  # all alike
    gone = next(t for t in range(200) if zlib.crc32(f"3000:{t}".encode()) % 20 == 0)
    rows += [(3000, gone, "user", "dropped.")] + rows[:20]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [2048, 16, 4])
def test_repair_is_the_cheapest(spark, monkeypatch, block):
    monkeypatch.setattr(repair.states, "__defaults__", (block,))
    monkeypatch.setattr(repair.repair, "__defaults__", (block,))
    rows = _rows()
    df = spark.createDataFrame([(*r, "x", "y", 1, 2.0, 3) for r in rows], SCHEMA).repartition(5)
    out = repair.summary(df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in out.collect()]
    expected = _brute(rows)
    assert len(got) == len(expected)
    assert {r[0]: r[1:] for r in got} == expected
    assert expected[3000] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_hirschberg_against_all_paths():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 20, 33):
        kinds = rng.integers(0, len(repair.KINDS), n)
        cost, rank = repair.COST[kinds], repair.RANK[kinds]
        after = repair.solve(np.array([0]), np.array([n]), np.array([0]), repair.END_COST[None], cost, rank)
        audit, at, total = "", 0, 0
        for kind, s in zip(kinds, after, strict=True):
            c, edits, _, _ = repair.EDITS[kind][at, s]
            audit, at, total = audit + edits, s, total + c
        audit, total = audit + "I" * repair.END[at], total + repair.END_COST[at]
        fault = {"fine": "", "truncated": "truncated", "must go": "blank"}
        rows = [(repair.KINDS[k][0], "", fault[repair.KINDS[k][1]]) for k in kinds]
        assert (total, audit) == _cheapest(rows)[:2]


def test_empty_table(spark):
    assert repair.summary(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r)[1:] for r in repair.query(spark, sf).collect()} == _brute(rows)
