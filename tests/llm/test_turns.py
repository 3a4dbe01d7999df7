"""Conversation repair against plain restatements and exhaustive search."""

import hashlib
import random
import re
import zlib

import pytest

from daybook.llm import turns


def damaged(rows):
    """Plain restatement of the damage: (conv_id, turn, role, text) rows."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every script: rows are (role, text, fault)."""
    best = None
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    stack = [(0, "", "", 0, ())]
    while stack:
        i, state, audit, cost, out = stack.pop()
        if best and cost > best[0]:
            continue
        if i == len(rows) and state in ("", "a"):
            best = min(best or (cost, audit, out), (cost, audit, out))
        to = step[state]
        if len(audit) - i < len(rows) + 4 and cost + 2 <= 3 * len(rows):
            stack.append((i, to, audit + "I", cost + 2, out + ({"u": "user", "a": "assistant"}[to] + ":",)))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        stack.append((i + 1, state, audit + "D", cost + 3, out))
        if fault in ("blank", "duplicate"):
            continue
        more = fault == "truncated"
        if (role[:1] == "s" and state == "") or role[:1] == to:
            stack.append((i + 1, role[:1], audit + "K", cost + more, out + (f"{role}:{text}",)))
        stack.append((i + 1, to, audit + "R", cost + 2 + more, out + ({"u": "user", "a": "assistant"}[to] + ":" + text,)))
    return best


def restated(rows):
    result = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        seen, faulty = set(), []
        for _, _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            faulty.append((role, text, fault))
        numbers = {r[1] for r in mine if r[1] is not None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, out = cheapest(faulty)
        result[conv] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
                        *[sum(f[2] == k for f in faulty) for k in ("blank", "duplicate", "truncated")],
                        illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return result


def answer(df):
    rows = df.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[c] for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in rows}


SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "system", "tool", "", None, "ünder"]
TEXTS = ["Yes.", "no", "Ok! ", " \n", "", None, "What?", "a\x0b", "\x85", "z" * 3000 + "."]


def random_rows(seed, conversations):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randint(1, 5)):
            turn += rng.choice([0, 1, 1, 1, 3])
            rows.append((conv, rng.choice([turn] * 9 + [None]), rng.choice(ROLES[:3] * 3 + ROLES[3:]), rng.choice(TEXTS)))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize("fragment", [65_536, 2])
def test_against_exhaustive_search(spark, monkeypatch, fragment):
    rows = random_rows(7, 150)
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "So?"), (2 ** 60, None, None, None)]
    want = restated(rows)
    monkeypatch.setattr(turns, "FRAGMENT", fragment)
    assert answer(turns.op11_turns(spark.createDataFrame(rows, SCHEMA))) == want


def test_audit_against_exhaustive_search():
    rng = random.Random(3)
    faults = {"x": "blank"}
    names = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
    for _ in range(400):
        symbols = "".join(rng.choice("suaoxSUAO") for _ in range(rng.randint(0, 6)))
        rows = [(names.get(c.lower(), "user"), "t", faults.get(c, "truncated" if c.isupper() else "")) for c in symbols]
        assert turns.audit(symbols) == cheapest(rows)[:2], symbols


def test_runs_equal_single_rows():
    rng = random.Random(5)
    for _ in range(200):
        runs = [(rng.choice("suaoxSUAO"), rng.randint(1, 40)) for _ in range(rng.randint(1, 5))]
        symbols = "".join(s * n for s, n in runs)
        after = turns.END
        for s, n in reversed(runs):
            after = turns.run_back(s, n, after)
        text, _ = turns.unroll("".join(s for s, _ in runs), [n for _, n in runs], 0, turns.END, True)
        assert (after[0], text) == turns.audit(symbols)


def test_one_conversation_over_many_partitions(spark, monkeypatch):
    """A conversation with most rows is split over partitions and fragments; equal rows collapse."""
    rows = [(1, t, ROLES[t % 3], f"text {t % 61}.") for t in range(600)] + [(1, 900, "user", "same.")] * 300 + [(0, 1, "user", "a."), (2, 1, "user", "b.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = answer(turns.op11_turns(frame))
    monkeypatch.setattr(turns, "FRAGMENT", 7)
    assert answer(turns.op11_turns(frame.repartition(9))) == whole
    cost, audit = whole[1][5], whole[1][6]
    assert len([c for c in audit if c != "I"]) == len([r for r in damaged(rows) if r[0] == 1])
    assert 0 <= cost - sum({"D": 3, "K": 0, "R": 2, "I": 2}[c] for c in audit) <= whole[1][3]


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turns.op11_turns(empty).collect() == []
    rows = [(1, 1, "user", "Hi.", "x", 3), (1, 2, "assistant", "So.", "x", 3)]
    wide = spark.createDataFrame(rows, SCHEMA + ", digest string, n int")
    assert answer(turns.op11_turns(wide)) == restated([r[:4] for r in rows])


def test_conversation_dropped_whole(spark):
    gone = next((c, 1) for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    got = answer(turns.op11_turns(spark.createDataFrame([(*gone, "user", "Hi.")], SCHEMA)))
    assert got == {gone[0]: (0, 0, 0, 0, 0, 0, "", turns.EMPTY_SHA256)}
