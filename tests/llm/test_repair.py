"""Conversation repair against a plain search over all edits."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from tarjuman.llm import conversations
from tarjuman.llm.role_blocks import tables

WHITE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, lang string, cost string, audit int, `conv` string, at long"


def plain_edits(faults, roles):
    """The cheapest letters and the repaired roles, by a walk from the last row over four states."""
    states = ("", "s", "u", "a")
    done = {"": (0, "", ()), "a": (0, "", ())}

    def inserted(best):
        for _ in range(3):
            for state in states:
                name = "assistant" if state == "u" else "user"
                rest = best.get(name[0])
                if rest:
                    option = (rest[0] + 2, "I" + rest[1], (("I", name, None), *rest[2]))
                    best[state] = min(best.get(state, option), option, key=lambda x: x[:2])
        return best

    best = inserted(dict(done))
    for i in range(len(faults) - 1, -1, -1):
        gone, cut, role = faults[i] in ("blank", "duplicate"), faults[i] == "truncated", roles[i]
        now = {}
        for state in states:
            options = [(best[state][0] + 3, "D" + best[state][1], best[state][2])] if state in best else []
            if not gone:
                follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[:1] in follows and role[:1] in best:
                    rest = best[role[:1]]
                    options.append((rest[0] + cut, "K" + rest[1], (("K", role, i), *rest[2])))
                name = "assistant" if state == "u" else "user"
                rest = best[name[0]]
                options.append((rest[0] + 2 + cut, "R" + rest[1], (("R", name, i), *rest[2])))
            if options:
                now[state] = min(options, key=lambda x: x[:2])
        best = inserted(now)
    return best[""]


def plain_summary(rows):
    """The contract's row for the (turn, role, text) of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen
                      else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, kept = plain_edits(faults, [r[1] for r in rows])
    lines = [f"{name}:{'' if i is None else rows[i][2]}" for _, name, i in kept]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, everyone=None):
    frame = spark.createDataFrame([(*r, "en", "x", 1, "y", 2) for r in rows], SCHEMA)
    ids = spark.createDataFrame([(i,) for i in everyone or []], "conv_id long")
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in conversations.audit(frame, ids).collect()}
    own = {}
    for conv, *rest in rows:
        own.setdefault(conv, []).append(tuple(rest))
    want = {conv: plain_summary(r) for conv, r in own.items()}
    for conv in everyone or []:
        want.setdefault(conv, plain_summary([]))
    assert got == want


def test_blocks_equal_the_search_over_all_edits():
    roles = ["system", "user", "assistant", "tool"]
    for n in range(4):
        for own in itertools.product(range(9), repeat=n):
            faults = ["blank" if s == 8 else "truncated" if s % 2 else "" for s in own]
            letters, state = tables().trace(np.array(own, np.int64), 0, 0)
            audit = "".join(letters) + conversations.closing(state)
            assert audit == plain_edits(faults, [roles[min(s // 2, 3)] for s in own])[1], own


def test_random_conversations(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No!", "Why? ", "cut", " \n", "", None, "a.\t", "é?", "one. two"]
    rows = [
        (conv if conv else None, rng.choice([None, *range(9)]),
         rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "uncle"]), rng.choice(texts))
        for conv in range(120) for _ in range(rng.randint(1, 12))
    ]
    check(spark, rows, everyone=[5, 999, None])


def test_long_conversation_in_pieces(spark):
    """One conversation with most rows, over several pieces, with copies far apart."""
    rng = random.Random(9)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "assistant", "system"]), f"text {rng.randint(0, 900)}" + rng.choice([".", "", "!"]))
            for t in range(2600)]
    rows += [(2, 1, "user", "Hi."), (2, 2, "assistant", "Ho."), (3, 1, "system", "S.")]
    check(spark, rows)


def test_equal_rows_and_long_texts(spark):
    rows = [(7, 3, "user", "same.")] * 1300 + [(8, 0, "user", "w " * 300_000), (8, 1, "assistant", "y " * 300_000 + ".")]
    check(spark, rows)


def test_empty_table(spark):
    check(spark, [], everyone=[4])


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "")]
    pieces = conversations.repair(spark.createDataFrame([(*r, "en", "x", 1, "y", 2) for r in rows], SCHEMA))
    got = [(r["edit"], r["role"], r["text"]) for r in conversations.repaired_rows(pieces).orderBy("part", "seq", "place").collect()]
    assert got == [("K", "user", "a."), ("R", "assistant", "b")]


@pytest.mark.parametrize("kind", range(5))
def test_damage(spark, kind):
    turn = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == kind)
    kept, lost = conversations.damage(spark.createDataFrame([(3, turn, "assistant", "A. b?")], "conv_id long, turn long, role string, text string"))
    got = [(r["role"], r["text"]) for r in kept.collect()]
    assert got == [[], [("assistant", "")], [("assistant", "A b")], [("assistant", "A. b?")] * 2, [("user", "A. b?")]][kind]
    assert lost.count() == (kind == 0)
