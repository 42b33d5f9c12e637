"""Conversation repair against a plain search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from conftest import FOLDER

from almanac.llm import conversation_repair as repair
from almanac.sources import table

SCHEMA = "conv_id long, turn long, role string, text string, conv string, place string, audit string"
WHITE = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        one = lambda v: " " if v is None else str(v)
        role, text = one(role), one(text)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plainly(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit and digest of one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, faults = set(), []
    for _, _, role, text in rows:
        tail = text.rstrip(WHITE)
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "" if tail[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    firsts = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:]))
    allowed = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def best(i, last, inserts):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []

        def add(cost, edit, i, last, inserts, line):
            rest = best(i, last, inserts)
            if rest is not None:
                found.append((cost + rest[0], edit + rest[1], line + rest[2]))

        for name in ("user", "assistant"):
            if name[0] in allowed[last] and inserts < 3:
                add(5, "I", i, name[0], inserts + 1, (f"{name}:",))
        if i < len(rows):
            _, _, role, text = rows[i]
            add(2, "D", i + 1, last, 0, ())
            if faults[i] not in ("blank", "duplicate"):
                more = 5 * (faults[i] == "truncated")
                if role[:1] in allowed[last]:
                    add(more, "K", i + 1, role[:1], 0, (f"{role}:{text}",))
                for name in ("user", "assistant"):
                    if name[0] in allowed[last]:
                        add(1 + more, "R", i + 1, name[0], 0, (f"{name}:{text}",))
        return min(found) if found else None

    cost, audit, lines = best(0, "", 0)
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, audit, digest)


def expected(rows):
    after = damaged(rows)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    convs = {r[0] for r in rows}
    return {c: plainly(found) if (found := [r for r in after if r[0] == c]) else empty for c in convs}


def found_by(frame):
    return {r.conv_id: tuple(r)[1:] for r in frame.collect()}


def test_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "conversations", "conv_id", "turn", "role", "text").collect()]
    assert found_by(repair.op12_conversation_repair(spark, FOLDER)) == expected(rows)


def odd_rows(n_conversations, longest, seed):
    random.seed(seed)
    rows = []
    for conv in [None, *range(n_conversations)]:
        for i in range(random.randint(1, longest)):
            turn = random.choice([i, i, i, i, None, i // 2, i + 3])
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ünder"])
            text = random.choice(["Yes.", "No!", "Well ", "So?\n", "", " \t", None, f"Long {i}.", " ", "a ."])
            rows.append((conv, turn, role, text, "x", None, "y"))
    return rows


@pytest.mark.parametrize("shift", [None, 1, 3])
def test_odd_conversations_in_chunks_of_any_size(spark, shift):
    """Nulls, ties, repeated rows, other roles, and columns with names that are used inside."""
    rows = odd_rows(60, 9, 4) + [(500, i % 7, "user", "Same.", None, None, None) for i in range(12)]
    frame = spark.createDataFrame(rows, SCHEMA)
    named = repair.with_planted_damage(frame)
    assert found_by(repair.repair_report(named, frame, shift)) == expected(rows)


def test_long_conversation_in_chunks_equals_one_in_a_piece(spark):
    random.seed(9)
    rows = [(1, i, random.choice(["user", "assistant", "system"]), random.choice(["A.", "b", f"c{i}.", ""]), "", "", "")
            for i in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = found_by(repair.repair_report(frame, frame, 20))
    assert found_by(repair.repair_report(frame, frame, 5)) == whole
    [(*_, cost, audit, _)] = whole.values()
    weights = {"K": 0, "R": 1, "D": 2, "I": 5}
    assert cost >= sum(weights[e] for e in audit) and len(audit) - audit.count("I") == 3000


def test_no_conversations(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert not repair.repair_report(frame, frame).collect()


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi.", "", "", ""), (1, 1, "user", "Oh.", "", "", ""), (1, 2, "assistant", "", "", "", "")]
    edits, summary = repair.repaired(repair.ordered_rows(spark.createDataFrame(rows, SCHEMA)))
    listed = [(r.edit, r.role, r.text) for r in edits.orderBy("conv", "place", "step").collect()]
    assert listed == [("K", "user", "Hi."), ("R", "assistant", "Oh."), ("D", "assistant", "")]
    assert [tuple(r) for r in summary.collect()] == [(1, 1, 0, 0, 1, 3)]


def test_walk_equals_backward_cost():
    random.seed(2)
    for n in (0, 1, 2, 5, 40, 300):
        letters = "".join(random.choices(repair.LETTERS, k=n))
        for state in range(4):
            audit, end = repair.walk(letters, repair.FINAL, state, True)
            assert end in (repair.NOTHING, repair.ASSISTANT)
            cost = repair.through(repair.matrix(letters), repair.FINAL)[state]
            stays = sum(repair.STAYS[x][0] or 0 for x, e in zip(letters, audit.replace("I", "")) if e != "D")
            assert cost == stays + sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit)
