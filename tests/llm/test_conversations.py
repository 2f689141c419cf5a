import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from tablespan.llm import conversations as C
from tests.llm.frames import given, written

SCHEMA = "conv_id long, turn long, role string, text string, copy long, kind string, part int, code string"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def best(rows):
    """The cheapest audit of (initial, must be deleted, truncated), compared as whole strings, and its cost."""

    @cache
    def rest(i, state, inserted):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, ""))
        made = "a" if state == "u" else "u"
        if inserted < 2:
            options.append(("I", 3, i, made, inserted + 1))
        if i < len(rows):
            initial, must, cut = rows[i]
            options.append(("D", 4, i + 1, state, 0))
            if not must:
                if initial and initial in NEXT[state]:
                    options.append(("K", 3 * cut, i + 1, initial, 0))
                options.append(("R", 3 + 3 * cut, i + 1, made, 0))
        found = []
        for o in options:
            if len(o) == 2:
                found.append(o)
            elif (more := rest(*o[2:])) is not None:
                found.append((o[1] + more[0], o[0] + more[1]))
        return min(found, default=None)

    return rest(0, "", 0)


def expected(table):
    groups = {}
    for conv, turn, role, text in table:
        rows = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            marks.append((role[:1], fault < 2, fault == 2))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = best(tuple(marks))
        i, state, lines = 0, "", []
        for sign in audit:
            made = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if sign != "D":
                role = rows[i][1] if sign == "K" else made
                lines.append(role + ":" + ("" if sign == "I" else rows[i][2]))
                state = role[:1]
            i += sign != "I"
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def actual(frame):
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    return sorted([tuple(r[n] for n in names) for r in frame.collect()], key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def made(seed):
    draw = random.Random(seed)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(draw.choice([0, 1, 2, 3, 8, 25])):
            turn = draw.choice([None, turn, turn, turn, turn + 2, 5])
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "sys", "tool", "", None, "User", "üser", "a"])
            rows.append((conv, turn, role, draw.choice(["Yes.", "No!", "Why?", "cut", "cut \x0b\t ", " \r\n", "", None, "é", "Fine.  ", "x" * 9000 + "."])))
    rows += rows[:40] + [(100, 7, "user", "same.")] * 9 + [(101, 3, "assistant", "Only.")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, piece_rows", [(1, C.PIECE_ROWS), (2, 2), (3, 1)])
def test_made_conversations(spark, seed, piece_rows):
    rows = made(seed)
    table = frame(spark, rows).repartition(6)
    assert actual(C.repairs(spark, table, C.damaged(table), piece_rows)) == expected(rows)


def test_one_long_conversation(spark):
    draw = random.Random(5)
    rows = [(1, i, draw.choice(["user", "assistant", "assistant", "system"]), draw.choice(["Yes.", f"No {i}.", "cut", ""])) for i in range(300)] + [(2, 1, "user", "Hi.")]
    table = frame(spark, rows)
    for piece_rows in (C.PIECE_ROWS, 37):
        assert actual(C.repairs(spark, table, C.damaged(table), piece_rows)) == expected(rows)


def test_given_conversations(spark, tmp_path):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in given("conversations", "/root/testdata/sf0.01")]
    assert actual(C.op11_conversation_repair(spark, written(tmp_path, conversations=frame(spark, rows)))) == expected(rows)


def test_everything_dropped_and_no_rows(spark):
    gone = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = frame(spark, [(*gone, "user", "Hi.")])
    assert actual(C.repairs(spark, table, C.damaged(table))) == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    table = frame(spark, [])
    assert C.repairs(spark, table, C.damaged(table)).collect() == []


def test_ranks_order_whole_audits():
    import numpy as np

    draw = random.Random(9)
    pieces = [np.array([draw.choice([0, 1, 2, 3]) + draw.choice([0, 0, C.BLANK, C.DUPLICATE, C.TRUNCATED]) for _ in range(draw.randint(1, 12))], np.uint8) for _ in range(200)]
    solved = C.Solved(pieces, np.tile(C._ENDS, (200, 1)), np.ones(200, dtype=bool))
    nodes = np.concatenate([solved.nodes(p) for p in range(4)])
    audits = solved.audits(nodes)
    order = sorted(zip(audits, solved.rank[nodes].tolist(), strict=True))
    assert [r for _, r in order] == sorted(r for _, r in order)
    assert len(set(audits)) == len(set(solved.rank[nodes].tolist()))
