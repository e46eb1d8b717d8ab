from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import defaultdict
from itertools import product

import numpy as np
import pytest

from tablewright.llm import turn_alignment
from tablewright.llm.queries import QUERIES
from tablewright.llm.turn_alignment import _by_place, _by_target, repair, repaired_roles, target
from tablewright.llm.turn_repair import damaged, repair_report, repaired_turns

SCHEMA = "conv_id long, turn long, role string, text string, cost string, found int, kind string"
COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def _search(turns):
    """Least (cost, audit) by a plain search over edits; the roles so far decide what may follow."""
    queue, limit = [(0, "", 0, "")], 2 * len(turns) + 2
    while queue:
        cost, audit, i, roles = heapq.heappop(queue)
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, roles
        if len(roles) > limit:
            continue
        steps = [(3, "I", i, r) for r in "ua"]
        if i < len(turns):
            t = turns[i]
            steps.append((4, "D", i + 1, ""))
            if t != "-":
                more = 3 if t.isupper() else 0
                steps.append((more, "K", i + 1, t.lower()))
                steps += [(3 + more, "R", i + 1, r) for r in "ua"]
        for c, edit, j, r in steps:
            if re.fullmatch("s?(ua)*u?", roles + r):
                heapq.heappush(queue, (cost + c, audit + edit, j, roles + r))


def test_alignment_finds_the_cheapest_and_least_audit():
    for n in range(4):
        for turns in map("".join, product("uasxUS-", repeat=n)):
            cost, audit, roles = _search(turns)
            assert _by_target(turns) == _by_place(turns) == (cost, audit), turns
            assert "".join(r or "" for r in repaired_roles(audit)) == roles


def test_long_sequences_are_aligned_alike():
    rng = np.random.default_rng(3)
    for n in [5, 9, 14, 22]:
        for _ in range(60):
            turns = "".join(rng.choice(list("uauauasxUA-"), n))
            assert _by_target(turns) == _by_place(turns), turns
    turns = "ua" * 60_000 + "u" + "ua" * 40_000 + "-"
    assert len(turns) > turn_alignment.LONG and repair(turns)[0] == 7
    assert target(0) == "" and target(5) == "suaua"


def _brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        named = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fault, kept = zlib.crc32(named.encode()) % 20, convs[c]
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        order = (turn is not None, turn or 0, role, hashlib.md5(text.encode()).digest())
        kept += [(order, turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for c, kept in convs.items():
        kept.sort(key=lambda r: r[0])
        counts, marks, seen, initials = defaultdict(int), "", set(), ""
        for _, _, role, text in kept:
            seen_before = (role, text) in seen
            seen.add((role, text))
            body = text.strip(" \t\n\r\x0b\x0c")
            fault = "blank" if not body else "duplicate" if seen_before else "truncated" if body[-1] not in ".!?" else None
            counts[fault] += 1
            initials += role[:1] or "-"
            mark = role[:1] if role[:1] in ("u", "a", "s") and role[:1] else "x"
            marks += {None: mark, "truncated": mark.upper()}.get(fault, "-")
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        turns = {t for _, t, _, _ in kept if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, roles = _search(marks)
        left, spoken, lines = list(roles), iter(kept), []
        for e in audit:
            row = next(spoken) if e != "I" else None
            if e == "D":
                continue
            new = {"u": "user", "a": "assistant"}.get(left.pop(0))
            lines.append(f"{row[2] if e == 'K' else new}:{row[3] if row else ''}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((c, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=lambda r: -1 if r[0] is None else r[0])


def _rows(got):
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=lambda r: -1 if r[0] is None else r[0])


AWKWARD = [
    (None, 1, "user", "lost."), (None, 2, "assistant", "found!"), (1, None, None, None), (1, None, None, None),
    (1, 3, "user", " \n\t "), (1, 9, "", "no role?"), (2, 5, "system", "long " * 50_000 + "end."), (2, 6, "user", "Ünïcode… "),
    (3, 4, "assistant", "a. "), (3, 4, "assistant", "a."), (3, 4, "assistant", "a."), (4, 1, "tool", "x."),
]


def _talks(n):
    rng = np.random.default_rng(n)
    texts = ["Yes.", "No!", "cut", "Why? \n", "", "Really."]
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 8))):
            rows.append((c, t, str(rng.choice(["user", "assistant", "user", "assistant", "system"])), str(rng.choice(texts))))
    return rows


def test_reports_match_brute_force(spark):
    rows = AWKWARD + [(c + 100, *r) for c, *r in _talks(300)]
    assert _rows(repair_report(damaged(_table(spark, rows)))) == _brute(rows)


def test_turns_that_all_drop_leave_an_empty_report(spark):
    drop = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = _rows(repair_report(damaged(_table(spark, [(drop, 0, "user", "gone.")]))))
    assert got == [(drop, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair_report(damaged(_table(spark, []))).count() == 0


def test_repaired_turns_alternate_and_keep_what_they_can(spark):
    rows = [(1, 0, "system", "Rules."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "user", "Well?"), (2, 0, "assistant", "Hm."), (3, 0, "user", " ")]
    got = [tuple(r) for r in repaired_turns(_table(spark, rows)).orderBy("conv_id", "position").collect()]
    assert got == [
        (1, 0, "system", "Rules.", "K"), (1, 1, "user", "Hi.", "K"), (1, 2, "assistant", "Well?", "R"),
        (2, 0, "user", "", "I"), (2, 1, "assistant", "Hm.", "K"),
    ]


@pytest.mark.parametrize("table", ["conversations"])
def test_query_reports_every_conversation(spark, small, duck, table):
    rows = duck.execute(f"SELECT conv_id, turn, role, text FROM {table}").fetchall()
    assert _rows(QUERIES["op12_turn_repair"](spark, small)) == _brute(rows)
