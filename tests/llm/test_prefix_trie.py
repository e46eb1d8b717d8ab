from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

from tablewright.llm import prefix_trie as trie
from tablewright.llm.prefix_trie import end_digests, end_pieces, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, k1 string, depth int, n_bytes string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def _brute(rows):
    """The nodes by their definition, path by path."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:])
    nodes = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in under if len(p) == len(path) + 1]
        leaves = [p for p in under if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = ",".join(str(c) for c in sorted(members) if whole[c] == path)
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), len(children), len(leaves), saved, digest))
    return out


def _rows(got):
    return sorted(tuple(r[c] for c in COLUMNS) for r in got.collect())


def _talks(seed, n):
    """Few different turns, so that prefixes, copies and proper prefixes are common."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.permutation(3 * n)[:n]:
        for turn in range(int(rng.integers(1, 13))):
            rows.append((int(c), turn, ["user", "assistant"][turn % 2], ["hé", "yes", "", "no"][int(rng.integers(0, 4)) if turn > 8 else turn % 3]))
    return rows


AWKWARD = [
    (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 2, "", ""),
    (1, 0, "user", "a"), (None, 0, "user", "nobody"), (7, 5, "user", "日本" * 20_000), (7, 3, "tool", None),
    (12, 0, "us", "er:x"), (13, 0, "user", ":x"), (14, 0, "user", "x"), (15, 0, "a", "bc"), (16, 0, "ab", "c"),
]


@pytest.mark.parametrize("rows", [[*AWKWARD, (4, 0, "user", "only")], _talks(2, 60)])
def test_nodes_match_brute_force(spark, many_blocks, rows):
    assert _rows(prefix_trie(_table(spark, rows))) == sorted(_brute(rows), key=lambda r: (r[0], r[1]))


def test_a_hot_conversation_and_its_long_list_of_ends(spark, many_blocks, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = [(5 * c, t, "user", f"turn {t}") for c in range(120) for t in range(3)]
    got = _rows(prefix_trie(_table(spark, rows)))
    assert got == sorted(_brute(rows), key=lambda r: (r[0], r[1]))


def test_pieces_join_to_the_whole_list(spark):
    ends = spark.range(1000).selectExpr("id * 7 - 900 AS conv_id", "2L AS depth", "CAST(id % 3 AS decimal(38,0)) AS k1", "CAST(5 AS decimal(38,0)) AS k2")
    pieces = end_pieces(ends, 10)
    assert pieces.agg({"piece": "max"}).first()[0] == 33
    got = {int(r.k1): r.ends_sha256 for r in end_digests(pieces).collect()}
    want = {k: ",".join(str(i * 7 - 900) for i in range(1000) if i % 3 == k) for k in range(3)}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_no_conversation_has_no_node(spark):
    assert prefix_trie(_table(spark, [])).count() == 0
    assert prefix_trie(_table(spark, [(None, 0, "user", "x")])).count() == 0
