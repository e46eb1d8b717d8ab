from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from tablewright.llm import jaccard_join, shingles
from tablewright.llm.components import components
from tablewright.llm.jaccard_join import join_similar, keep_one, prefix_depth
from tablewright.llm.shingles import overlaps, spanning
from tablewright.llm.words import folded_words
from tests.llm.awkward import ROWS, documents


def _corpus(seed=5, groups=12, copies=9):
    rng = np.random.default_rng(seed)
    rows, n = list(ROWS), 1000
    for g in range(groups):
        base = [f"g{g}w{i}" if g % 3 else f"w{i}" for i in rng.permutation(120)]
        for _ in range(copies):
            text = list(base)
            for _ in range(int(rng.integers(0, 5))):
                text[int(rng.integers(0, len(text)))] = f"new{rng.integers(0, 10**6)}"
            rows.append((n, " ".join(text), "en", "a"))
            n += 1
    return rows


def _brute(rows):
    sets = []
    for r in rows:
        w = folded_words((r[1] or "").encode())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else None)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[root(i)].append(r[0])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    return [(r[0], least[root(i)], links[i]) for i, r in enumerate(rows)], least


def _plain(rows):
    return sorted((-1 if a is None else a, -1 if b is None else b, c) for a, b, c in rows)


@pytest.mark.parametrize(("block", "block_shingles"), [(384, 10**6), (4, 10**6), (384, 300)])
def test_links_match_brute_force(spark, monkeypatch, block, block_shingles):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block_shingles)
    rows = _corpus()
    got = join_similar(documents(spark, rows)).collect()
    want, _ = _brute(rows)
    assert _plain((r.doc_id, r.class_id, r.n_links) for r in got) == _plain(want)


def test_one_of_each_class_stays(spark):
    rows = _corpus(seed=6)
    kept = keep_one(documents(spark, rows))
    assert kept.columns == documents(spark).columns
    _, least = _brute(rows)
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == sorted(-1 if x is None else x for x in least.values())


def test_nothing_to_join(spark):
    assert join_similar(documents(spark, [])).count() == 0
    assert keep_one(documents(spark, [])).count() == 0
    assert keep_one(documents(spark, ROWS[:3])).count() == 3


def test_prefix_is_shortened_to_the_recall():
    assert prefix_depth(0.8, 16, 6, 0.9999) == 3
    assert prefix_depth(0.8, 16, 6, 0.5) == 6
    assert prefix_depth(0.8, 1, 6, 0.999999) == 1


@pytest.mark.parametrize("values", [10**6, 700])
def test_overlaps_and_spanning(monkeypatch, values):
    monkeypatch.setattr(shingles, "VALUES", values)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 200)).astype(np.uint64) * shingles.STEP) for _ in range(40)]
    want = [[len(set(a) & set(b)) for b in sets] for a in sets]
    assert (overlaps(sets) == want).all() and (overlaps(sets[:5]) == np.array(want)[:5, :5]).all()
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 2), (2, 5), (3, 4)):
        linked[a, b] = linked[b, a] = True
    assert sorted(spanning(linked)) == [(0, 2), (0, 5), (3, 4)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100) for i in range(1, 40)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
