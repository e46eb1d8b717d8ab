from __future__ import annotations

import re

import numpy as np
import pytest

from tablewright.llm import boosted_trees, doc_stats
from tablewright.llm.quality_rules import apply_quality_rules
from tablewright.llm.site_quality import classify_by_site, keep_good, site_posteriors
from tests.llm.awkward import ROWS, documents, fold, labels


def _by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        if re.search(r"[^\x20\x09-\x0D]", line) and line in lines[:i]:
            dup += 1
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


@pytest.mark.parametrize("text", [r[1] for r in ROWS if r[1] is None or len(r[1]) < 2000] + ["a b c d e " * 3, "a\x85b c\x1cd e", "\r\nx\r\nx\nx"])
def test_counts_match_their_definition(text):
    assert doc_stats.counts((text or "").encode())[:5] == _by_hand(text)


def test_scores_never_rise_with_a_falling_feature():
    rng = np.random.default_rng(3)
    x = rng.random((600, 3))
    y = ((x[:, 0] + rng.normal(0, 0.3, 600)) < 0.5).astype(float)
    trees = boosted_trees.fit_trees(x, y, np.ones(600), [-1, 0, 1])
    grid = np.repeat(rng.random((50, 3)), 41, axis=0)
    for feature, sign in ((0, -1), (2, 1)):
        moved = grid.copy()
        moved[:, feature] = np.tile(np.linspace(-0.2, 1.2, 41), 50)
        steps = np.diff(trees.margin(moved).reshape(50, 41), axis=1)
        assert (sign * steps >= -1e-12).all()
    assert np.mean((trees.probability(x) > 0.5) == y) > 0.8


def test_flat_trees_step_like_their_nodes():
    rng = np.random.default_rng(4)
    x = rng.random((200, 2))
    trees = boosted_trees.fit_trees(x, (x[:, 1] > 0.4).astype(float), np.ones(200), [0, 0])
    for row, got in zip(x[:20], trees.margin(x[:20])):
        total = trees.start
        for t in range(len(trees.feature)):
            k = 0
            while trees.left[t, k] != k:
                k = trees.left[t, k] if row[trees.feature[t, k]] <= trees.threshold[t, k] else trees.right[t, k]
            total += trees.value[t, k]
        assert abs(total - got) < 1e-9


def test_one_class_has_no_trees():
    assert boosted_trees.fit_trees(np.ones((5, 2)), np.ones(5), np.ones(5), [0, 0]) is None
    assert boosted_trees.fit_trees(np.ones((0, 2)), np.ones(0), np.ones(0), [0, 0]) is None


def test_rules_on_awkward_rows(spark):
    got = apply_quality_rules(documents(spark), labels(spark, [(4, None, 1, "x", 1), (None, 1, 0, "y", 1)])).collect()
    assert len(got) == len(ROWS)
    want = sorted((r[0] or -1, *_by_hand(r[1])) for r in ROWS if r[0] != 7)
    assert sorted((r.doc_id or -1, *r[1:6]) for r in got if r.doc_id != 7) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed) and r.p_good == 1.0
    assert apply_quality_rules(documents(spark, []), labels(spark)).count() == 0


def test_rules_tell_junk_from_text(spark):
    rows = [(i, " ".join(f"w{i}x{j}" + ("$$$" if i % 3 == 0 else "") for j in range(40)), "en", "a") for i in range(120)]
    known = labels(spark, [(i, int(i % 3 != 0), 0, "t", 1) for i in range(120)])
    got = apply_quality_rules(documents(spark, rows), known).collect()
    assert all(r.kept == (r.doc_id % 3 != 0) for r in got)


def test_site_quality_on_awkward_rows(spark):
    got = classify_by_site(documents(spark), labels(spark)).collect()
    assert len(got) == len(ROWS) and {r.p_good for r in got} == {0.5}
    assert keep_good(documents(spark), labels(spark)).count() == len(ROWS)
    assert classify_by_site(documents(spark, []), labels(spark)).count() == 0
    kept = keep_good(documents(spark), labels(spark))
    assert kept.columns == documents(spark).columns


def test_site_quality_tells_junk_and_leaves_columns_alone(spark):
    rows = [(i, " ".join(f"w{i}x{j}" + ("$$$" if i % 4 == 0 else "") for j in range(40)), "en", "ab"[i % 2]) for i in range(200)]
    known = labels(spark, [(i, int(i % 4 != 0), 0, "t", 1) for i in range(200)])
    got = classify_by_site(documents(spark, rows), known).collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in got)
    kept = keep_good(documents(spark, rows), known)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(200) if i % 4]


def test_sparse_sites_stay_near_the_level_above(spark):
    rows = [("big", "p", int(i % 10 != 0)) for i in range(500)] + [("bad", "p", int(i % 10 == 0)) for i in range(500)]
    rows += [("tiny", "q", 0), (None, None, 1)]
    share, hosts, paths = site_posteriors(spark.createDataFrame(rows, "host string, path string, label int"))
    by = {r.host: r.host_share for r in hosts.collect()}
    assert by["big"] > 0.88 and by["bad"] < 0.12
    assert abs(by["tiny"] - share) < abs(by["bad"] - share)
    assert 0 < by["tiny"] < share < by[None] < 1
    assert {(r.host, r.path) for r in paths.collect()} == {("big", "p"), ("bad", "p"), ("tiny", "q"), (None, None)}


def _concentration(groups, expected):
    """Pseudo-documents by moments, from {group: (n, good)} and the expected share of each."""
    n = np.array([g[0] for g in groups.values()], float)
    share = np.array([g[1] for g in groups.values()]) / n
    e = np.array([expected[k] for k in groups])
    within = e * (1 - e)
    between = max(0.0, ((n * (share - e) ** 2).sum() - within.sum()) / n.sum())
    return min(1e6, max(1.0, (n * within).sum() / n.sum() / between - 1)) if between > 0 else 1e6


def _shrunk(groups, expected):
    m = _concentration(groups, expected)
    return {k: (good + m * expected[k]) / (n + m) for k, (n, good) in groups.items()}


def _counted(rows, key):
    out = {}
    for r in rows:
        n, good = out.get(key(r), (0, 0))
        out[key(r)] = (n + 1, good + r[2])
    return out


def test_posteriors_match_a_plain_calculation(spark):
    rng = np.random.default_rng(8)
    rates = {f"h{i}": rng.uniform(0.05, 0.95) for i in range(12)} | {None: 0.4}
    hosts = list(rates)
    rows = []
    for i in range(900):
        host = hosts[int(rng.integers(0, len(hosts))) if i % 3 else 0]
        path = [None, "p", "q"][int(rng.integers(0, 3))]
        rows.append((i, f"some plain words {i}", path, host, int(rng.random() < rates[host])))
    docs = documents(spark, [r[:4] for r in rows])
    known = labels(spark, [(r[0], r[4], 0, "t", 1) for r in rows])
    got = {r.doc_id: r for r in classify_by_site(docs, known).collect()}

    learnt = [(r[3], r[2], r[4]) for r in rows if fold(r[0]) != 0]
    share = (sum(r[2] for r in learnt) + 1) / (len(learnt) + 2)
    by_host = _shrunk(_counted(learnt, lambda r: r[0]), dict.fromkeys(hosts, share))
    by_path = _counted(learnt, lambda r: r[:2])
    by_path = _shrunk(by_path, {k: by_host[k[0]] for k in by_path})
    for i, _, path, host, _ in rows:
        r = got[i]
        prior = by_path.get((host, path), by_host[host])
        odds = r.text_evidence + np.log(prior / (1 - prior))
        assert np.allclose([r.host_share, r.path_share, r.p_good], [by_host[host], prior, 1 / (1 + np.exp(-odds))], rtol=1e-9)
        assert r.kept == (r.p_good >= 0.5) and r.held_out == (fold(i) == 0)
