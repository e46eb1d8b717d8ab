from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablewright.llm import near_vectors as nv
from tablewright.llm import vector_graph as vg
from tablewright.llm.near_vectors import link_vectors, near_vectors
from tests.harness import compare, tables_in_duckdb

SCHEMA = "vec_id long, embedding array<double>, label int, k1 string, links string, shard int"


def _table(spark, rows):
    return spark.createDataFrame([(i, e, 1, "x", "y", 2) for i, e in rows], SCHEMA)


def _brute(rows, least=0.9):
    """Links and components of (id, vector) rows by comparing all pairs."""
    ok = [e is not None and len(e) > 0 and all(v is not None and np.isfinite(v) for v in e) and any(e) for _, e in rows]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for width in {len(e) for (_, e), k in zip(rows, ok) if k}:
        at = [i for i in range(n) if ok[i] and len(rows[i][1]) == width]
        x = np.array([rows[i][1] for i in at], float)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        links[np.ix_(at, at)] = x @ x.T >= least
    np.fill_diagonal(links, False)
    group = np.arange(n)
    for _ in range(n):
        new = np.array([min(group[i], group[links[i]].min(initial=n)) for i in range(n)])
        if (new == group).all():
            break
        group = new
    out = []
    for i, (vec_id, _) in enumerate(rows):
        least_id = min((rows[j][0] for j in range(n) if group[j] == group[i] and rows[j][0] is not None), default=None)
        out.append((vec_id, int(links[i].sum()), least_id, vec_id == least_id))
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def _got(df):
    return _sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def _near(rng, base, cosine):
    """A vector at about the given cosine of a vector."""
    other = rng.normal(size=len(base))
    other -= base * (other @ base) / (base @ base)
    other *= np.linalg.norm(base) / np.linalg.norm(other)
    return cosine * base + np.sqrt(1 - cosine**2) * other


def _clumps(seed, n, groups, size, low=0.9, width=24):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=width) for _ in range(n)]
    for _ in range(groups):
        base = rng.normal(size=width)
        x += [_near(rng, base, rng.uniform(low, 1.0)) for _ in range(size)]
    order = rng.permutation(len(x))
    return [(int(i) * 3 + 5, [float(v) for v in x[k]]) for i, k in enumerate(order)]


AWKWARD = [
    (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
    (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.01]), (9, [-1.0, 0.0]), (10, [1e200, 1e200]),
    (11, [1e-200, 1e-200]), (12, [1.0]), (13, [1.0, 0.0, 0.0]), (14, [3.0]), (None, [0.0, -5.0]),
]


def test_awkward_vectors_match_brute_force(spark):
    assert _got(near_vectors(_table(spark, AWKWARD))) == _sorted(_brute(AWKWARD))
    assert near_vectors(_table(spark, [])).count() == 0
    assert _got(near_vectors(_table(spark, AWKWARD[:3]))) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


@pytest.mark.parametrize("most", [40, 1024])
def test_clumps_match_brute_force(spark, monkeypatch, most):
    """With small shards, a clump is spread over several and found by visits."""
    monkeypatch.setattr(nv, "MOST", most)
    monkeypatch.setattr(nv, "VISITORS", 25)
    rows = _clumps(1, 300, 6, 30, low=0.97) + [(9000 + i, [1.0] + [0.0] * 23) for i in range(150)]
    assert _got(near_vectors(_table(spark, rows))) == _sorted(_brute(rows))


def test_links_near_the_threshold_are_found_and_none_below(spark, monkeypatch):
    monkeypatch.setattr(nv, "MOST", 60)
    rows = _clumps(2, 300, 40, 6, low=0.88)
    got, want = _got(near_vectors(_table(spark, rows))), _sorted(_brute(rows))
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.95 * sum(w[1] for w in want) > 100
    *_, recall = link_vectors(_table(spark, rows))
    # All rows are in the audit, so it measures the very recall.
    assert recall == pytest.approx(sum(g[1] for g in got) / sum(w[1] for w in want))


def test_too_low_a_recall_is_searched_wider_and_then_an_error(spark, monkeypatch):
    rows = _clumps(3, 50, 4, 10)
    tried = []
    real = nv.search_links
    monkeypatch.setattr(nv, "search_links", lambda v, t, overlap, beam: tried.append((overlap, beam)) or real(v, 0.9999, overlap, beam))
    with pytest.raises(RuntimeError):
        near_vectors(_table(spark, rows))
    assert tried == [(1, 12), (2, 24), (3, 48)]


def test_search_in_one_graph_finds_the_range():
    rng = np.random.default_rng(5)
    rows = _clumps(5, 600, 10, 40)
    x = nv.unit_vectors(pa.array([e for _, e in rows], pa.list_(pa.float64())))
    lists = vg.both_ways(vg.robust_prune(x), x)
    assert (lists != np.arange(len(x))[:, None]).all()
    near = x @ x.T >= 0.9
    q, v = vg.range_search(x, x, lists, [np.zeros(0, np.int64)] * len(x), 0.9, 12)
    assert len(set(zip(q, v))) == len(q) and near[q, v].all()
    assert len(q) >= 0.97 * near.sum()
    alone = vg.robust_prune(x[:1])
    assert (alone == -1).all() and rng is not None


def test_sql_states_the_same(spark, tmp_path):
    rows = [r for r in AWKWARD if r[0] != 10 and r[0] != 11] + _clumps(6, 30, 3, 5, low=0.95)
    (tmp_path / "t").mkdir()
    pq.write_table(_table(spark, rows).toArrow(), tmp_path / "t" / "embeddings.parquet")
    duck = tables_in_duckdb(str(tmp_path / "t"))
    from tablewright.llm.sql import NEAR_VECTORS

    assert compare(near_vectors(_table(spark, rows)), duck, NEAR_VECTORS) is None
