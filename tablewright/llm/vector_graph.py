"""Robust-pruned neighbour graph over the vectors of one shard and range search in it, in numpy.

Vectors have length one, so the larger the product the nearer.  The graph is flat: every vector
has one list of neighbours.  Searches of many queries advance together.
"""

from __future__ import annotations

import numpy as np

#: Nearest vectors and arbitrary ones that a list is pruned from, and its length.
NEAR, ANY, DEGREE = 40, 12, 16
#: A candidate goes if a nearer neighbour is so many times as near to it as the vector itself.
ALPHA = 1.2
ROWS, PAIRS = 256, 200_000


def medoid(x: np.ndarray) -> int:
    """The vector nearest to the mean of all."""
    return int(np.argmax(x @ x.mean(axis=0)))


def robust_prune(x: np.ndarray, seed: int = 7) -> np.ndarray:
    """Lists of neighbours, (vectors, DEGREE), filled up with -1.

    From each vector's candidates the nearest is taken again and again; those that are nearer
    to it than to the vector, by ALPHA, are dropped, so the list points in many directions.
    """
    n = len(x)
    out = np.full((n, DEGREE), -1, np.int32)
    near = min(NEAR, n - 1)
    if near < 1:
        return out
    rng = np.random.default_rng(seed)
    for at in range(0, n, ROWS):
        own = np.arange(at, min(at + ROWS, n))
        product = x[own] @ x.T
        product[np.arange(len(own)), own] = -2.0
        first = np.argpartition(-product, near - 1, axis=1)[:, :near]
        pool = np.concatenate([first, rng.integers(0, n, (len(own), ANY))], axis=1)
        gap = 2.0 - 2.0 * np.take_along_axis(product, pool, axis=1)
        order = np.argsort(gap, axis=1, kind="stable")
        pool, gap = np.take_along_axis(pool, order, axis=1), np.take_along_axis(gap, order, axis=1)
        # Squared distances between the candidates of each vector.
        c = x[pool]
        between = 2.0 - 2.0 * np.einsum("bid,bjd->bij", c, c)
        alive = pool != own[:, None]
        line = np.arange(len(own))
        for k in range(DEGREE):
            some = alive.any(axis=1)
            if not some.any():
                break
            best = np.argmax(alive, axis=1)
            out[own[some], k] = pool[line[some], best[some]]
            keep = ALPHA * ALPHA * between[line, best] > gap
            alive &= keep & (pool != pool[line, best][:, None])
    return out


def both_ways(lists: np.ndarray, x: np.ndarray, width: int = 2 * DEGREE) -> np.ndarray:
    """The lists with each link also the other way round, the nearest ``width`` of a vector."""
    n = len(lists)
    a = np.repeat(np.arange(n), lists.shape[1])
    b = lists.ravel().astype(np.int64)
    a, b = a[b >= 0], b[b >= 0]
    pairs = np.unique(np.concatenate([a * n + b, b * n + a]))
    return _as_lists(pairs // n, pairs % n, x, width)


def _as_lists(a: np.ndarray, b: np.ndarray, x: np.ndarray, width: int) -> np.ndarray:
    out = np.full((len(x), width), -1, np.int32)
    if not len(a):
        return out
    near = _products(x, a, x, b)
    order = np.lexsort((-near, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    inside = place < width
    out[a[inside], place[inside]] = b[inside]
    return out


def _products(x: np.ndarray, a: np.ndarray, y: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a))
    for at in range(0, len(a), PAIRS):
        s = slice(at, at + PAIRS)
        out[s] = np.einsum("nd,nd->n", x[a[s]], y[b[s]])
    return out


def _fresh(queries: np.ndarray, nodes: np.ndarray, visited: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs not seen before, each once; they count as visited from now on."""
    n = visited.shape[1]
    pairs = np.unique(queries.astype(np.int64) * n + nodes)
    pairs = pairs[~visited.ravel()[pairs]]
    visited.ravel()[pairs] = True
    return pairs // n, pairs % n


def range_search(
    queries: np.ndarray, x: np.ndarray, lists: np.ndarray, starts: list[np.ndarray], least: float, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs with a product of at least ``least``, as far as the graph leads there.

    A greedy search with ``beam`` open vectors goes from the medoid and the given starts of each
    query to where it is nearest; from every vector within the range the search then goes on to
    all its neighbours until the range has no new one.
    """
    n, m = len(queries), len(x)
    centre = medoid(x)
    visited = np.zeros((n, m), bool)
    q = np.concatenate([np.arange(n), np.repeat(np.arange(n), [len(s) for s in starts])])
    v = np.concatenate([np.full(n, centre), *starts]).astype(np.int64)
    q, v = _fresh(q, v, visited)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), -3.0)
    done = np.ones((n, beam), bool)
    while len(q):
        product = _products(queries, q, x, v)
        inside = product >= least
        found.append((q[inside], v[inside]))
        # Merge what is new into each query's beam, nearest first.
        order = np.lexsort((-product, q))
        q, v, product = q[order], v[order], product[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        q, v, product, place = (c[place < beam] for c in (q, v, product, place))
        rows = np.unique(q)
        line = np.searchsorted(rows, q)
        more_ids, more_near = np.full((len(rows), beam), -1, np.int64), np.full((len(rows), beam), -3.0)
        more_ids[line, place], more_near[line, place] = v, product
        all_ids = np.concatenate([ids[rows], more_ids], axis=1)
        all_near = np.concatenate([near[rows], more_near], axis=1)
        all_done = np.concatenate([done[rows], more_ids < 0], axis=1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[rows], near[rows], done[rows] = (np.take_along_axis(c, best, axis=1) for c in (all_ids, all_near, all_done))
        # The nearest open vectors of each query are expanded.
        at = np.flatnonzero(~done.all(axis=1))
        first = np.argmax(~done[at], axis=1)
        chosen = ids[at, first]
        done[at, first] = True
        after = lists[chosen]
        there = after >= 0
        q, v = _fresh(np.repeat(at, there.sum(axis=1)), after[there], visited)
        if not len(q) and not done.all():
            q, v = _expand_open(ids, done, lists, visited)
    # Expand the range.
    q, v = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    reached = [(q, v)]
    while len(q):
        step_q, step_v = [], []
        for s in range(0, len(q), PAIRS):
            after = lists[v[s : s + PAIRS]]
            there = after >= 0
            a, b = _fresh(np.repeat(q[s : s + PAIRS], there.sum(axis=1)), after[there], visited)
            inside = _products(queries, a, x, b) >= least
            step_q.append(a[inside])
            step_v.append(b[inside])
        q, v = np.concatenate(step_q), np.concatenate(step_v)
        reached.append((q, v))
    return tuple(np.concatenate(c) for c in zip(*reached))


def _expand_open(ids, done, lists, visited):
    """New vectors next to open ones, query by query, when the nearest open ones led nowhere."""
    while not done.all():
        at = np.flatnonzero(~done.all(axis=1))
        first = np.argmax(~done[at], axis=1)
        chosen = ids[at, first]
        done[at, first] = True
        after = lists[chosen]
        there = after >= 0
        q, v = _fresh(np.repeat(at, there.sum(axis=1)), after[there], visited)
        if len(q):
            return q, v
    return np.zeros(0, np.int64), np.zeros(0, np.int64)
