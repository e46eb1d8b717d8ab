"""Small gradient-boosted trees with monotonic constraints, kept as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS, DEPTH, RATE, BINS, RIDGE, LEAST_WEIGHT = 60, 3, 0.2, 64, 1.0, 5.0


@dataclass
class FlatTrees:
    """Node k of tree t tests ``x[feature[t, k]] <= threshold[t, k]``; leaves point to themselves."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1, all rows stepping down all trees together."""
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(DEPTH):
            low = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(low, self.left[trees, node], self.right[trees, node])
        return self.start + self.value[trees, node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -500, 500)))


def _grow(binned, edges, grad, hess, monotone):
    """One tree as lists of nodes; every child keeps its values inside the bounds that the
    constrained splits above it leave."""
    nodes = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def add(rows, depth, low, high):
        me = len(nodes["value"])
        g, h = grad[rows].sum(), hess[rows].sum()
        for name, v in (("feature", 0), ("threshold", 0.0), ("left", me), ("right", me)):
            nodes[name].append(v)
        nodes["value"].append(float(np.clip(-g / (h + RIDGE), low, high)) * RATE)
        best = None
        if depth < DEPTH:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, grad[rows], len(cuts) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, hess[rows], len(cuts) + 1))[:-1]
                gr, hr = g - gl, h - hl
                vl = np.clip(-gl / (hl + RIDGE), low, high)
                vr = np.clip(-gr / (hr + RIDGE), low, high)
                # The loss each side saves with its own value instead of none.
                gain = -(gl * vl + 0.5 * (hl + RIDGE) * vl**2) - (gr * vr + 0.5 * (hr + RIDGE) * vr**2)
                barred = (hl < LEAST_WEIGHT / 4) | (hr < LEAST_WEIGHT / 4) | (monotone[f] * (vr - vl) < 0)
                gain[barred] = -np.inf
                k = int(np.argmax(gain))
                if best is None or gain[k] > best[0]:
                    best = (gain[k], f, k, vl[k], vr[k])
            v = np.clip(-g / (h + RIDGE), low, high)
            if best is not None and best[0] > -(g * v + 0.5 * (h + RIDGE) * v**2) + 1e-9:
                _, f, k, vl, vr = best
                goes_left = binned[rows, f] <= k
                mid = (vl + vr) / 2
                bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}
                (ll, lh), (rl, rh) = bounds.get(monotone[f], ((low, high), (low, high)))
                nodes["feature"][me], nodes["threshold"][me] = f, float(edges[f][k])
                nodes["left"][me] = add(rows[goes_left], depth + 1, ll, lh)
                nodes["right"][me] = add(rows[~goes_left], depth + 1, rl, rh)
        return me

    add(np.arange(len(grad)), 0, -np.inf, np.inf)
    return nodes


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, monotone: list[int]) -> FlatTrees | None:
    """Boosted trees for P(y = 1); None where there are not two classes to tell apart.

    ``monotone``: +1, -1 or 0 for each feature, the direction its score may move in.
    """
    if len(y) == 0 or y.min() == y.max():
        return None
    weight = weight / weight.mean()
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    share = np.average(y, weights=weight)
    start = float(np.log(share / (1 - share)))
    margin = np.full(len(y), start)
    grown = []
    width = 2 ** (DEPTH + 1) - 1
    for _ in range(ROUNDS):
        p = 1.0 / (1.0 + np.exp(-margin))
        grown.append(_grow(binned, edges, weight * (p - y), weight * p * (1 - p), monotone))
        margin += _flat(0.0, grown[-1:], width).margin(x)
    return _flat(start, grown, width)


def _flat(start: float, trees: list[dict], width: int) -> FlatTrees:
    def packed(name, kind):
        out = np.zeros((len(trees), width), dtype=kind)
        for t, nodes in enumerate(trees):
            out[t, : len(nodes[name])] = nodes[name]
        return out

    return FlatTrees(
        start,
        packed("feature", np.int64),
        packed("threshold", np.float64),
        packed("left", np.int64),
        packed("right", np.int64),
        packed("value", np.float64),
    )
