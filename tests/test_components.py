from __future__ import annotations

import numpy as np
import pytest

from tablewright.operators import components
from tablewright.operators.components import sample_components


def _table(spark, x, width):
    rows = [
        (f"s{i:05d}", b, [float(v) for v in r[b * width : (b + 1) * width]])
        for i, r in enumerate(x) for b in range(-(-x.shape[1] // width))
    ]
    return spark.createDataFrame(rows, "sample string, block int, counts array<double>").repartition(5)


def _exact(x, k):
    c = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(c @ c.T)
    order = np.argsort(values)[::-1][:k]
    placed = directions[:, order] * np.sqrt(np.maximum(values[order], 0))
    for j in range(placed.shape[1]):
        placed[:, j] *= np.sign(placed[np.argmax(np.abs(np.round(placed[:, j], 9))), j]) or 1
    return placed


def _got(df):
    return np.array([r.pcs for r in df.orderBy("sample").collect()])


def test_500_samples_match_the_exact_components(spark, monkeypatch):
    monkeypatch.setattr(components, "CHUNK", 128)
    monkeypatch.setattr(components, "TILE", 60)
    rng = np.random.default_rng(1)
    groups = rng.normal(size=(6, 400)) * 0.6
    x = np.clip(np.round(1 + groups[rng.integers(0, 6, 500)] + 0.5 * rng.normal(size=(500, 400))), 0, 2)
    got, want = _got(sample_components(_table(spark, x, 150), 4)), _exact(x, 4)
    assert got.shape == want.shape == (500, 4)
    assert np.abs(got - want).max() < 1e-8 * np.abs(want).max()


@pytest.mark.parametrize("n,m", [(15, 7), (3, 40), (1, 4)])
def test_fewer_samples_than_directions_are_exact(spark, n, m):
    x = np.random.default_rng(n).integers(0, 3, (n, m)).astype(float)
    got, want = _got(sample_components(_table(spark, x, 5), 2)), _exact(x, 2)
    assert np.allclose(got, want, atol=1e-8)


def test_no_sample_and_equal_samples(spark):
    assert sample_components(_table(spark, np.zeros((1, 3)), 3).limit(0), 2).count() == 0
    assert np.allclose(_got(sample_components(_table(spark, np.ones((5, 6)), 3), 2)), 0)
