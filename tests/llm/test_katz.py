from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import katz
from tablewright.llm.katz import MOST_DISCOUNTED, discounts, score_documents
from tests.llm.awkward import ROWS, documents, fold


def _tokens(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


class Brute:
    def __init__(self, rows):
        train = [_tokens(t) for i, t, *_ in rows if fold(i) != 1]
        self.uni = Counter(w for d in train for w in d)
        self.big = Counter(p for d in train for p in zip([""] + d[:-1], d))
        self.history = Counter(p[0] for p in self.big.elements())
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        times = np.bincount([min(c, MOST_DISCOUNTED + 2) for c in self.big.values()] or [0], minlength=MOST_DISCOUNTED + 3)
        self.d = discounts(times[: MOST_DISCOUNTED + 2])
        self.after = {}
        for (h, w), c in self.big.items():
            self.after.setdefault(h, {})[w] = c

    def p1(self, w):
        return (self.uni[w] + 0.5) / (self.n + 0.5 * (self.v + 1))

    def p(self, w, h):
        seen = self.after.get(h)
        if not seen:
            return self.p1(w)
        c = self.history[h]
        off = {x: (self.d[k] if k <= MOST_DISCOUNTED else 1.0) * k / c for x, k in seen.items()}
        mass = sum(off.values())
        rest = max(1 - mass, 0.5 / (c + 0.5))
        if w in off:
            return off[w] * (1 - rest) / mass
        return rest / (1 - sum(map(self.p1, seen))) * self.p1(w)


def _rows():
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(30)]
    return [r for r in ROWS if r[0] != 7] + [(200 + i, " ".join(rng.choice(words, int(rng.integers(0, 60)))), "en", "a") for i in range(60)]


@pytest.mark.parametrize(("shard", "hot"), [(2_000_000, 10**9), (150, 10**9), (150, 20)])
def test_scores_match_brute_force(spark, monkeypatch, shard, hot):
    monkeypatch.setattr(katz, "HOT_TOKENS", hot)
    rows = _rows()
    got = score_documents(documents(spark, rows), shard_tokens=shard).collect()
    model = Brute(rows)
    want = []
    for i, text, *_ in rows:
        t = _tokens(text)
        base = sum(math.log10(model.p1(w)) for w in t)
        score = sum(math.log10(model.p(w, h)) for h, w in zip([""] + t[:-1], t))
        want.append((i or -1, fold(i) == 1, len(t), sum(w in model.uni for w in t), model.n, base, score))
    got = sorted((r.doc_id or -1, *r[1:]) for r in got)
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)


def test_no_table_is_left_in_the_catalog(spark):
    score_documents(documents(spark)).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("katz")]


def test_the_model_sums_to_one():
    model = Brute(_rows())
    for h in list(model.after)[:20] + ["never seen"]:
        total = sum(model.p(w, h) for w in model.uni) + model.p("unknown word", h)
        assert abs(total - 1) < 1e-9


def test_discounts_are_good_turing_or_half_a_count():
    times = np.array([0, 1000, 300, 150, 90, 60, 42])
    d = discounts(times)
    tail = 6 * 42 / 1000
    assert abs(d[1] - (2 * 300 / 1000 - tail) / (1 - tail)) < 1e-12 and all(0 < x < 1 for x in d[1:])
    assert list(discounts(np.zeros(7))[1:]) == [1 - 0.5 / r for r in range(1, 6)]


def test_empty_and_untrained(spark):
    assert score_documents(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if fold(i) == 1)
    (r,) = score_documents(documents(spark, [(held, "a b", "en", "a")])).collect()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.score == r.base_score == 0
