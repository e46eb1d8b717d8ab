from __future__ import annotations

import re
from collections import defaultdict

from tablewright.llm.licence_scan import BASE_PHRASES, scan_licences
from tablewright.llm.source_mix import mix_sources
from tests.llm.awkward import LONG, ROWS, documents


def _targets(sizes: dict) -> dict:
    """Reshare what capped sources leave until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_follows_targets(spark):
    got = mix_sources(documents(spark)).collect()
    assert len(got) == len(ROWS)
    sizes = defaultdict(int)
    for _, text, _, source in ROWS:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = _targets(dict(sizes))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken in {0, r.size, 2 * r.size}
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_mix_of_many_documents_is_near_and_repeatable(spark, many_blocks):
    rows = [(i, "w " * (1 + i % 17), "en", f"s{i % 7}" if i % 3 else "hot") for i in range(3000)]
    got = mix_sources(documents(spark, rows)).collect()
    again = mix_sources(documents(spark, rows[::-1])).collect()
    assert sorted(got) == sorted(again)
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - t) <= 34 for s, t in target.items())
    assert sum(taken.values()) <= 1.5 * sum(r.size for r in got)


def test_empty_mix(spark):
    assert mix_sources(documents(spark, [])).count() == 0
    assert [r.taken for r in mix_sources(documents(spark, [(1, None, "en", None)])).collect()] == [0]


def _scan(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [
        (i, label)
        for phrase, label in BASE_PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
    )


TEXTS = [
    "Licensed under the Apache License, Version 2.0.",
    "MIT license mit-license\nMIT  License, gnu general public license gnu general public",
    "x cc by nc 4.0 licensed under cc by-nc 4.0",
    "mİt license mit lİcense K mit license",
    "apache licenses apache_license apache license",
    "the quick brown license of the public",
    LONG + " GNU GENERAL PUBLIC LICENSE version 3 " + LONG,
    "CC BY",
    "All rights reserved.",
    "we talked about source and binary forms of verbs",
    "he moved into the public domain of debate",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. Released into the Public Domain!",
]


def test_scan_matches_brute_force(spark):
    rows = [(100 + i, t, "en", "a") for i, t in enumerate(TEXTS)] + ROWS
    got = scan_licences(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((r[0] or -1, *map(str, _scan(r[1]))) for r in rows)
    assert sorted((r.doc_id or -1, *map(str, r[1:6])) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1
        labels = [x for x in r.labels.split(",") if x]
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
    by = {r.doc_id: r for r in got}
    assert by[100].labels == "apache,apache-2.0" and by[100].score > 0.99
    assert by[102].labels == "cc-by,cc-by-nc-4.0"
    assert "gpl-3.0" in by[106].labels
    assert by[108].labels == "all-rights-reserved" and by[108].n_base == 0
    assert by[105].labels == "" and by[105].score == 0
    assert by[109].labels == by[110].labels == "" and by[109].score == by[110].score == 0
    assert by[111].labels == "bsd,public-domain"


def test_scan_of_nothing(spark):
    assert scan_licences(documents(spark, [])).count() == 0
