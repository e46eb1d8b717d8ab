from __future__ import annotations

import hashlib
import json
import re

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tablewright.llm import token_counts
from tablewright.llm.decontaminate import decontaminate, drop_contaminated
from tablewright.llm.token_counts import MergeTable, count_tokens
from tests.llm.awkward import PASSAGE, ROWS, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def table():
    with open(PATH) as f:
        return MergeTable(json.load(f))


SPACES = " \n\t\r\x0b\x0c\x1c\x1d\x85  　"


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.one_of(st.sampled_from("aehinrst'ldv<|>0²" + SPACES), st.characters(codec="utf-8")), max_size=60))
def test_counts_are_those_of_the_library(library, table, text):
    assert table.count(text) == len(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["a<|endoftext|>b<|endoftext|>", "x" * 3000, "don't we'll I'M", "  \n \n  a", "ab" * 2000])
def test_counts_of_special_and_long_pieces(library, table, text):
    assert table.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_memory_is_bounded(monkeypatch, table):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    for i in range(10):
        table.count(f"word{i} other{i}")
        assert len(table) <= 3 + 4


def test_counts_of_awkward_rows(spark, library):
    got = count_tokens(documents(spark), PATH).collect()
    want = []
    for doc_id, text, *_ in ROWS:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id or -1, len((text or "").encode()), n, n > 1024))
    assert sorted((r.doc_id or -1, *r[1:]) for r in got) == sorted(want)
    assert count_tokens(documents(spark, []), PATH).count() == 0


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text):
    return re.findall(WORD, (text or "").translate({c: c + 32 for c in range(65, 91)}))


def _brute(text, items):
    words, hit, found = _words(text), set(), set()
    for item, t in items:  # an item without an id hits, but is in no list
        w = _words(t)
        n = min(13, len(w))
        for i in range(len(w) - n + 1) if n else ():
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[i : i + n]:
                    hit.update(range(p, p + n))
                    found.update([] if item is None else [str(item)])
    sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(words)


ITEMS = [
    (1, PASSAGE),
    (2, "seven Eight NINE"),
    (10, None),
    (11, " ?! "),
    (12, " ".join(f"passage{i}" for i in range(5, 19)) + " other"),
    (2, "same line same"),
    (13, "line line line line line line line line line line line line line line"),
    (None, " ".join(f"secret{i}" for i in range(14))),
    (14, " ".join(f"long{i}" for i in range(100))),
]


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_windows_match_brute_force(spark, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [r for r in ROWS if r[0] != 7] + [(70, "line " * 30, "en", "a"), (71, "x " * 400 + "seven eight nine", "en", "a")]
    rows += [(72, " ".join(f"Secret{i}" for i in range(13)), "en", "a"), (73, " ".join(f"long{i}" for i in range(20, 80)) + " É-É", "en", "a")]
    got = decontaminate(documents(spark, rows), items, block_words=block_words).collect()
    assert sorted((r.doc_id or -1, *r[1:6]) for r in got) == sorted((r[0] or -1, *_brute(r[1], ITEMS)) for r in rows)
    kept = drop_contaminated(documents(spark, rows), items, block_words=block_words)
    clean = [r[0] or -1 for r in rows if not _brute(r[1], ITEMS)[4]]
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(clean) and kept.columns == documents(spark).columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate(documents(spark), none).collect()
    assert len(got) == len(ROWS) and not any(r.n_hit or r.contaminated for r in got)
    assert decontaminate(documents(spark, []), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0
