"""Statistics of a document's text, taken in one pass inside Arrow batches."""

from __future__ import annotations

from collections import Counter

import numpy as np

WHITE = b" \t\n\r\x0b\x0c"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
DIGITS = b"0123456789"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SENTENCE_MARKS = b".,;:?"
WINDOW = 5

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_bangs", "n_marks", "n_distinct", "n_same_next", "top_count",
)
FEATURES = (
    "log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate",
    "digit_rate", "bang_rate", "mark_rate", "distinct_rate", "same_next_rate", "top_rate",
)


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that stand in the text twice or more, first occurrences included."""
    windows = list(zip(*(words[i:] for i in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, reached = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + window - max(i, reached)
            reached = i + window
    return covered


def dup_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(lines), len(lines) - len(set(lines))


def counts(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS; all 0 for an empty text."""
    words = text.split()
    n_lines, n_dup = dup_lines(text)
    times = Counter(words)

    def of(chars: bytes) -> int:
        return len(text) - len(text.translate(None, chars))

    return (
        len(words),
        len(text.translate(None, WHITE + CONTINUATION)),
        of(SYMBOLS),
        n_dup,
        repeat_words(words),
        n_lines,
        of(UPPER),
        of(DIGITS),
        of(b"!"),
        of(SENTENCE_MARKS),
        len(times),
        sum(map(bytes.__eq__, words, words[1:])),
        max(times.values(), default=0),
    )


def count_matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([counts(t) for t in texts], dtype=np.int64).reshape(len(texts), len(COUNTS))


def features(matrix: np.ndarray) -> np.ndarray:
    """The values of FEATURES from rows of COUNTS; rates of an empty text are 0."""
    c = {name: matrix[:, i].astype(np.float64) for i, name in enumerate(COUNTS)}
    per_word = 1.0 / np.maximum(c["n_words"], 1.0)
    per_char = 1.0 / np.maximum(c["word_chars"], 1.0)
    return np.column_stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] * per_word,
            c["n_symbols"] * per_word,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1.0),
            c["n_repeat_words"] * per_word,
            c["n_upper"] * per_char,
            c["n_digits"] * per_char,
            c["n_bangs"] * per_word,
            c["n_marks"] * per_word,
            c["n_distinct"] * per_word,
            c["n_same_next"] * per_word,
            c["top_count"] * per_word,
        ]
    )
