"""Small tables with everything that real ones have: nulls, empty and long texts, repeated rows,
ties, and columns named like those that operators make."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession

CLASHING = "score double, n_words int, key string, size int, label int, host string, path string, x int, text_evidence int, __hits int, n_hit int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
LONG = " ".join(f"w{i % 977} of{i}" for i in range(20_000))
PASSAGE = " ".join(f"passage{i}" for i in range(40))

ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t\n ", None, None),
    (4, "One two three four five six seven eight nine ten eleven twelve.", "en", "b"),
    (4, "One two three four five six seven eight nine ten eleven twelve.", "en", "b"),
    (5, "One two three four five six seven eight nine ten eleven twelve.", "de", None),
    (None, f"nobody {PASSAGE} tail", "en", "c"),
    (7, LONG, "en", "a"),
    (8, "Ünïcode wörter éè 日本語 \U0001f44d !!! $$$ | the Apache License, MIT License MIT LICENSE", "fr", "d"),
    (9, "same line\nsame line\n\nother same line\nsame line", "en", "b"),
    (10, f"{PASSAGE}", "en", "b"),
    (10, f"{PASSAGE} more", "en", "b"),
]


def documents(spark: SparkSession, rows=ROWS) -> DataFrame:
    width = len(SCHEMA.split(", "))
    full = [(*r, len(r[1]) if r[1] else None) + (None,) * (width - 5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def labels(spark: SparkSession, rows=()) -> DataFrame:
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int, text string, weight int")


def fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5
