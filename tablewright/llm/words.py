"""Words and folds, the same on the JVM side and inside Arrow batches.

Plain words are runs of anything but the six ASCII white-space characters.  Folded words
are runs of digits, letters and everything beyond ASCII after A-Z has been lower-cased.
"""

from __future__ import annotations

import ctypes
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The word classes as patterns that Java, RE2 and Python read alike.
PLAIN_WORD = r"[^\x20\x09-\x0D]+"
FOLDED_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = UPPER.lower()
LOWER_ASCII = bytes.maketrans(UPPER, LOWER)
WORD_BYTES = set(b"0123456789" + LOWER) | set(range(0x80, 0x100))
FOLD = bytes(b if b in WORD_BYTES else 0x20 for b in LOWER_ASCII)

#: Rows are carried whole under this name while an operator adds its own columns.
CARRIED = "__row"


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns freed memory to the system.  Worker processes are reused by later stages, beside
    which what they no longer need would count."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null becomes empty.  The batch before is given back."""
    give_back()
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def plain_words(text: bytes) -> list[bytes]:
    """``bytes.split`` without argument splits on exactly the six white-space characters."""
    return text.split()


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def fold_number(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds)).cast("int")


def carry(df: DataFrame, columns: Sequence[str], types: dict[str, str] | None = None) -> DataFrame:
    """The named columns beside the whole row, so that no column of the caller can clash."""
    return df.select(F.struct("*").alias(CARRIED), *columns)


def uncarry(df: DataFrame) -> DataFrame:
    return df.select(f"{CARRIED}.*")
