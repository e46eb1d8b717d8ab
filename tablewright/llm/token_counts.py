"""Byte-pair token counts without identifiers.

A piece of text starts as one symbol per byte.  Adjacent pairs wait in a heap by merge rank,
the symbols form a linked list, and the lowest-rank pair is merged again and again.  Each
merge removes one symbol, so the count is the bytes minus the merges.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

LIMIT = 1024
#: Counts of pieces a worker remembers; the memory starts again when it is full.
REMEMBERED = 400_000

# The split of byte-level vocabularies; \s is Unicode White_Space.
WIDE_SPACES = "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACE = rf"\t-\r\x20\x85\xa0{WIDE_SPACES}"
SPLIT = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable bytes stand
    for themselves, the others take the code points from 256 on in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class MergeTable(dict):
    """Piece of text -> number of tokens, filled when a piece is first asked for."""

    def __init__(self, vocabulary: dict):
        super().__init__()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in vocabulary["model"]["merges"]]
        self.ranks = {(left, right): rank for rank, (left, right) in enumerate(pairs)}
        self.symbols = byte_symbols()
        special = sorted((t["content"] for t in vocabulary["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces = regex.compile(SPLIT)

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.merged(piece.encode())
        return n

    def merged(self, data: bytes) -> int:
        symbols = [self.symbols[b] for b in data]
        n = len(symbols)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        heap = []
        for i in range(n - 1):
            rank = ranks.get((symbols[i], symbols[i + 1]))
            if rank is not None:
                heap.append((rank, i))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # A merge on either side may have changed the pair since it was put in the heap.
            if symbols[i] is None or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i] += symbols[j]
            symbols[j] = None
            merges += 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks.get((symbols[i], symbols[k]))
                if rank is not None:
                    heapq.heappush(heap, (rank, i))
            h = before[i]
            if h >= 0:
                rank = ranks.get((symbols[h], symbols[i]))
                if rank is not None:
                    heapq.heappush(heap, (rank, h))
        return n - merges

    def count(self, text: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        parts, total = [text], 0
        if self.special is not None:
            parts = self.special.split(text)
            total = len(parts) - 1
        return total + sum(sum(map(self.__getitem__, self.pieces.findall(part))) for part in parts if part)


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    ``vocabulary_path`` names the JSON file of a byte-level vocabulary on the driver; its size
    does not depend on the data.  A null or empty text has 0 bytes and 0 tokens.  The strings
    of special tokens count one each, as the vocabulary's own library has it.  Rows are counted
    each for itself, so repeated rows and ids are kept; other columns are not read.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = json.load(f)
    vocabulary = {"model": {"merges": vocabulary["model"]["merges"]}, "added_tokens": vocabulary["added_tokens"]}
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    held: list[MergeTable] = []

    def measure(batches):
        if not held:
            held.append(MergeTable(shared.value))
        table = held[0]
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts = [table.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(measure, f"doc_id {doc_id}, n_bytes long, n_tokens long, over_limit boolean")
