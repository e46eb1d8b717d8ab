"""Benchmark decontamination by a prefix-filtered join of item windows with documents.

A window of an item is contained in a document only if all its words are, so with the words
ordered by rarity over the documents the necessary prefix is one word: the rarest of the
window.  Documents are joined on these words alone.  A hit at word p proposes the start
p - offset; a window that would begin before or end behind the document is out (length and
position bounds), and what remains is compared word by word.

The benchmark is processed in blocks of at most ``block_words`` words, an item of more in
pieces that overlap by a window.  Each block's index is sent to the executors, its hits are
written, and it is taken back before the next one is sent, so what a worker or the driver holds
has a fixed bound; a larger benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.llm.words import CARRIED, folded_words, utf8
from tablewright.workspace import materialize

WINDOW = 13
CONTAMINATED_SHARE = 20
BLOCK_WORDS = 2_000_000

#: Per row: words, hit spans [start, end) as flat pairs, and the items with a window inside.
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
UNITED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def item_blocks(
    benchmark: DataFrame, block_words: int, window: int = WINDOW
) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """Items as (id, words) in lists of bounded size; items without words have no window.

    Rows come to the driver one partition at a time and leave with their block.
    """
    block, size = [], 0
    most = max(block_words, window)
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    for item, text in rows.toLocalIterator():
        words = folded_words((text or "").encode())
        # Every window of a long item lies whole in one of its pieces.
        step = most - window + 1
        for at in range(0, max(1, len(words) - window + 1), step):
            piece = words[at : at + most]
            if not piece:
                continue
            if block and size + len(piece) > block_words:
                yield block
                block, size = [], 0
            block.append((item, piece))
            size += len(piece)
    if block:
        yield block


def document_frequencies(docs: DataFrame, block: list[tuple[str | None, list[bytes]]]) -> dict[bytes, int]:
    """Rows of ``docs`` that hold each word of the block."""
    shared = docs.sparkSession.sparkContext.broadcast({w for _, words in block for w in words})

    def count(batches):
        wanted = shared.value
        found: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for text in utf8(batch.column("text")):
                for w in wanted.intersection(folded_words(text)):
                    found[w] += 1
        yield pa.RecordBatch.from_pydict({"word": list(found), "n": list(found.values())}, SCHEMA)

    SCHEMA = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "word binary, n long")
    # At most one row for each word of the block.
    found = {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    shared.unpersist()
    return found


def window_index(block: list[tuple[str | None, list[bytes]]], rows_with: dict[bytes, int], window: int):
    """Rarest word of a window -> distinct (window words, offset of the rarest word, items).

    The windows of an item without an id are hit like any other, but name no item.
    """
    windows: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, words in block:
        n = min(window, len(words))
        for i in range(len(words) - n + 1):
            windows[tuple(words[i : i + n])].update([] if item is None else [item])
    index = defaultdict(list)
    for words, items in windows.items():
        at = min(range(len(words)), key=lambda j: (rows_with.get(words[j], 0), words[j], j))
        index[words[at]].append((at, list(words), tuple(sorted(items))))
    return dict(index)


def hits_of(words: list[bytes], index: dict) -> tuple[list[int], set[str]]:
    spans: list[int] = []
    items: set[str] = set()
    n = len(words)
    for p in [p for p, w in enumerate(words) if w in index]:
        for at, window, owners in index[words[p]]:
            start = p - at
            end = start + len(window)
            if start >= 0 and end <= n and words[start:end] == window:
                spans += (start, end)
                items.update(owners)
    return spans, items


def _covered(spans: list[int]) -> int:
    """Words inside the union of the spans."""
    covered, reached = 0, 0
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if end > reached:
            covered += end - max(start, reached)
            reached = end
    return covered


def find_windows(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``df`` (with text) plus n_words, n_hit, items; one pass over the texts for each block."""
    spark = df.sparkSession
    blocks = item_blocks(benchmark, block_words, window)
    first, second = next(blocks, []), next(blocks, None)

    def index_of(rows: DataFrame, block):
        return spark.sparkContext.broadcast(window_index(block, document_frequencies(rows, block), window))

    if second is None:
        # The usual case: one block's hits are all there are.
        found = df.withColumn("__of", _block_hits(index_of(df, first), True)("text"))
        return found.select(*df.columns, "__of.*")
    # Rows are numbered once, so that each block's hits can be written by themselves.
    rows = materialize(df.withColumn("__at", F.monotonically_increasing_id()), "numbered-rows")
    hits: DataFrame | None = None
    for block in chain([first, second], blocks):
        shared = index_of(rows, block)
        here = rows.select("__at", _block_hits(shared)("text").alias("__of")).where(F.size("__of.spans") > 0)
        here = materialize(here, "block-hits")
        shared.unpersist()
        hits = here if hits is None else hits.unionByName(here)
    united = hits.groupBy("__at").agg(F.collect_list("__of").alias("__all")).select("__at", _united("__all").alias("__of"))
    n_words = F.size(F.filter(F.split(_folded("text"), " "), lambda w: w != "")).cast("bigint")
    return rows.join(united, "__at", "left").select(
        *df.columns,
        n_words.alias("n_words"),
        F.coalesce("__of.n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("__of.items", F.array().cast("array<string>")).alias("items"),
    )


def _folded(text: str):
    """The text with a blank for all that is in no word."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")


def _block_hits(shared, alone: bool = False):
    """Per row the HITS of one block, or, if it is the only one, their UNITED form."""
    kind = UNITED if alone else HITS

    @F.arrow_udf(kind)
    def block_hits(texts: pa.Array) -> pa.Array:
        index = shared.value
        rows = []
        for text in utf8(texts):
            words = folded_words(text)
            spans, items = hits_of(words, index)
            row = {"n_words": len(words), "items": sorted(items)}
            rows.append(row | ({"n_hit": _covered(spans)} if alone else {"spans": spans}))
        return pa.array(rows, to_arrow_type(kind))

    return block_hits


@F.arrow_udf(UNITED)
def _united(hits: pa.Array) -> pa.Array:
    """Adds up the blocks of one row: the union of the spans and of the items."""
    rows = []
    for blocks in hits.to_pylist():
        spans = [x for b in blocks for x in b["spans"]]
        items = sorted({i for b in blocks for i in b["items"]})
        rows.append({"n_words": blocks[0]["n_words"], "n_hit": _covered(spans), "items": items})
    return pa.array(rows, to_arrow_type(UNITED))


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items) per row of ``docs``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of
    the whole item where that is shorter; a row is contaminated if 1 in CONTAMINATED_SHARE of
    its words or more are hit.  Null and empty texts have no words and no hits; items with null
    or wordless texts have no window; rows of one item_id count as one item, and an item whose
    id is null hits like any other but is in no list.  Repeated rows stay; an empty benchmark
    hits nothing.  Other columns are not read.
    """
    found = find_windows(docs.select("doc_id", F.col("text").cast("string").alias("text")), benchmark, window, block_words)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        "items",
    )


def is_contaminated():
    return (F.col("n_hit") > 0) & (F.col("n_hit") * CONTAMINATED_SHARE >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated; see ``decontaminate``.

    Null and empty texts are never contaminated and stay, as do all repeats of a clean row.
    """
    rows = docs.select(F.struct("*").alias(CARRIED), F.col("text").cast("string").alias("text"))
    return find_windows(rows, benchmark, **options).where(~is_contaminated()).select(f"{CARRIED}.*")
