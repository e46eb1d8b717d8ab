"""N-gram Jaccard self-join with a MinHash LSH forest.

Texts with the same words are one text with a number of copies.  Each distinct text stands in
every tree of the forest at the path its min-hashes spell.  From the full depth the matched
prefix is shortened until two texts exactly at the threshold share a prefix in some tree with
the target recall; texts under one shortened prefix are a bucket.  In a bucket signatures are
compared, and what may be similar is linked into candidate groups.  Inside a candidate group
all pairs are verified exactly on their shingle sets, which are fetched once for each text.

Buckets and groups of any size are cut into blocks by hash, and each pair of blocks is one
unit of work of bounded size that gives sums and a spanning set of links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablewright.llm.components import components
from tablewright.llm.shingles import MinHash, overlaps, shingle_set, spanning, text_key
from tablewright.llm.words import CARRIED, folded_words, uncarry, utf8
from tablewright.workspace import materialize

THRESHOLD = 0.8
TREES, DEPTH = 16, 6
RECALL = 0.9999
#: Texts of a block and, on average, their shingles; two blocks meet in one unit of work.
BLOCK, BLOCK_SHINGLES = 256, 500_000
#: Bits of the filter that tells texts of no group apart; its size does not depend on the data.
FILTER_BITS = 2**26
#: Signatures that agree this many standard deviations less than expected at the threshold part.
DEVIATIONS = 4.5

SIGNED = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
        T.StructField("prefixes", T.ArrayType(T.LongType())),
        T.StructField("n_shingles", T.IntegerType()),
    ]
)


def prefix_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix with which a pair at the threshold meets in some tree with ``recall``."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    return 1


def least_agreement(threshold: float, hashes: int) -> int:
    """Agreeing bytes of two signatures below which they are taken to be under the threshold."""
    p = threshold + (1 - threshold) / 256
    return int(np.floor(hashes * p - DEVIATIONS * np.sqrt(hashes * p * (1 - p))))


def _signer(depth: int):
    minhash = MinHash(TREES, DEPTH)
    turn = (np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[:, None]

    @F.arrow_udf(SIGNED)
    def sign(texts: pa.Array) -> pa.Array:
        rows = []
        for text in utf8(texts):
            words = folded_words(text)
            if not words:
                rows.append(None)
                continue
            shingles = shingle_set(words)
            values = minhash(shingles)
            mixed = turn[:, 0].copy()
            for d in range(depth):
                mixed = (mixed ^ values[:, d]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(31)
            rows.append(
                {
                    "key": text_key(words),
                    "signature": values.astype(np.uint8).tobytes(),
                    "prefixes": mixed.view(np.int64),
                    "n_shingles": len(shingles),
                }
            )
        return pa.array(rows, to_arrow_type(SIGNED))

    return sign


def _block_pairs(df: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in, out of ``blocks``."""
    blocks = F.greatest(F.lit(1), F.ceil(blocks)).cast("int")
    own = df.withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    dealt = met.repartition(group, "low", "high")
    return dealt.sortWithinPartitions(group, "low", "high", "key")


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Runs of equal ``by`` values over sorted batches, also across their ends."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        marks = list(zip(*[table.column(c).to_pylist() for c in by]))
        cuts = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
        for a, b in zip(cuts, cuts[1:]):
            if held and marks[a] != last:
                yield pa.concat_tables(held)
                held = []
            held.append(table.slice(a, b - a))
            last = marks[a]
    if held:
        yield pa.concat_tables(held)


def _in_unit(table: pa.Table) -> np.ndarray:
    """Which pairs of a unit of work belong to it: those of two blocks, or all of the one."""
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    if low == high:
        return ~np.eye(table.num_rows, dtype=bool)
    block = np.array(table.column("block").to_pylist())
    return block[:, None] != block[None, :]


LINK = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())])


def _candidate_links(members: DataFrame, least: int) -> DataFrame:
    def link(batches):
        for table in _groups(batches, ["prefix", "low", "high"]):
            keys = table.column("key").to_pylist()
            if len(keys) < 2:
                continue
            s = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(len(keys), -1)
            agree = np.empty((len(keys), len(keys)), bool)
            for i in range(len(keys)):
                agree[i] = (s == s[i]).sum(axis=1) >= least
            pairs = spanning(agree & _in_unit(table))
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i, _ in pairs], pa.binary()), pa.array([keys[j] for _, j in pairs], pa.binary()), pa.array([None] * len(pairs), pa.int64())],
                schema=LINK,
            )

    return members.mapInArrow(link, "a binary, b binary, links long").select("a", "b")


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """Rows (key, null, links) with the linked copies of a text, and (a, b, null) spanning links."""

    def verify(batches):
        for table in _groups(batches, ["component", "low", "high"]):
            keys = table.column("key").to_pylist()
            if len(keys) < 2:
                continue
            copies = np.array(table.column("copies").to_pylist(), np.int64)
            # Views of the batch, not copies.
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
            both = overlaps(sets)
            size = np.diag(both)
            union = size[:, None] + size[None, :] - both
            linked = (both >= threshold * union - 1e-9) & _in_unit(table)
            links = linked @ copies
            pairs = spanning(linked)
            own = [i for i in range(len(keys)) if links[i]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[i] for i in own] + [keys[i] for i, _ in pairs], pa.binary()),
                    pa.array([None] * len(own) + [keys[j] for _, j in pairs], pa.binary()),
                    pa.array([int(links[i]) for i in own] + [None] * len(pairs), pa.int64()),
                ],
                schema=LINK,
            )

    return members.mapInArrow(verify, "a binary, b binary, links long")


class KeyFilter:
    """A bitmap of fixed size over keys: a key outside it is in no group, a key inside may be."""

    def __init__(self, keys: DataFrame, bits: int = FILTER_BITS):
        self.bits = bits
        place = F.conv(F.hex(F.substring("key", 1, 4)), 16, 10).cast("bigint") % bits + 1
        parts = (
            keys.select(place.alias("p"))
            .groupBy(F.bitmap_bucket_number("p").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bitmap"))
        )
        held = bytearray(bits // 8)
        # At most bits / 32768 rows of 4 KB.
        for r in parts.toLocalIterator():
            at = (r.bucket - 1) * 4096
            held[at : at + 4096] = r.bitmap
        self.shared = keys.sparkSession.sparkContext.broadcast(bytes(held))

    def test(self):
        bits, shared = self.bits, self.shared

        def may_hold(key: bytes) -> bool:
            place = int.from_bytes(key[:4], "big") % bits
            return bool(shared.value[place >> 3] >> (place & 7) & 1)

        return may_hold


def _fetch_shingles(docs: DataFrame, wanted: KeyFilter) -> DataFrame:
    """(key, shingles) for every distinct text that the filter lets through."""
    may_hold = wanted.test()
    kind = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("shingles", T.BinaryType())])

    @F.arrow_udf(kind)
    def fetch(texts: pa.Array) -> pa.Array:
        rows = []
        for text in utf8(texts):
            words = folded_words(text)
            key = text_key(words) if words else None
            found = key is not None and may_hold(key)
            rows.append({"key": key, "shingles": shingle_set(words).tobytes()} if found else None)
        return pa.array(rows, to_arrow_type(kind))

    found = docs.select(fetch(F.col("text").cast("string")).alias("f")).where("f is not null")
    return found.groupBy(F.col("f.key").alias("key")).agg(F.first("f.shingles").alias("shingles"))


def text_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(signed rows: doc_id, key), (distinct texts: key, class_key, class_id, copies, n_links)."""
    depth = prefix_depth(threshold, TREES, DEPTH, recall)
    signed = materialize(
        docs.select("doc_id", _signer(depth)(F.col("text").cast("string")).alias("s")).select("doc_id", "s.*"), "signed"
    )
    texts = materialize(
        signed.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("first_id"),
            F.first("signature").alias("signature"),
            F.first("prefixes").alias("prefixes"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "texts",
    )
    placed = texts.select("key", F.explode("prefixes").alias("prefix"))
    buckets = placed.groupBy("prefix").agg(F.count("*").alias("size")).where("size > 1")
    members = placed.join(buckets, "prefix").join(texts.select("key", "signature"), "key")
    links = _candidate_links(_block_pairs(members, "prefix", F.col("size") / BLOCK), least_agreement(threshold, TREES * DEPTH))
    groups = materialize(components(links).withColumnRenamed("node", "key"), "groups")

    shingles = _fetch_shingles(docs, KeyFilter(groups))
    counted = groups.join(texts.select("key", "copies", "n_shingles"), "key")
    sizes = counted.groupBy("component").agg(
        F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks")
    )
    verifiable = counted.drop("n_shingles").join(sizes, "component").join(shingles, "key")
    verified = materialize(_verified(_block_pairs(verifiable, "component", F.col("blocks")), threshold), "verified")
    linked = verified.where("links is not null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    classes = components(verified.where("links is null").select("a", "b")).select(
        F.col("node").alias("key"), F.col("component").alias("class_key")
    )
    joined = (
        texts.select("key", "copies", "first_id")
        .join(linked, "key", "left")
        .join(classes, "key", "left")
        .withColumn("class_key", F.coalesce("class_key", "key"))
    )
    names = joined.groupBy("class_key").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_rows"))
    return signed.select("doc_id", "key"), joined.join(names, "class_key").select(
        "key",
        "class_key",
        "class_id",
        "class_rows",
        "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def join_similar(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies) for every row of ``docs`` (doc_id, text).

    Two rows are linked if the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``; words are folded, and a text of fewer words is one shingle.  n_links
    counts the linked rows, copies included; class_id is the smallest doc_id that links lead
    to.  A null text and one without words has no shingles: it is its own class and has no
    links.  Repeated rows are copies of each other; other columns are not read.
    """
    signed, texts = text_classes(docs, threshold, recall)
    return signed.join(texts, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
    )


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns: of each class the row with the smallest doc_id.

    Where that id has several rows, the first by words, then by text stays.  Rows without words
    all stay.  Only rows of classes with several rows are moved between executors.
    """
    _, texts = text_classes(docs, threshold, recall)
    several = materialize(texts.where("class_rows > 1").select("key", "class_key", "class_id"), "several")
    may_hold = KeyFilter(several).test()

    @F.arrow_udf(T.BinaryType())
    def asked_key(texts: pa.Array) -> pa.Array:
        """The key of a text that may be in a class of several rows, else null."""
        keys = (text_key(w) if w else None for w in map(folded_words, utf8(texts)))
        return pa.array([k if k is not None and may_hold(k) else None for k in keys], pa.binary())

    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias(CARRIED), "doc_id", text.alias("text"), asked_key(text).alias("key"))
    # A row the filter lets through by chance meets no class and stays.
    asked = rows.where("key is not null").join(several, "key", "left")
    alone = asked.where("class_key is null").select(CARRIED)
    firsts = (
        asked.where("class_key is not null and doc_id <=> class_id")
        .groupBy("class_key")
        .agg(F.min_by(CARRIED, F.struct("key", "text")).alias(CARRIED))
        .select(CARRIED)
    )
    return uncarry(rows.where("key is null").select(CARRIED).unionByName(alone).unionByName(firsts))
