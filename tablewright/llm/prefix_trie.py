"""Prefix trie of conversations by collapsing whole sequences.

Conversations with the same turns are one weighted sequence with a list of the ids that end
there.  A sequence that is a proper prefix of another one is found by an anti-join and is no
leaf.  The prefixes of the distinct sequences, each with its sequence's weight, are then added
up: a node is a group of equal prefixes.

A prefix of d turns is named by its length and two 64-bit sums over its turns, each turn hashed
together with its place, so names come from running sums.  Those run over sorted blocks, and
no conversation, node or list of ends is ever held whole by a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.operators.ordering import ranked, running_totals
from tablewright.workspace import materialize

#: Ids in one piece of a list of ends.
PIECE = 512
#: The name of a node: depth and the two sums of its turns.
NAME = ["depth", "k1", "k2"]
#: A rebuilt conversation starts with turns of the first of so many neighbouring ids.
FAMILY, MOST_HEAD = 5, 9


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_key, n_bytes): turns by their order from 1, null turns first.

    Rows of one turn go by role, then by a digest of role and text.  A null role or text is
    empty; rows without a conv_id belong to no conversation and are left out.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        F.md5(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))).alias("turn_key"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    # Equal rows are interchangeable, but running totals want each sort key once.
    order = ["turn", "role", "turn_key"]
    once = turns.groupBy("conv_id", *order).agg(F.count("*").alias("times"), F.first("n_bytes").alias("n_bytes"))
    rows = running_totals(once, order, {"last": F.col("times")}, ["conv_id"])
    place = F.explode(F.sequence(F.col("last") - F.col("times") + 1, F.col("last")))
    return rows.select("conv_id", place.alias("pos"), "turn_key", "n_bytes")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % MOST_HEAD


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id) of every conversation and (conv_id, depth, turn_key, n_bytes) of the rebuilt ones.

    Conversation c takes the first h turns of conversation c - c % 5, then its own after its
    first h, where h is crc32(c) % 9; the remainder has the sign of c.
    """
    turns = materialize(numbered_turns(conversations), "turns")
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < MOST_HEAD))
    n_heads = heads.groupBy(F.col("conv_id").alias("first")).agg(F.count("*").alias("n_head"))
    convs = materialize(
        sizes.select("conv_id", first.alias("first"), head_length(F.col("conv_id")).alias("h"))
        .join(n_heads, "first", "left")
        .withColumn("n_head", F.least("h", F.coalesce("n_head", F.lit(0)))),
        "convs",
    )
    borrowed = (
        heads.withColumnRenamed("conv_id", "first")
        .join(convs.where("n_head > 0"), "first")
        .where("pos <= n_head")
        .select("conv_id", F.col("pos").alias("depth"), "turn_key", "n_bytes")
    )
    own = (
        turns.join(convs, "conv_id")
        .where("pos > h")
        .select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("depth"), "turn_key", "n_bytes")
    )
    return convs.select("conv_id"), borrowed.unionByName(own)


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "turn_key", "depth").cast("decimal(38,0)")


def named_prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, n_bytes, k1, k2, p1, p2): the name of each prefix and of the one before."""
    hashed = turns.select("conv_id", "depth", "n_bytes", _turn_hash(1).alias("h1"), _turn_hash(2).alias("h2"))
    named = running_totals(hashed, ["depth"], {"k1": "h1", "k2": "h2"}, ["conv_id"])
    before = {f"p{i}": (F.col(f"k{i}") - F.col(f"h{i}")).cast("decimal(38,0)") for i in (1, 2)}
    names = {f"k{i}": F.col(f"k{i}").cast("decimal(38,0)") for i in (1, 2)}
    return named.withColumns(before | names).drop("h1", "h2")


def _piece_text() -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")))


def end_pieces(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(name, piece, ids): the ascending ids that end at a node, ``piece`` of them to a row."""
    placed = ranked(ends, ["conv_id"], NAME, "place")
    part = F.floor((F.col("place") - 1) / piece).alias("piece")
    return placed.groupBy(*NAME, part).agg(_piece_text().alias("ids"))


def end_digests(pieces: DataFrame) -> DataFrame:
    """(name, ends_sha256): the digest of the comma-joined ids.

    A list of one piece is hashed where it stands; the pieces of a longer one stream in order
    through one task, which holds nothing but the state of the digest.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def done():
            return pa.RecordBatch.from_pylist([{"k": name, "ends_sha256": state.hexdigest()}], out)

        out = pa.schema([("k", pa.string()), ("ends_sha256", pa.string())])
        for batch in batches:
            for k, ids in zip(batch.column("k").to_pylist(), batch.column("ids").to_pylist()):
                if k != name:
                    if state is not None:
                        yield done()
                    name, state = k, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if state is not None:
            yield done()

    counts = pieces.groupBy(*NAME).agg(F.count("*").alias("n_pieces"), F.min_by("ids", "piece").alias("ids"))
    short = counts.where("n_pieces = 1").select(*NAME, F.sha2(F.col("ids"), 256).alias("ends_sha256"))
    long = pieces.join(counts.where("n_pieces > 1").select(*NAME), NAME)
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in NAME]).alias("k")
    streamed = long.select(key, "piece", "ids").repartition("k").sortWithinPartitions("k", "piece")
    parts = F.split("k", ":")
    hashed = streamed.select("k", "ids").mapInArrow(digest, "k string, ends_sha256 string").select(
        parts[0].cast("bigint").alias("depth"),
        parts[1].cast("decimal(38,0)").alias("k1"),
        parts[2].cast("decimal(38,0)").alias("k2"),
        "ends_sha256",
    )
    return short.unionByName(hashed)


def _zero() -> Column:
    return F.lit(0).cast("decimal(38,0)")


def sequences_of(convs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(conv_id, name) of each whole conversation; one without turns ends at the root."""
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*NAME)).alias("last"))
    whole = convs.join(last, "conv_id", "left")
    return whole.select(
        "conv_id",
        F.coalesce(F.col("last.depth"), F.lit(0)).cast("bigint").alias("depth"),
        F.coalesce(F.col("last.k1"), _zero()).alias("k1"),
        F.coalesce(F.col("last.k2"), _zero()).alias("k2"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations (conv_id, turn, role, text).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    see the module.  conv_id is the node's smallest member, the parent's is null for the root;
    saved_tokens adds up, over the subtree, what sharing a turn saves in UTF-8 bytes; the digest
    is of the ids whose conversation ends here, that of the empty text where none does.

    Turns are ordered with null first, ties as in ``numbered_turns``; null and empty roles and
    texts are the same; repeated rows are turns of their own; rows without conv_id are left
    out; an empty table has no node, not even a root.  Other columns are not read.
    """
    convs, turns = rebuilt_turns(conversations)
    prefixes = materialize(named_prefixes(turns), "prefixes")
    ends = materialize(sequences_of(convs, prefixes), "ends")

    # Equal conversations collapse to one sequence, which its smallest id stands for.
    weighted = ends.groupBy(*NAME).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    weighted = materialize(weighted, "sequences")
    chosen = weighted.select("conv_id", "weight", F.col("depth").alias("length"))
    root = chosen.select(
        "conv_id", "weight", "length", F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("n_bytes"),
        *[_zero().alias(c) for c in ("k1", "k2", "p1", "p2")],
    )
    paths = prefixes.withColumn("depth", F.col("depth").cast("bigint")).join(chosen, "conv_id").unionByName(root)
    paths = materialize(paths, "paths")

    proper = paths.where("depth < length").select(*NAME).distinct()
    leaves = weighted.join(proper, NAME, "left_anti").select("conv_id", F.lit(1).alias("is_leaf"))
    ends_here = weighted.select("conv_id").join(leaves, "conv_id", "left")
    marked = paths.join(ends_here, "conv_id")
    nodes = materialize(
        marked.groupBy(*NAME).agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.count("is_leaf").alias("n_leaves"),
            F.first("p1").alias("p1"),
            F.first("p2").alias("p2"),
        ),
        "nodes",
    )

    # Along a sequence the bytes of all its turns count by weight, and those of the nodes it
    # stands for count once less.  A sequence stands for the nodes that bear its smallest id,
    # so every node of a subtree is stood for by exactly one sequence through it.
    owned = nodes.select("conv_id", "depth", F.lit(1).alias("owns"))
    shares = paths.select("conv_id", *NAME, "weight", "n_bytes").join(owned, ["conv_id", "depth"], "left")
    gain = (F.col("weight") - F.coalesce("owns", F.lit(0))) * F.col("n_bytes")
    below = running_totals(shares, [F.col("depth").desc()], {"gain": gain}, ["conv_id"])
    saved = below.groupBy(*NAME).agg(F.sum("gain").cast("bigint").alias("saved_tokens"))

    parent = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 0").groupBy(*parent).agg(F.count("*").alias("n_children"))
    # The root's children are every first turn: its one row needs no join by key.
    top = nodes.where("depth = 0").select(F.col("conv_id").alias("top"))
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    ).where("depth > 1")
    return (
        nodes.join(above, ["depth", "p1", "p2"], "left")
        .join(children, NAME, "left")
        .join(saved, NAME)
        .join(end_digests(end_pieces(ends)), NAME, "left")
        .select(
            "conv_id",
            "depth",
            F.when(F.col("depth") == 1, top.scalar()).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
