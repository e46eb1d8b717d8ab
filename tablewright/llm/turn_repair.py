"""Repair of conversations whose turns do not alternate, by alignment to the grammar's targets.

Each conversation is first read as a sequence of short marks, one a turn, in the order of its
turns; ``turn_alignment`` finds the cheapest repair of that sequence.  Then the turns are read
again with their texts beside the audit, edit by edit.  Both readings stream sorted rows: what
a task holds of a conversation is a byte a turn and the audit, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tablewright.llm.turn_alignment import repair, repaired_roles
from tablewright.workspace import materialize

ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

# The faults that ``damaged`` makes, by the remainder of a turn's checksum.
DROPPED, EMPTIED, CUT, REPEATED, RENAMED = range(5)
REMAINDERS = 20

PLAIN = r"[^\x20\x09-\x0D]"

AUDIT = T.StructType(
    [T.StructField("conv_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField("audit", T.StringType())]
)
DIGESTED = T.StructType([*AUDIT.fields, T.StructField("repaired_sha256", T.StringType())])
TURNS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("edit", T.StringType()),
    ]
)


def _written(column: str) -> Column:
    """The value as text; null is one space."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): the turns with the faults of their checksum.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a turn, which stays as a marked row, 1
    empties its text, 2 takes its full stops, exclamation and question marks, 3 repeats it
    and 4 calls its speaker user.
    """
    fault = F.crc32(F.concat(_written("conv_id"), F.lit(":"), _written("turn"))) % REMAINDERS
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _written("role").alias("role"),
        _written("text").alias("text"),
        fault.alias("fault"),
    )
    text = (
        F.when(F.col("fault") == EMPTIED, "")
        .when(F.col("fault") == CUT, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == RENAMED, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fault") == DROPPED).alias("dropped"),
        F.explode(F.when(F.col("fault") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns with the digest that decides ties; null role and text are one space, as in ``damaged``."""
    dropped = F.col("dropped") if "dropped" in turns.columns else F.lit(False)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _written("role").alias("role"),
        _written("text").alias("text"),
        F.coalesce(dropped, F.lit(False)).alias("dropped"),
    )
    return rows.withColumn("digest", F.unhex(F.md5("text")))


def audit_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation.

    ``turns`` has conv_id, turn, role, text and, if some rows only name their conversation,
    dropped.  Turns are taken in order, null first, ties by role and then by a digest of the
    text.  A turn is blank without a visible character, else a duplicate if role and text came
    before, else truncated if its last visible character ends no sentence.  gaps are missing
    numbers between the least and the largest turn; illegal are neighbours that do not follow
    one another.  A conversation without turns has zeros and an empty audit; a null conv_id is
    a conversation too; an empty table has none.  Other columns are not read.
    """
    visible = F.regexp_extract("text", rf"({PLAIN})[\x20\x09-\x0D]*\z", 1)
    marks = _ordered(turns).select(
        "conv_id", "turn", "role", "digest", "dropped",
        (visible == "").alias("blank"), (~visible.rlike("^[.!?]$")).alias("cut"),
    )
    # Rows dealt by conversation are also apart by text, so the window moves nothing again.
    before = Window.partitionBy("conv_id", "dropped", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    seen = marks.repartition("conv_id").withColumn("again", F.row_number().over(before) > 1)
    streamed = seen.sortWithinPartitions("conv_id", "turn", "role", "digest").select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "dropped", "blank", "again", "cut"
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(AUDIT)
        talk = None
        for batch in batches:
            done = []
            for conv, *turn in zip(*[c.to_pylist() for c in batch.columns]):
                if talk is None or talk.conv_id != conv:
                    if talk is not None:
                        done.append(talk.row())
                    talk = _Talk(conv)
                talk.add(*turn)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if talk is not None:
            yield pa.RecordBatch.from_pylist([talk.row()], schema)

    return streamed.mapInArrow(read, AUDIT)


class _Talk:
    """What is kept of one conversation while its turns go by."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.marks = bytearray()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.least = self.last = None
        self.n_turns = 0
        self.before = None

    def add(self, turn, initial, dropped, blank, again, cut) -> None:
        if dropped:
            return
        if turn is not None and turn != self.last:
            self.least = turn if self.least is None else self.least
            self.last = turn
            self.n_turns += 1
        fault = "blank" if blank else "duplicate" if again else "truncated" if cut else None
        if fault:
            self.counts[fault] += 1
        if self.before is not None and self.before + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.before = initial
        mark = initial if initial in ("u", "a", "s") else "x"
        self.marks += (mark if fault is None else mark.upper() if fault == "truncated" else "-").encode()

    def row(self) -> dict:
        cost, audit = repair(self.marks.decode())
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.n_turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.counts, "cost": cost, "audit": audit}


def _edited(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of each conversation in order, behind one row that carries its audit."""
    rows = _ordered(turns).where("not dropped").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "digest", "text", F.lit(None).cast(AUDIT).alias("found")
    )
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"), F.struct(*AUDIT.names).cast(AUDIT).alias("found"),
    )
    both = rows.unionByName(heads).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").select("found", "role", "text")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[tuple[str, str, str]]]]:
    """(audit row, edits) in order: a head with its leading insertions, then each turn's edits.

    An edit is (initial of the edit, role, text); insertions come with the turn before them.
    """
    found, plan, at = {}, [], 0

    def inserted() -> Iterator[tuple[str, str, str]]:
        nonlocal at
        while at < len(plan) and plan[at][0] == "I":
            yield "I", ROLES[plan[at][1]], ""
            at += 1

    for batch in batches:
        for head, role, text in zip(*[c.to_pylist() for c in batch.columns]):
            if head is not None:
                found, at = head, 0
                plan = list(zip(head["audit"], repaired_roles(head["audit"])))
                yield found, list(inserted())
                continue
            edit, initial = plan[at]
            at += 1
            yield found, [(edit, ROLES[initial] if edit == "R" else role, text), *inserted()]


def digest_repairs(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with repaired_sha256, the digest of the newline-joined ``role:text`` that stay."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(DIGESTED)
        last, state, empty = None, None, True

        def done():
            return pa.RecordBatch.from_pylist([{**last, "repaired_sha256": state.hexdigest()}], schema)

        for found, edits in _walk(batches):
            if found is not last:
                if last is not None:
                    yield done()
                last, state, empty = found, hashlib.sha256(), True
            for edit, role, text in edits:
                if edit != "D":
                    state.update(f"{'' if empty else '\n'}{role}:{text}".encode())
                    empty = False
        if last is not None:
            yield done()

    return _edited(turns, audits).mapInArrow(read, DIGESTED)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit): the turns of the repaired conversations, from 0.

    edit is K(eep), R(erole) or I(nsert), the last with an empty text; see ``audit_turns``.
    """
    audits = materialize(audit_turns(turns), "audits")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(TURNS)
        last, position = None, 0
        for found, edits in _walk(batches):
            if found is not last:
                last, position = found, 0
            kept = [e for e in edits if e[0] != "D"]
            if kept:
                yield pa.RecordBatch.from_pylist(
                    [
                        {"conv_id": found["conv_id"], "position": position + i, "role": role, "text": text, "edit": edit}
                        for i, (edit, role, text) in enumerate(kept)
                    ],
                    schema,
                )
                position += len(kept)

    return _edited(turns, audits).mapInArrow(read, TURNS)


def repair_report(turns: DataFrame) -> DataFrame:
    """The audit of every conversation and the digest of its repaired turns; see ``audit_turns``."""
    return digest_repairs(turns, materialize(audit_turns(turns), "audits"))
