"""Toxicity by a subsequence-kernel support vector machine with Nystroem landmarks.

A text is a set of units: its words without punctuation and digits, words with the hidden
letters kept as such ("id**t"), and runs of very short words joined ("i d i o t").  The landmarks
are pieces of words that labelled toxic texts have significantly more often than clean ones, as
many as it takes to cover all such words.  A text's similarities to a landmark are the largest
of its units; they are mapped by the inverse root of the landmarks' Gram matrix, beside the
largest of them, and a linear machine and a logistic curve on its margin give the score.
Each learnt text also counts, for half its weight, with some words spelt in other ways, so that
the machine sees how similar masked, spaced and stretched words are to landmarks.  Nothing but
the text enters a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import nsmallest
from math import ceil, exp, lgamma, log, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from tablewright.llm import string_kernel
from tablewright.llm.labelled import HELD_OUT_FOLD, SAMPLE_ROWS, labelled_sample
from tablewright.llm.string_kernel import Landmarks
from tablewright.llm.words import CARRIED, LOWER, WORD_BYTES, fold_number, give_back, uncarry
from tablewright.workspace import kept, materialize

#: Lengths of pieces of words; a whole word may be shorter or longer.
PIECE_LENGTHS = range(4, 11)
SHORTEST = 3
#: A candidate is this many times as frequent in toxic texts as in clean ones.
LEAST_RATIO = 8.0
#: Share of false discoveries among the words taken as typical of toxic texts.
FALSE_DISCOVERIES = 0.01
LONGEST_UNIT = 24
SHORT, RUN = 2, 3
#: Similarities one task remembers (4 bytes each).
REMEMBERED = 4_000_000
TEXTS_AT_ONCE = 200
REGULARISATION = 0.0001
FIT_TASKS = 4

KEPT_BYTES = set(LOWER) | {b for b in WORD_BYTES if b >= 0x80} | set(b" \t\n\r\x0b\x0c")
DROPPED = bytes(b for b in range(256) if b not in KEPT_BYTES)
#: Where a letter may be hidden: every sign within a word, these also at its ends.
HIDING = b"*#@$_%"
HIDDEN = bytes(b if b in KEPT_BYTES else string_kernel.MASK for b in range(256))
AT_ENDS = bytes(b for b in DROPPED if b not in HIDING)
SINGLE = {bytes([b]) for b in range(256)}


def units_of(text: str | None) -> set[bytes]:
    """Units of the whole text; long ones as overlapping stretches."""
    whole = (text or "").lower().encode()
    words = whole.translate(None, DROPPED).split()
    units = set(words)
    # A word that nothing was dropped from, as most are, hides no letter.
    signed = set(whole.split()) - units
    units -= SINGLE
    for w in signed:
        w = w.strip(AT_ENDS)
        if not w.isalpha():
            w = w.translate(HIDDEN)
            if string_kernel.MASK in w and len(w) >= 3 and w.count(string_kernel.MASK) < len(w) - 1:
                units.add(w)
    # Places of longer words: what lies between two of them is a run of short ones.
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.concatenate([[-1], np.flatnonzero(lengths > SHORT), [len(words)]])
    for i in np.flatnonzero(np.diff(ends) > RUN).tolist():
        units.add(b"".join(words[ends[i] + 1 : ends[i + 1]]))
    step = LONGEST_UNIT // 2
    if max(map(len, units), default=0) > LONGEST_UNIT:
        for w in [w for w in units if len(w) > LONGEST_UNIT]:
            units.discard(w)
            units.update(w[i : i + LONGEST_UNIT] for i in range(0, len(w) - step, step))
    return units


@dataclass
class ToxicityModel:
    landmarks: list[bytes]
    #: margin = similarities @ weights + bias; score = 1 / (1 + exp(-(slope * margin + shift)))
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            margin = np.zeros(len(x))
        else:
            margin = x @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500)))


class UnitMemory:
    """Similarities of units seen before in this task, so that each is computed once.

    A text's vector has its two similarities to each landmark and, last, the largest of each.
    """

    def __init__(self, landmarks: list[bytes]):
        self.landmarks = Landmarks(landmarks)
        self.most = max(1, REMEMBERED // max(1, 2 * len(landmarks)))
        self.forget()

    def forget(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.rows = np.zeros((0, 2 * len(self.landmarks.landmarks)), np.float32)

    def learn(self, units: set[bytes]) -> None:
        fresh = list(units - self.seen.keys())
        if len(self.seen) + len(fresh) > self.most:
            self.forget()
            fresh = list(units)
        start, end = len(self.seen), len(self.seen) + len(fresh)
        if end > len(self.rows):
            grown = np.zeros((max(end, min(end + end // 4, self.most)), self.rows.shape[1]), np.float32)
            grown[:start] = self.rows[:start]
            self.rows = grown
        self.rows[start:end] = self.landmarks.similarities(fresh)
        self.seen.update(zip(fresh, range(start, end)))

    def vectors(self, texts: pa.Array) -> np.ndarray:
        give_back()
        m = len(self.landmarks.landmarks)
        out = np.zeros((len(texts), 2 * m + 2))
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            units = [units_of(t.as_py()) for t in texts[at : at + TEXTS_AT_ONCE]]
            self.learn(set().union(*units))
            for i, own in enumerate(units, at):
                if own and m:
                    out[i, : 2 * m] = self.rows.take([*map(self.seen.__getitem__, own)], axis=0).max(axis=0)
        if m:
            out[:, -2] = out[:, :m].max(axis=1)
            out[:, -1] = out[:, m : 2 * m].max(axis=1)
        return out


def _scored(batches: Iterator[pa.Array], landmarks: list[bytes], result) -> Iterator[pa.Array]:
    """``result`` of the vectors of each batch.  The memory of units lasts for one task, so that
    worker processes that later stages reuse hold nothing of it."""
    memory = UnitMemory(landmarks)
    try:
        for texts in batches:
            yield result(memory.vectors(texts))
    finally:
        memory.forget()
        give_back()


def plain_units(text: str | None) -> tuple[list[bytes], int]:
    """Units without hidden letters, and a name made of the three least of their hashes: near copies
    mostly share it, other texts hardly ever do."""
    units = [u for u in units_of(text) if string_kernel.MASK not in u]
    least = nsmallest(3, (xxhash.xxh64_intdigest(u) for u in units))
    return units, xxhash.xxh64_intdigest(repr(least)) >> 1


@F.arrow_udf(LongType())
def _text_group(texts: pa.Array) -> pa.Array:
    return pa.array([plain_units(t)[1] for t in texts.to_pylist()], pa.int64())


def _word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): groups of near copies of each class with a text that has the unit."""

    def count(batches):
        for batch in batches:
            # Text by text: the units of a whole batch would be millions.
            for text, label in zip(batch.column("text"), batch.column("label")):
                units, group = plain_units(text.as_py())
                yield pa.RecordBatch.from_pydict(
                    {"word": units, "label": [bool(label.as_py())] * len(units), "text_group": [group] * len(units)},
                    pa.schema([("word", pa.binary()), ("label", pa.bool_()), ("text_group", pa.int64())]),
                )

    # Copies and near copies of one text say no more than the text itself.
    texts = sample.select("text", "label").distinct()
    counted = texts.mapInArrow(count, "word binary, label boolean, text_group long").distinct()
    return counted.groupBy("word").agg(
        F.count(F.when(F.col("label"), 1)).alias("toxic"), F.count(F.when(~F.col("label"), 1)).alias("clean")
    )


def pieces_of(word: bytes) -> set[bytes]:
    pieces = {word[i : i + n] for n in PIECE_LENGTHS for i in range(len(word) - n + 1)}
    return pieces | {word} if len(word) >= SHORTEST else pieces


def _piece_counts(words: DataFrame, pieces: set[bytes]) -> dict[bytes, tuple[int, int]]:
    shared = words.sparkSession.sparkContext.broadcast(pieces)

    def count(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for word, t, c in zip(*[batch.column(n).to_pylist() for n in ("word", "toxic", "clean")]):
                for p in pieces_of(word) & shared.value:
                    toxic[p] += t
                    clean[p] += c
        found = list(toxic | clean)
        yield pa.RecordBatch.from_pydict(
            {"piece": found, "toxic": [toxic[p] for p in found], "clean": [clean[p] for p in found]},
            pa.schema([("piece", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())]),
        )

    counted = words.mapInArrow(count, "piece binary, toxic long, clean long")
    rows = counted.groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return {bytes(r.piece): (r.toxic, r.clean) for r in rows.collect()}


def tail(toxic: int, clean: int, share: float) -> float:
    """Chance that at least ``toxic`` of the texts with a word are toxic, if ``share`` of all are."""
    n = toxic + clean
    logs = [
        lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(share) + (n - i) * log1p(-share)
        for i in range(toxic, n + 1)
    ]
    top = max(logs)
    return min(1.0, exp(top) * sum(exp(x - top) for x in logs))


def typical_counts(counts: list[tuple[int, int, int]], n_toxic: int, n_clean: int) -> set[tuple[int, int]]:
    """The (toxic, clean) counts of words that are significantly frequent in toxic texts, from
    (toxic, clean, words), with FALSE_DISCOVERIES false ones among them (Benjamini-Hochberg).

    Words in so few texts that none of them could be significant are not counted as tested.
    """
    share = n_toxic / (n_toxic + n_clean)
    fewest = max(2, ceil(log(FALSE_DISCOVERIES) / log(share)))
    tested = [(tail(t, c, share), t, c, n) for t, c, n in counts if t + c >= fewest]
    total, so_far, limit = sum(n for *_, n in tested), 0, 0.0
    for chance, _, _, n in sorted(tested):
        so_far += n
        if chance <= FALSE_DISCOVERIES * so_far / total:
            limit = chance
    return {(t, c) for chance, t, c, _ in tested if chance <= limit}


def choose_landmarks(sample: DataFrame) -> list[bytes]:
    """Pieces that cover the words typical of toxic texts, the largest cover first, until no
    such word is left that a piece typical of toxic texts could cover.

    Words and texts are counted over distinct groups of near copies.  What reaches the driver is the typical
    words, of a sample of bounded rows, and their pieces.
    """
    groups = sample.select("label", _text_group("text").alias("text_group")).distinct()
    n = {bool(r.label): r.n for r in groups.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    if not n_toxic or not n_clean:
        return []
    words = materialize(_word_counts(sample), "toxic-words")

    def ratio(toxic, clean):
        return ((toxic + 0.5) / (n_toxic + 1.0)) / ((clean + 0.5) / (n_clean + 1.0))

    counts = [(r.toxic, r.clean, r.n) for r in words.groupBy("toxic", "clean").agg(F.count("*").alias("n")).collect()]
    found = [(t, c) for t, c in typical_counts(counts, n_toxic, n_clean) if ratio(t, c) >= LEAST_RATIO]
    if not found:
        return []
    pairs = words.sparkSession.createDataFrame(found, "toxic long, clean long")
    top = words.join(F.broadcast(pairs), ["toxic", "clean"], "left_semi").collect()
    open_words = {bytes(r.word): r.toxic for r in top}
    pieces = {w: pieces_of(w) for w in open_words}
    counts = _piece_counts(words, set().union(*pieces.values()))
    fair = {p for p, (t, c) in counts.items() if ratio(t, c) >= LEAST_RATIO}
    # What a piece covers counts beyond LEAST_RATIO times what its clean texts let expect.
    gain = Counter({p: -LEAST_RATIO * counts[p][1] * n_toxic / max(1, n_clean) for p in fair})
    holders: dict[bytes, list[bytes]] = {}
    for w, t in open_words.items():
        for p in pieces[w] & fair:
            gain[p] += t
            holders.setdefault(p, []).append(w)
    chosen: list[bytes] = []
    while gain:
        best = max(gain, key=lambda p: (gain[p], len(p), p))
        del gain[best]
        covered = [w for w in holders[best] if w in open_words]
        if not covered:
            continue
        chosen.append(best)
        for w in covered:
            t = open_words.pop(w)
            for p in pieces[w] & gain.keys():
                gain[p] -= t
    return chosen


def respelt(word: str, way: int) -> str:
    """The word with hidden letters, letters apart, a letter put in at each place, or without vowels."""
    if way == 0:
        return "".join("*" if i % 2 and i < len(word) - 1 else x for i, x in enumerate(word))
    if way == 1:
        return " ".join(word)
    if way == 2:
        return "x".join(word)
    inner = "".join(x for x in word[1:-1] if x not in "aeiou")
    return word[:1] + inner + word[-1:]


def respelt_text(text: str | None, landmarks: list[bytes], toxic: bool) -> str | None:
    """The text with all words that hold a landmark, or in a clean text some words, respelt in
    a way that depends on the text; None if there are no such words."""
    words = (text or "").lower().split()
    way = crc32((text or "").encode())
    pieces = [x.decode("utf-8", "ignore") for x in landmarks]
    plain = [w.encode().translate(None, DROPPED).decode("utf-8", "ignore") for w in words]
    if toxic:
        chosen = {i for i, w in enumerate(plain) if any(p in w for p in pieces)}
    else:
        chosen = {i for i, w in enumerate(plain) if len(w) >= 4 and (i + way) % 16 == 0}
    if not chosen:
        return None
    return " ".join(respelt(plain[i], (way >> 8) % 4) if i in chosen else w for i, w in enumerate(words))


def _respelt_udf(shared):
    @F.arrow_udf("string")
    def other(texts: pa.Array, labels: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), labels.to_pylist())
        return pa.array([respelt_text(t, shared.value, bool(label)) for t, label in rows], pa.string())

    return other


def _vector_udf(shared, root):
    @F.arrow_udf("array<double>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _scored(batches, shared.value, lambda x: pa.array(list(x @ root.value.T), pa.list_(pa.float64())))

    return vectors


def fit_toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learns from at most ``bound`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, "toxic", bound)
    sample = materialize(sample.withColumn("label", F.least("label", F.lit(1)).cast("double")), "toxic-sample")
    seen = {r.label: r for r in sample.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    if len(seen) < 2:
        # One class or none: its own share, with a little doubt.
        share = 0.9999 if 1.0 in seen else 0.0001
        return ToxicityModel([], np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    landmarks = choose_landmarks(sample)
    if not landmarks:
        share = seen[1.0].w / (seen[1.0].w + seen[0.0].w)
        return ToxicityModel([], np.zeros(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    values, vectors = np.linalg.eigh(Landmarks(landmarks).gram())
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T

    shared = docs.sparkSession.sparkContext.broadcast(landmarks)
    # The second similarities and the largest ones pass through the map as they are.
    m = len(landmarks)
    whole = np.eye(2 * m + 2)
    whole[:m, :m] = root
    root = whole
    other = _respelt_udf(shared)("text", "label")
    doubled = materialize(sample.select("text", "label", "weight", other.alias("other")), "toxic-spellings")
    half = F.when(F.col("other").isNull(), 1.0).otherwise(0.5) * F.col("weight")
    spelt = doubled.select("text", "label", half.alias("weight")).unionByName(
        doubled.where(F.col("other").isNotNull()).select(F.col("other").alias("text"), "label", half.alias("weight"))
    )
    rows = spelt.withColumn("x", _vector_udf(shared, docs.sparkSession.sparkContext.broadcast(root))("text"))
    # A bounded sample: written by many tasks, then passed over by a few.
    rows = materialize(rows.select("label", "weight", "x"), "toxic-vectors").coalesce(FIT_TASKS)
    with kept(rows.select("label", "weight", array_to_vector("x").alias("v"))) as rows:
        machine = LinearSVC(
            featuresCol="v", labelCol="label", weightCol="weight", regParam=REGULARISATION, maxIter=100, standardization=False
        ).fit(rows)
        weights = root @ np.array(machine.coefficients)
        bias = float(machine.intercept)
        curve = LogisticRegression(featuresCol="m", labelCol="label", weightCol="weight", regParam=0.001).fit(
            machine.transform(rows).select("label", "weight", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("m"))
        )
    return ToxicityModel(landmarks, weights, bias, float(curve.coefficients[0]), float(curve.intercept))


def add_toxicity(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """``rows`` (text and anything else) plus score."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        yield from _scored(batches, model.landmarks, lambda x: pa.array(model.score(x), pa.float64()))

    return rows.withColumn("score", score("text"))


def score_toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text).

    Labels of fold 0 are not learnt from; a document with several labels counts as toxic if one
    says so.  A null or empty text has no units and gets the score of a text without any
    similarity.  Without labels of both classes every text gets the one class's share.
    Repeated rows get equal scores; other columns are not read.
    """
    model = fit_toxicity(docs, labels, bound)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return add_toxicity(rows, model).select(
        "doc_id",
        (fold_number() == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted to be toxic."""
    model = fit_toxicity(docs, labels, bound)
    rows = docs.select(F.struct("*").alias(CARRIED), F.col("text").cast("string").alias("text"))
    return uncarry(add_toxicity(rows, model).where(F.col("score") < 0.5))
