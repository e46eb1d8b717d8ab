"""Language-model scoring with a Katz back-off bigram model.

p(w | h) is the Good-Turing discounted share of w after h where the pair was seen in training,
and alpha(h) * p(w) where it was not; p(w) is the additive unigram distribution with one
unknown type, and alpha(h) is the exact weight that makes p(. | h) sum to one.

The model is never held in one place.  Tokens are kept in shards of bounded size; a shard asks
for the counts of its distinct words, and then of its distinct word pairs, by sending sorted
hashes to hash-range tables of words and of pairs by history.  A table's part adds up what all
shards send, and answers each shard with counts in the order asked, so that no key travels
back.  Histories with very many tokens are split by pair over all parts.  Everything in a part
or a shard is bounded; all exchanges carry packed arrays.
"""

from __future__ import annotations

import math
import uuid
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.words import LOWER_ASCII, fold_number, utf8
from tablewright.workspace import materialize, scratch_path

HELD_OUT_FOLD = 1
#: Counts up to this are discounted.
MOST_DISCOUNTED = 5
#: Tokens of a shard and, on average, of a part of the tables.
SHARD_TOKENS = 2_000_000
#: Words of all shards that a part of the word table has on average; shards hold far fewer
#: distinct words than tokens, so there are fewer parts of words than of pairs.
PART_WORDS = 500_000
#: Histories with more training tokens are split by pair; at most HOT_HISTORIES of them.
HOT_TOKENS, HOT_HISTORIES = 1_000_000, 10_000

# No word is empty or a blank, so these hashes stand for the end and the beginning.
END, BEGIN = xxhash.xxh64_intdigest(b""), xxhash.xxh64_intdigest(b" ")


def packed(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def tails(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash: enough to tell the words after one history apart."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from_tails(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


class _Shard:
    """Documents gathered until they have enough tokens."""

    def __init__(self):
        self.ids: dict[bytes, int] = {}
        self.stream = array("i")
        self.rows: list[tuple] = []

    def add(self, doc_id, train: bool, text: bytes) -> None:
        words = text.translate(LOWER_ASCII).split()
        ids = self.ids
        self.stream.extend([ids.setdefault(w, len(ids)) for w in words])
        self.rows.append((doc_id, train, len(words)))

    def batch(self, number: int, doc_type: pa.DataType) -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.ids), np.uint64, len(self.ids))
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        stream = place[np.frombuffer(self.stream, np.int32)] if len(self.stream) else np.zeros(0, np.int32)
        lengths = np.array([r[2] for r in self.rows], np.int64)
        train = np.array([r[1] for r in self.rows], bool)
        counts = np.bincount(stream, np.repeat(train, lengths), len(order)).astype(np.int64)
        shard = (TaskContext.get().partitionId() << 32) + number
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()),
                pa.array([[r[0] for r in self.rows]], pa.list_(doc_type)),
                pa.array([packed(lengths)], pa.binary()),
                pa.array([packed(train)], pa.binary()),
                pa.array([hashes[order].tobytes()], pa.binary()),
                pa.array([packed(counts)], pa.binary()),
                pa.array([packed(stream)], pa.binary()),
                pa.array([len(stream) + len(lengths)], pa.int64()),
                pa.array([int(train @ lengths)], pa.int64()),
                pa.array([int(train.sum())], pa.int64()),
            ],
            names=["shard", "doc_ids", "lengths", "train", "words", "counts", "stream", "tokens", "train_words", "train_docs"],
        )


def shard_documents(docs: DataFrame, shard_tokens: int) -> DataFrame:
    """Tokenised documents in shards, written once and bucketed by shard so that answers can
    be brought to them again and again without moving them."""
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), (fold_number() != HELD_OUT_FOLD).alias("train")
    )
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def gather(batches):
        shard, number = _Shard(), 0
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            columns = batch.column("doc_id").to_pylist(), batch.column("train").to_pylist(), utf8(batch.column("text"))
            for doc_id, train, text in zip(*columns):
                shard.add(doc_id, train, text)
                if len(shard.stream) >= shard_tokens:
                    yield shard.batch(number, kind)
                    shard, number = _Shard(), number + 1
        if shard.rows:
            yield shard.batch(number, kind)

    schema = (
        f"shard long, doc_ids array<{doc_type}>, lengths binary, train binary, words binary, counts binary, "
        "stream binary, tokens long, train_words long, train_docs long"
    )
    # Buckets need a table; its name is dropped at once, the files stay in the scratch folder.
    name = f"katz_shards_{uuid.uuid4().hex}"
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = rows.mapInArrow(gather, schema)
    shards.write.format("parquet").option("path", scratch_path(spark, name)).bucketBy(width, "shard").saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


def _range_edges(parts: int) -> np.ndarray:
    """Upper ends of equal ranges of 64-bit hashes."""
    return np.array([(2**64 * (i + 1)) // parts - 1 for i in range(parts)], np.uint64)


ANSWER = "kind string, shard long, part int, counts binary, histories binary, n long, v long, hot binary, extra binary"
ANSWERS = [c.split()[0] for c in ANSWER.split(", ")]


def _answers(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame([{c: r.get(c) for c in ANSWERS} for r in rows], columns=ANSWERS).astype(
        {"shard": "Int64", "part": "Int64", "n": "Int64", "v": "Int64"}
    )


def count_words(shards: DataFrame, parts: int, hot_tokens: int) -> DataFrame:
    """Answers to every shard with the training count of each of its words; and per part the
    training words, the distinct ones, and the hashes of hot words."""

    def ask(batches):
        edges = _range_edges(parts)
        for batch in batches:
            for shard, words, counts in zip(*[batch.column(c).to_pylist() for c in ("shard", "words", "counts")]):
                words, counts = np.frombuffer(words, np.uint64), unpacked(counts, np.int64)
                cuts = np.searchsorted(words, edges, side="right")
                # Only parts that the shard has words of.
                filled = [(i, slice(a, b)) for i, (a, b) in enumerate(zip([0, *cuts[:-1]], cuts)) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _ in filled], pa.int32()),
                        pa.array([shard] * len(filled), pa.int64()),
                        pa.array([words[s].tobytes() for _, s in filled], pa.binary()),
                        pa.array([packed(counts[s]) for _, s in filled], pa.binary()),
                    ],
                    names=["part", "shard", "words", "counts"],
                )

    def add_up(asked: pd.DataFrame) -> pd.DataFrame:
        words = [np.frombuffer(w, np.uint64) for w in asked["words"]]
        counts = [unpacked(c, np.int64) for c in asked["counts"]]
        distinct, place = np.unique(np.concatenate(words), return_inverse=True)
        # Sums of integers below 2^53 are exact in the doubles of bincount.
        totals = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        part, at, rows = int(asked["part"].iloc[0]), 0, []
        for shard, w in zip(asked["shard"], words):
            rows.append({"kind": "words", "shard": shard, "part": part, "counts": packed(totals[place[at : at + len(w)]])})
            at += len(w)
        known = totals > 0
        hot = distinct[totals >= hot_tokens].tobytes()
        rows.append({"kind": "word-sums", "shard": -1, "part": part, "n": int(totals.sum()), "v": int(known.sum()), "hot": hot})
        return _answers(rows)

    asked = shards.select("shard", "words", "counts").mapInArrow(ask, "part int, shard long, words binary, counts binary")
    return asked.groupBy("part").applyInPandas(add_up, ANSWER)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


class _Pairs:
    """Distinct (history, word) pairs of a shard, sorted by part, history and word; the same
    every time it is built from the same shard."""

    def __init__(self, shard: pd.Series, parts: int, hot: np.ndarray):
        self.lengths = unpacked(shard["lengths"], np.int64)
        self.train = unpacked(shard["train"], bool)
        stream = unpacked(shard["stream"], np.int32)
        hashes = np.concatenate([np.frombuffer(shard["words"], np.uint64), np.array([END, BEGIN], np.uint64)])
        end = len(hashes) - 2
        n = len(stream) + len(self.lengths)
        word = np.full(n, end, np.int64)
        is_word = np.ones(n, bool)
        is_word[np.cumsum(self.lengths + 1) - 1] = False
        word[is_word] = stream
        history = np.empty(n, np.int64)
        history[:1] = end + 1
        history[1:] = np.where(word[:-1] == end, end + 1, word[:-1])
        keys, self.pair_of = np.unique(history * len(hashes) + word, return_inverse=True)
        trained = np.repeat(self.train, self.lengths + 1)
        self.n = np.bincount(self.pair_of, trained, len(keys)).astype(np.int64)
        self.history, self.word = np.divmod(keys, len(hashes))
        h, w = hashes[self.history], hashes[self.word]
        part = _mixed(h)
        is_hot = np.isin(h, hot)
        part[is_hot] = _mixed(part[is_hot] ^ w[is_hot])
        self.part = ((part >> np.uint64(16)) % np.uint64(parts)).astype(np.int64)
        # Words are numbered in the order of their hashes, all but the two marks.
        self.order = np.lexsort((w, h, self.part))
        self.h, self.w = h[self.order], w[self.order]
        self.cuts = np.searchsorted(self.part[self.order], np.arange(parts + 1))
        new = np.ones(len(keys), bool)
        new[1:] = (self.h[1:] != self.h[:-1]) | (np.diff(self.part[self.order]) != 0)
        #: Number of the (part, history) run of each sorted pair.
        self.run = np.cumsum(new) - 1
        self.run_start = np.flatnonzero(new)


def _word_counts(answers: pd.DataFrame, train_docs: int) -> np.ndarray:
    """Training counts by word number; at the end those of the end and beginning marks."""
    own = answers[answers["kind"] == "words"].sort_values("part")
    counts = [unpacked(c, np.int64) for c in own["counts"]]
    return np.concatenate([*counts, np.array([train_docs, train_docs], np.int64)])


def count_pairs(shards: DataFrame, words: DataFrame, parts: int, hot: np.ndarray, train_docs: int) -> DataFrame:
    """Answers to every shard with the training count of each of its pairs and, for each of its
    histories, what the back-off weight needs: pairs seen 1 to MOST_DISCOUNTED times, tokens of
    pairs seen more often, and twice the unigram mass of all seen words (2c + 1 each)."""
    r_max = MOST_DISCOUNTED

    def ask(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, shard in own.iterrows():
            pairs = _Pairs(shard, parts, hot)
            counts = _word_counts(answers[answers["shard"] == shard["shard"]], train_docs)[pairs.word[pairs.order]]
            n = pairs.n[pairs.order]
            # The count of a word only matters where the pair was seen in training.
            counts[n == 0] = 0
            for part in range(parts):
                a, b = pairs.cuts[part], pairs.cuts[part + 1]
                if a == b:
                    continue
                starts = pairs.run_start[np.searchsorted(pairs.run_start, a) : np.searchsorted(pairs.run_start, b)]
                runs = np.diff(np.append(starts, b))
                rows.append(
                    (part, shard["shard"], pairs.h[starts].tobytes(), packed(runs), tails(pairs.w[a:b]), packed(n[a:b]), packed(counts[a:b]))
                )
        return pd.DataFrame(rows, columns=["part", "shard", "h", "runs", "w", "n", "c"])

    def add_up(asked: pd.DataFrame) -> pd.DataFrame:
        own_h = [np.frombuffer(h, np.uint64) for h in asked["h"]]
        h = np.concatenate([np.repeat(x, unpacked(r, np.int64)) for x, r in zip(own_h, asked["runs"])])
        w = np.concatenate([from_tails(x) for x in asked["w"]])
        sizes = [len(x) // 6 for x in asked["w"]]
        order = np.lexsort((w, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (w[order][1:] != w[order][:-1])
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(new) - 1
        seen = np.bincount(pair, np.concatenate([unpacked(x, np.int64) for x in asked["n"]])).astype(np.int64)
        word_count = np.maximum.reduceat(np.concatenate([unpacked(x, np.int64) for x in asked["c"]])[order], np.flatnonzero(new))
        histories, of = np.unique(h[order[new]], return_inverse=True)
        facts = np.zeros((len(histories), r_max + 2), np.int64)
        for r in range(1, r_max + 1):
            facts[:, r - 1] = np.bincount(of, seen == r, len(histories))
        facts[:, r_max] = np.bincount(of, np.where(seen > r_max, seen, 0), len(histories))
        np.add.at(facts[:, r_max + 1], of, np.where(seen > 0, 2 * word_count + 1, 0))
        part, at, rows = int(asked["part"].iloc[0]), 0, []
        for shard, x, size in zip(asked["shard"], own_h, sizes):
            known = facts[np.searchsorted(histories, x)]
            rows.append(
                {"kind": "pairs", "shard": shard, "part": part, "counts": packed(seen[pair[at : at + size]]), "histories": packed(known)}
            )
            at += size
        is_hot = np.isin(histories, hot)
        times = np.bincount(np.minimum(seen, r_max + 2), minlength=r_max + 3)[: r_max + 2]
        rows.append(
            {"kind": "pair-sums", "shard": -1, "part": part, "hot": histories[is_hot].tobytes(), "extra": facts[is_hot].tobytes(), "histories": times.astype(np.int64).tobytes()}
        )
        return _answers(rows)

    asked = (
        shards.groupBy("shard")
        .cogroup(words.groupBy("shard"))
        .applyInPandas(ask, "part int, shard long, h binary, runs binary, w binary, n binary, c binary")
    )
    return asked.groupBy("part").applyInPandas(add_up, ANSWER)


def discounts(times: np.ndarray) -> np.ndarray:
    """Good-Turing discount of each count up to MOST_DISCOUNTED from the numbers of pairs seen
    0, 1, 2 ... times; where these give none between 0 and 1, half a count is taken off."""
    k = MOST_DISCOUNTED
    out = np.ones(k + 1)
    tail = (k + 1) * times[k + 1] / times[1] if times[1] else 1.0
    for r in range(1, k + 1):
        d = 0.0
        if times[r] and tail < 1:
            d = ((r + 1) * times[r + 1] / (r * times[r]) - tail) / (1 - tail)
        out[r] = d if 0 < d < 1 else 1 - 0.5 / r
    return out


def score_shards(shards: DataFrame, answers: DataFrame, parts: int, hot: np.ndarray, model: dict, doc_type: str) -> DataFrame:
    shared = shards.sparkSession.sparkContext.broadcast(model | {"hot": hot})

    def score(own: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        r_max, d = MOST_DISCOUNTED, m["discounts"]
        tables = []
        for _, shard in own.iterrows():
            got = answered[answered["shard"] == shard["shard"]]
            pairs = _Pairs(shard, parts, m["hot"])
            count = _word_counts(got, m["train_docs"])
            unigram = np.log10((count + 0.5) / m["mass"])
            got = got[got["kind"] == "pairs"].sort_values("part")
            seen = np.concatenate([unpacked(x, np.int64) for x in got["counts"]])
            facts = np.concatenate([unpacked(x, np.int64).reshape(-1, r_max + 2) for x in got["histories"]])
            for i in np.flatnonzero(np.isin(pairs.h[pairs.run_start], m["hot"])):
                facts[i] = m["hot_facts"][int(pairs.h[pairs.run_start[i]])]
            h, w = pairs.history[pairs.order], pairs.word[pairs.order]
            # By run of a history: its tokens, the seen mass after discounting, the rest.
            tokens = count[h[pairs.run_start]].astype(np.float64)
            known = np.maximum(tokens, 1.0)
            discounted = facts[:, :r_max] @ (d[1:] * np.arange(1, r_max + 1)) + facts[:, r_max]
            mass = discounted / known
            rest = np.maximum(1 - mass, 0.5 / (known + 0.5))
            with np.errstate(divide="ignore", invalid="ignore"):
                scale = (1 - rest) / mass
                alpha = np.log10(rest / (1 - facts[:, r_max + 1] / 2 / m["mass"]))
                off = np.where(seen > r_max, 1.0, d[np.minimum(seen, r_max)])
                direct = np.log10(scale[pairs.run] * off * seen / known[pairs.run])
            backed = np.where(tokens > 0, alpha, 0.0)[pairs.run] + unigram[w]
            by_sorted = np.where(seen > 0, direct, backed)
            by_pair = np.empty(len(by_sorted))
            by_pair[pairs.order] = by_sorted
            doc = np.repeat(np.arange(len(pairs.lengths)), pairs.lengths + 1)
            word = pairs.word[pairs.pair_of]
            n = len(pairs.lengths)
            tables.append(
                pd.DataFrame(
                    {
                        "doc_id": pd.Series(list(shard["doc_ids"]), dtype="object"),
                        "held_out": ~pairs.train,
                        "n_tokens": pairs.lengths + 1,
                        "n_known": np.bincount(doc, count[word] > 0, n).astype(np.int64),
                        "train_tokens": np.full(n, m["n"], np.int64),
                        "base_score": np.bincount(doc, unigram[word], n),
                        "score": np.bincount(doc, by_pair[pairs.pair_of], n),
                    }
                )
            )
        return pd.concat(tables) if tables else pd.DataFrame(columns=RESULT)

    schema = f"doc_id {doc_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return shards.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(score, schema)


RESULT = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def score_documents(docs: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Tokens are lower-cased plain words and one end per text; a null or empty text has the end
    alone.  Rows of fold 1 are scored but not learnt from.  Repeated rows count and are scored
    each for itself.  Unknown words share the probability of one unseen type.  Without training
    rows every token is unknown.  Other columns are not read.
    """
    shards = shard_documents(docs, shard_tokens)
    sums = shards.agg(
        F.sum("tokens").alias("t"),
        F.sum("train_words").alias("w"),
        F.sum("train_docs").alias("d"),
        (F.sum(F.length("words")) / 8).alias("shard_words"),
    ).first()
    train_docs = int(sums.d or 0)
    n = int(sums.w or 0) + train_docs
    parts = max(1, math.ceil((sums.t or 0) / shard_tokens))
    hot_tokens = max(HOT_TOKENS, n // HOT_HISTORIES)
    word_parts = max(1, math.ceil((sums.shard_words or 0) / min(PART_WORDS, shard_tokens)))
    words = materialize(count_words(shards, word_parts, hot_tokens), "katz-words")
    word_sums = words.where("kind = 'word-sums'").select("v", "hot").collect()
    v = sum(r.v for r in word_sums) + (1 if train_docs else 0)
    hot = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(r.hot, np.uint64) for r in word_sums]])
    if train_docs >= hot_tokens:
        hot = np.append(hot, np.uint64(BEGIN))
    words = words.where("kind = 'words'")
    pairs = materialize(count_pairs(shards, words, parts, hot, train_docs), "katz-pairs")
    times = np.zeros(MOST_DISCOUNTED + 2, np.int64)
    hot_facts: dict[int, np.ndarray] = {}
    # A row for each part: numbers of pairs by count, and sums for the hot histories.
    for r in pairs.where("kind = 'pair-sums'").select("histories", "hot", "extra").toLocalIterator():
        times += np.frombuffer(r.histories, np.int64)
        facts = np.frombuffer(r.extra, np.int64).reshape(-1, MOST_DISCOUNTED + 2)
        for h, f in zip(np.frombuffer(r.hot, np.uint64), facts):
            hot_facts[int(h)] = hot_facts.get(int(h), 0) + f
    model = {
        "n": n, "mass": n + 0.5 * (v + 1), "train_docs": train_docs, "discounts": discounts(times), "hot_facts": hot_facts,
    }
    answers = words.unionByName(pairs.where("kind = 'pairs'"))
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return score_shards(shards, answers, parts, hot, model, doc_type)
