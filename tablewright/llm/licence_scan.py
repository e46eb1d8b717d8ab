"""Licence scan through a positional index of rare licence words, in DataFrame functions only.

The index holds, for every licence template, the words of its mandatory phrase that are
rarest in the scanned corpus, with their positions in the template.  A file is looked up by
the indexed words it contains; each hit proposes a start of the template, the postings are
intersected by that start, so that only starts on which two words agree remain, and one stands
if the mandatory phrase stands where the start puts it and the file holds half of the
template's inverse document frequency in place; that share is the score.  Since every match
holds its mandatory phrase, and so all indexed words of it, no match can be missed, and no row
leaves its partition: only the word frequencies are aggregated.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The phrases and labels that are always reported.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of public licences as (label, template, mandatory phrase in it).
TEMPLATES = (
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "distribute this software for any purpose"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("public-domain", "released into the public domain", "released into the public domain"),
    ("public-domain", "dedicated to the public domain", "dedicated to the public domain"),
    ("public-domain", "placed in the public domain", "placed in the public domain"),
)

#: Everything between folded words, with A-Z already lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
INDEXED_PER_TEMPLATE = 3
#: Indexed words of a file that must propose the same start, and the share of a template's weight
#: that must be in place.
AGREEING = 2
LEAST_SHARE = 0.5


def words_of(text: Column) -> Column:
    """Folded words.  ``lower`` also changes letters beyond ASCII, which are word characters
    before and after and occur in no phrase; only the Kelvin sign would become an ASCII letter
    and is kept apart."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e6"))
    return F.array_remove(F.split(F.lower(plain), GAP), "")


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _doubles(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def inverse_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """ln((rows + 1) / (rows with the word + 1)) for the words of the templates."""
    found = words.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    counts = {r.word: r.n for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    rows = words.count()
    return {w: math.log((rows + 1) / (counts.get(w, 0) + 1)) for w in vocabulary}


def _starts_of(phrase: list[str], words: list[str]) -> int:
    return next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)


def scan_licences(
    docs: DataFrame, templates=TEMPLATES, base_phrases=BASE_PHRASES, indexed: int = INDEXED_PER_TEMPLATE
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are not read).

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and
    matches (label, start, share) of the templates.  A null or empty text has no words, no
    labels, null places and score 0.  Repeated rows are scanned each for itself; labels that
    several phrases give appear once.  A base phrase without a template scores 0.5.
    """
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    idf = inverse_frequencies(words, vocabulary)

    texts = [t.split() for _, t, _ in templates]
    keys = [k.split() for _, _, k in templates]
    key_at = [_starts_of(k, t) for k, t in zip(keys, texts)]
    postings: dict[str, list[tuple[int, int]]] = {}
    for i, (key, at) in enumerate(zip(keys, key_at)):
        rarest = sorted(range(len(key)), key=lambda j: (-idf[key[j]], j))[:indexed]
        for j in rarest:
            postings.setdefault(key[j], []).append((i, at + j))
    index = F.create_map(
        *[
            c
            for word, places in postings.items()
            for c in (
                F.lit(word),
                F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in places]),
            )
        ]
    )
    template_words = F.array(*[_strings(t) for t in texts])
    # The least weight keeps the share defined for words that every row holds.
    weights = [[max(idf[w], 1e-6) for w in t] for t in texts]
    template_weights = F.array(*[_doubles(w) for w in weights])
    key_words = F.array(*[_strings(k) for k in keys])
    key_starts = F.array(*[F.lit(k) for k in key_at])
    labels = _strings([label for label, _, _ in templates])
    wholes = _doubles([sum(w) for w in weights])

    def proposals(ws: Column) -> Column:
        placed = F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
        hits = F.filter(placed, lambda h: F.array_contains(_strings(postings), h["w"]))
        starts = F.transform(
            hits,
            lambda h: F.transform(
                index[h["w"]], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("s"))
            ),
        )
        # Equal proposals are neighbours after sorting, so each that has an equal one is agreed on.
        ordered = F.sort_array(F.flatten(starts))
        # Beside the list moved along, as a lambda that names the list would sort it for each element.
        ahead = F.slice(ordered, AGREEING, 1 << 30)
        agreed = F.zip_with(ordered, ahead, lambda p, q: F.when(p == q, p))
        return F.array_distinct(F.array_compact(agreed))

    def stands(ws: Column, p: Column) -> Column:
        key = F.get(key_words, p["t"])
        at = p["s"] + F.get(key_starts, p["t"])
        # at + 1 is the place for slice, which takes no 0; a start before the text cannot stand.
        return (at >= 0) & (F.slice(ws, F.greatest(at, F.lit(0)) + 1, F.size(key)) == key)

    def share(ws: Column, p: Column) -> Column:
        held = F.aggregate(
            F.zip_with(
                F.transform(F.get(template_words, p["t"]), lambda w, j: F.get(ws, p["s"] + j) == w),
                F.get(template_weights, p["t"]),
                lambda same, weight: F.when(same, weight).otherwise(0.0),
            ),
            F.lit(0.0),
            lambda acc, x: acc + x,
        )
        return F.least(F.lit(1.0), held / F.get(wholes, p["t"]))

    ws = F.col("words")
    candidates = F.when(F.arrays_overlap(ws, _strings(postings)), F.filter(proposals(ws), lambda p: stands(ws, p)))
    placed = F.transform(
        "proposed",
        lambda p: F.struct(F.get(labels, p["t"]).alias("label"), p["s"].alias("start"), share(ws, p).alias("share")),
    )
    matches = F.filter(placed, lambda m: m["share"] >= LEAST_SHARE)
    found = words.withColumn("proposed", candidates).withColumn("matches", F.coalesce(matches, F.expr("array()")))

    # Base phrases: the words stand between single blanks; every start keeps its closing blank.
    firsts = _strings(sorted({phrase.split()[0] for phrase, _ in base_phrases}))
    line = F.when(F.arrays_overlap(ws, firsts), F.concat(F.lit(" "), F.array_join(ws, " "), F.lit(" ")))
    lined = found.withColumn("line", line)
    places = F.array(*[F.regexp_count("line", F.lit(f" {p}(?= )")) for p, _ in base_phrases])
    counted = lined.withColumn("places", F.when(F.col("line").isNotNull(), places))
    blanks = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    n_words = F.size(ws).cast("bigint")
    firsts_at, lasts_at, names = [], [], []
    for i, (phrase, label) in enumerate(base_phrases):
        present = F.get("places", F.lit(i)) > 0
        mark = f" {phrase} "
        # The text before the first place starts with a blank and separates its words by one.
        firsts_at.append(F.when(present, blanks(F.concat(F.substring_index("line", mark, 1), F.lit(" "))) - 1))
        after = blanks(F.substring_index("line", mark, -1))
        lasts_at.append(F.when(present, n_words - after - len(phrase.split())))
        names.append(F.when(present, F.lit(label)))
    base = F.array_sort(F.array_distinct(F.array_compact(F.array(*names))))
    method = F.transform("matches", lambda m: m["label"])
    n_base = F.coalesce(F.aggregate("places", F.lit(0), lambda a, x: a + x), F.lit(0))
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0))
    return counted.select(
        "doc_id",
        n_words.alias("n_words"),
        n_base.cast("bigint").alias("n_base"),
        F.least(*firsts_at).cast("bigint").alias("first_word"),
        F.greatest(*lasts_at).cast("bigint").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, method))), ",").alias("labels"),
        F.greatest(best, F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"),
        "matches",
    )
