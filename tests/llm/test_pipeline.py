from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tablewright.llm.decontaminate import decontaminate
from tablewright.llm.jaccard_join import join_similar
from tablewright.llm.site_quality import classify_by_site
from tablewright.llm.toxicity import score_toxicity
from tablewright.plans.views import table
from tests.llm.awkward import PASSAGE, ROWS, documents

STAGES = dict(corpus_pipeline.STAGES)


def _rows(df):
    return Counter(map(str, df.collect()))


def _judged(docs, verdicts):
    """The rows of ``docs`` whose id has no verdict against it; null ids are ids."""
    bad = verdicts.select(F.col("doc_id").alias("bad")).distinct()
    return _rows(docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad")), "left_anti"))


def test_quality_keeps_what_its_operator_keeps(spark, small):
    docs = documents(spark)
    got = classify_by_site(docs, table(spark, small, "labels"))
    # The rows of one id differ in nothing that is judged, or have one verdict.
    assert _rows(STAGES["quality"](spark, docs, small)) == _judged(docs, got.where("not kept"))


def test_toxicity_keeps_what_is_not_predicted(spark, small):
    docs = documents(spark, [*ROWS, (900, "you pathetic worthless idiot, shut up moron", "en", "a")])
    got = score_toxicity(docs, table(spark, small, "labels"))
    assert _rows(STAGES["toxicity"](spark, docs, small)) == _judged(docs, got.where("predicted = 1"))


def test_near_duplicates_keeps_one_row_a_class(spark, small):
    docs = documents(spark)
    kept = STAGES["near_duplicates"](spark, docs, small)
    classes = {r.class_id for r in join_similar(docs).collect()}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == classes and len(ids) == len(classes)
    assert not _rows(kept) - _rows(docs)


def test_decontamination_drops_what_is_contaminated(spark, small):
    item = table(spark, small, "benchmark").where("length(text) > 100").first().text
    docs = documents(spark, [*ROWS, (900, item, "en", "a"), (901, f"{item} {PASSAGE * 20}", "en", "a")])
    got = decontaminate(docs, table(spark, small, "benchmark"))
    kept = STAGES["decontamination"](spark, docs, small)
    assert _rows(kept) == _judged(docs, got.where("contaminated"))
    assert 900 not in {r.doc_id for r in kept.collect()}


def test_mixing_takes_words_only(spark, small):
    got = STAGES["mixing"](spark, documents(spark), small).collect()
    sizes = {r[0]: len((r[1] or "").split()) for r in ROWS}
    assert got and {r.doc_id for r in got} <= {i for i, n in sizes.items() if n}


def test_stages_keep_columns_and_only_drop_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        left = [r.doc_id for r in after.select("doc_id").collect()]
        assert after.columns == docs.columns and len(left) == len(set(left)) and set(left) <= ids


def test_stages_take_awkward_and_empty_tables(spark, small):
    for rows in ([], None):
        docs = documents(spark, rows) if rows is not None else documents(spark)
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, small).count() <= docs.count()


def test_run_gives_the_mix(spark, small):
    got = corpus_pipeline.run(spark, small).collect()
    assert got and all(0 < r.taken <= 2 * r.size for r in got)


def test_stages_hand_few_whole_texts_to_python_at_once(spark, small):
    key = corpus_pipeline.BATCH_KEY
    before = spark.conf.get(key)
    docs = table(spark, small, "documents")
    try:
        for set_to, want in [("10000", "1000"), ("0", "1000"), ("300", "300")]:
            for _, stage in corpus_pipeline.STAGES:
                spark.conf.set(key, set_to)
                stage(spark, docs.limit(0), small)
                assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)
