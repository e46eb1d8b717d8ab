"""Registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import sql
from tablewright.llm.decontaminate import decontaminate
from tablewright.llm.jaccard_join import join_similar
from tablewright.llm.katz import score_documents
from tablewright.llm.licence_scan import scan_licences
from tablewright.llm.near_vectors import near_vectors
from tablewright.llm.page_text import extract_text
from tablewright.llm.prefix_trie import prefix_trie
from tablewright.llm.quality_rules import apply_quality_rules
from tablewright.llm.site_quality import classify_by_site
from tablewright.llm.source_mix import mix_sources
from tablewright.llm.token_counts import count_tokens
from tablewright.llm.toxicity import score_toxicity
from tablewright.llm.turn_repair import damaged, repair_report
from tablewright.plans.views import table

VOCABULARY = "byte_bpe_50k.json"

QUERIES = {}
ORACLES = {}


def query(name: str, statement: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if statement is not None:
            ORACLES[name] = statement
        return fn

    return add


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_page_text")
def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query("op3_source_mix", sql.SOURCE_MIX)
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op4_jaccard_join")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(table(spark, sf_dir, "documents"))


@query("op5_licence_scan")
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).drop("matches")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query("op7_decontaminate", sql.DECONTAMINATE)
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@query("op8_site_quality")
def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_by_site(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_katz_scores")
def op10_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


@query("op11_near_vectors", sql.NEAR_VECTORS)
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op12_turn_repair")
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


@query("op13_prefix_trie", sql.PREFIX_TRIE)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))
