"""One query an operator, each over its whole table; SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadsight.llm import (dual_tree, embed_dedup, fixity, hilbert_ann, language_mix, license_scan, mixing, ngram_join,
                           packing, quality_fm, surrogates, url_cascade, whitening)
from roadsight.llm.common import table


def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit_pages(table(spark, sf_dir, "pages"))


def op2_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def op3_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_cascade.judge(pages, url_cascade.listed_hosts(pages))


def op4_hilbert_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op7_splitting_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def op8_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


def op9_heavy_light_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace(table(spark, sf_dir, "documents"))
    return replaced.select("doc_id", "text", F.coalesce(F.array_join("__kinds", ","), F.lit("")).alias("kinds"))


def op11_bidiagonal_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_dual_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_mix.identify(docs, language_mix.learn(docs)).drop("mixture")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_merkle_fixity, op2_factorisation_machine, op3_bloom_cascade, op4_hilbert_curves,
                            op5_sorted_projections, op6_best_fit_packing, op7_splitting_tree, op8_suffix_automaton,
                            op9_heavy_light_join, op10_surrogates, op11_bidiagonal_whitening,
                            op12_dual_tree_search, op13_language_mixture)}

SQL: dict[str, str] = {"op1_merkle_fixity": fixity.AUDIT_SQL, "op3_bloom_cascade": url_cascade.JUDGE_SQL,
                       "op5_sorted_projections": embed_dedup.DEDUP_SQL, "op9_heavy_light_join": ngram_join.JOIN_SQL,
                       "op12_dual_tree_search": dual_tree.SEARCH_SQL}
