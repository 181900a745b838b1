"""Corpus pipeline: quality, near-duplicates, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadsight.llm import mixing, ngram_join, packing, quality_fm, surrogates
from roadsight.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine accepts."""
    return quality_fm.keep_good(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by shingle Jaccard."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities replaced by surrogates; ``n_chars`` follows the new text."""
    new = surrogates.replace(docs)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("__kinds").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return new.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mix_sources", mix_sources), ("pack", pack)]

#: Hash orders and trained weights are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
