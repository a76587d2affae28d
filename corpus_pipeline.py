"""Corpus pipeline: stages over ``documents``, each stored as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annolake.llm import exact_dedup, mixing, ngram_jaccard, quality, sp_viterbi
from annolake.llm.common import stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact_dedup.without_duplicates(docs)


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return ngram_jaccard.one_of_each_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the budgets of their domain, language and source draw them."""
    return mixing.drawn_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as piece ids."""
    return sp_viterbi.encode(docs).drop("text")


STAGES = [("quality", good), ("exact_dedup", distinct), ("near_dedup", unlike), ("mixing", mixture), ("encoding", encoded)]
ORACLE_SQL = None  # SQL cannot express the trained classifier; the tests hold the stages against plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
