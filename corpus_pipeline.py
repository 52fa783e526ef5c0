"""Corpus pipeline over the documents table: each stage's rows are written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import quality, simhash, toxicity
from millrace.llm.common import saved
from millrace.llm.queries import packed


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep all quality rules stay."""
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.3 stay. The grammar is learned from the labels of the documents at hand."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grammar = toxicity.learn(docs, labels, toxicity.train_rows())
    return toxicity.keep_clean(docs, grammar, least=0.3)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs, words=3, radius=2)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packed(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("packing", packing_stage),
]
#: Learned scores, word-hash fingerprints and packing cannot be written in SQL; tests hold the rows of run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
