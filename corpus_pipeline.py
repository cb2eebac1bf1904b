"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before it kept and returns the columns of ``documents``; the last
returns how many words of each document the mix takes. Results are written as Parquet between
stages. Null texts, empty tables and further columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stardw.llm import decontaminate, jaccard_join, mixing, quality_rules, suffix_dedup
from stardw.session import cut_lineage

# Word shingles of five words; documents with a similarity of 80 % or more are near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def distinct_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which every long passage stands once in the whole corpus."""
    return suffix_dedup.remove(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words to take of each document, so that its source comes to its target."""
    return mixing.mix_by_source(docs)


STAGES = [("quality rules", good_documents), ("n-gram Jaccard join", distinct_documents),
          ("suffix-array dedup", distinct_passages), ("benchmark decontamination", decontaminated),
          ("mixing to target weights", mixed)]

# The first stage asks a tokenizer and the last one a flow: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
