"""Cleaning and packing a text corpus: quality rules, toxicity, near duplicates, packing.

``STAGES`` lists the steps in order. Each takes ``(spark, docs, sf_dir)`` and
returns the documents that it keeps, with the columns of ``docs``; the last
returns the packed pieces. A stage learns from the documents that reached it
and the label tables in ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import ngram_join, packing, quality, toxicity
from ledgerlake.llm.common import read_table, scratch_path
from ledgerlake.llm.registry import word_vocabulary

#: Words that the encoder of a Python worker holds in the packing stage: the executors' JVMs have
#: grown by the stages before, and a worker keeps its table while it serves the next.
REMEMBERED = 100_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the learned decision list (operator 6)."""
    return quality.keep_good(docs, quality.learn_from(docs, read_table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier scores under one half (operator 10)."""
    return toxicity.clean_only(docs, toxicity.learn(docs, read_table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest id (operator 8)."""
    return ngram_join.one_of_each(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents' tokens and its place in a sequence (operator 1)."""
    return packing.packed(docs, word_vocabulary(), remembered=REMEMBERED)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

#: The learned stages can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``, each stage's result written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{i}")
            out.write.parquet(path)
            docs = spark.read.parquet(path)
    return out
