"""A corpus pipeline: toxicity, near-duplicates, repeated passages, benchmark leaks, pieces.

Each stage is one operator of ``linewright.llm``. It takes (spark, docs, sf_dir), works on all
rows its predecessor kept, and is written as Parquet in the shared folder before the next one
reads it. All stages but the last return the columns of ``documents``:

toxicity         documents whose score reaches 0.5 go; the model is trained on labelled rows
                 of ``docs`` (a bounded sample, see linewright.llm.toxicity)
near_duplicates  of each group of near copies the row of the least doc_id stays
substrings       words of passages that also start earlier are cut out; a document that loses
                 all words goes, a text that loses none stays as it is
benchmark        documents that hold a window of a benchmark item go
pieces           the rest as SentencePiece ids with merge-dropout

Nulls, empty texts, repeated rows and empty tables have the results that the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linewright.llm import decontaminate, pieces, simhash, substring, toxicity
from linewright.llm.common import settle, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.dedup(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("benchmark", benchmark_stage),
    ("pieces", piece_stage),
]

#: Trained scores, hash fingerprints and pieces cannot be stated in SQL; tests/llm compares the
#: stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
