"""A training-data pipeline over ``documents``: each stage works on all that the stage before kept.

1. Quality classifier: documents it rejects go.
2. Line dedup: lines found in ten documents or more are cut from all texts.
3. N-gram Jaccard join: of each group of near duplicates (five words, 0.8) the document with the smallest id stays.
4. Benchmark decontamination: documents that hold a benchmark item go.
5. Mixing: what is left is drawn to the sources' target weights; rows come once per copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import decontamination, jaccard_join, line_dedup, mixing, quality_classifier
from wattloom.llm.storage import importable, stored

#: Trees, embedding tests and components are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_good(docs, _table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return line_dedup.without_frequent_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard_join.one_of_each_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
