"""A corpus from raw documents to a mixed training set, as five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps; it is written
and read back before the next one begins.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickstrata.llm import decontamination, mixing, secrets, similarity, toxicity  # noqa: E402
from clickstrata.llm.common import table, workers_find_package  # noqa: E402
from clickstrata.llm.toxicity import toxicity_model  # noqa: E402
from clickstrata.sources.shared import written  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    workers_find_package(spark)
    return toxicity.drop_toxic(docs, toxicity_model(spark, sf_dir))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links of five-word shingles connect, the smallest id stays."""
    workers_find_package(spark)
    return similarity.keep_one(docs, shingle=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat ten words of a benchmark text go."""
    workers_find_package(spark)
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontamination.drop_contaminated(docs, benchmark)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    workers_find_package(spark)
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays and gets its place in the mixture of sources."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_similar),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("source_mixing", mix_sources),
]

#: A trained classifier is not expressible in SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents", "*")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
