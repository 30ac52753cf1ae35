"""The training-data pipeline: ``documents`` through five stages, each one operator of ``ledgerspark.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet under the shared checkpoint folder and reads it back
as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm.exact_dedup import exact_unique
from ledgerspark.llm.langid import accepted
from ledgerspark.llm.mixing import mix_documents
from ledgerspark.llm.near_dedup import near_unique
from ledgerspark.llm.packing import pack
from ledgerspark.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    return accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_unique(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_unique(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each time a document is taken."""
    return mix_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Trained models, tokenizer ids and similarity classes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
