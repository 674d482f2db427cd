"""The corpus pipeline: documents to packed token sequences.

Each stage reads what the stage before it kept. All but the last return documents with their columns as they
came; the last returns the pieces of the token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfsense.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from shelfsense.sources.session import release_shuffles, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    release_shuffles(spark)
    return toxicity.not_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many hold; a document that loses all lines stays, empty."""
    release_shuffles(spark)
    return line_dedup.without_repeated_lines(docs).select(docs.columns)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of similar ones."""
    release_shuffles(spark)
    return jaccard.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    release_shuffles(spark)
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed token sequences."""
    release_shuffles(spark)
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_similar),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
ORACLE_SQL: str | None = None  # the toxicity stage is a trained model


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
