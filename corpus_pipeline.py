"""A training-text pipeline of five stages over ``documents``, each by one of the operators of
``slipflow.llm``. Every stage gets what the one before it kept, and all but the last return the
columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slipflow.llm import decontamination, line_dedup, near_dedup, quality_ftrl, sentencepieces
from slipflow.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score 0.3 or more)."""
    model = quality_ftrl.train(docs, table(spark, sf_dir, "labels"))
    return quality_ftrl.keep_quality(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dedup.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left, with their count and hash."""
    return sentencepieces.encode_documents(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontaminate), ("sentencepiece", encode)]

#: The trained classifier and the tokenizer are beyond SQL; tests/llm hold each stage to a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
