"""Bounded, documented samples of labelled texts for training the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder, texts


def training_rows(docs: DataFrame, labels: DataFrame, target: str, most: int,
                  fold: tuple[int, int] | None = (5, 0)) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents.

    ``target`` is the 0/1 column of ``labels``; null labels are left out and the larger one counts
    where an id repeats. With ``fold`` = (modulus, remainder), rows whose crc32(doc_id as text)
    has that remainder are held out. The sample takes the smallest hashes of the ids, so it does
    not depend on the order of rows; a repeated doc_id of ``docs`` counts with each of its texts.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col(target).cast("int").alias("label"))
             .filter("doc_id IS NOT NULL AND label IS NOT NULL"))
    if fold:
        known = known.filter(remainder("doc_id", fold[0]) != fold[1])
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # at most ``most`` rows of two numbers: a proven bound
    return texts(docs).join(F.broadcast(chosen), "doc_id")
