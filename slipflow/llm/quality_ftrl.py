"""Quality classifier: logistic regression over hashed word n-grams, trained by
follow-the-regularised-leader (FTRL-Proximal) updates and scored as sparse dot products.

Features of a text: its words, its word pairs, the shapes of its words (capitals, letters,
digits, symbols) and of its word pairs, and a mark for a word that repeats the one before it, all
hashed into ``2 ** BITS`` slots. A slot's value is its share of the text's words times ``SCALE``,
so a dot product is a mean of gathered weights and needs no sorting.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_pieces, crcs, mix64, packed, pieces, remainder, shape, sigmoid, sums_between, table, texts
from .labelled import training_rows

BITS = 18
SCALE = 8.0
RUN = 2_000_000  # text whose features are held at once (one longer text is a run)


def streams(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(slots, starts, ends) for each kind of feature: slots[starts[i]:ends[i]] are text i's."""
    words, ids, ends = packed(batch, lower=False)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    top = np.uint64(64 - BITS)
    word = crcs([w.lower() for w in words.words])
    form = np.fromiter((zlib.crc32(shape(w)) for w in words.words), np.uint64, len(words.words))
    same = np.append(ids[1:] == ids[:-1], False)
    yield (mix64(word) >> top).astype(np.int32)[ids], starts, ends
    yield (mix64(form + np.uint64(1 << 40)) >> top).astype(np.int32)[ids], starts, ends
    # pairs never cross texts; there is one pair less than words
    first = np.minimum(starts, max(len(ids) - 1, 0))
    last = np.maximum(np.minimum(ends - 1, len(ids) - 1), first)
    for values, salt in ((word, 2 << 40), (form, 3 << 40)):
        v = values[ids]
        with np.errstate(over="ignore"):
            pair = v[:-1] * np.uint64(0x9E3779B1) + v[1:] * np.uint64(0x85EBCA77) + np.uint64(salt)
        yield (mix64(pair) >> top).astype(np.int32), first, last
    yield same.astype(np.int32), first, last  # slots 0 and 1: a word again, or another


def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sparse vector (slots, values; as bytes, which the driver holds ten times smaller than rows
    of numbers) of each training text."""
    for run in pieces(batches, RUN):
        out = [[] for _ in range(len(run))]
        for slots, starts, ends in streams(run):
            for i in range(len(run)):
                out[i].append(slots[starts[i]:ends[i]])
        rows = []
        for i, parts in enumerate(out):
            slots, counts = np.unique(np.concatenate(parts), return_counts=True)
            rows.append((slots.astype(np.int32), (counts * (SCALE / max(1, len(parts[0])))).astype(np.float32)))
        yield pd.DataFrame({"label": run["label"].to_numpy(np.int32), "order": run["doc_id"].to_numpy(np.int64),
                            "slots": [r[0].tobytes() for r in rows], "vals": [r[1].tobytes() for r in rows]})


def ftrl(rows: list[tuple[float, np.ndarray, np.ndarray]], size: int, alpha: float = 0.3,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, passes: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-Proximal: per coordinate, z gathers gradients less the proximal
    correction and n their squares; the weight follows from both in closed form."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias

    def weight(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(passes):
        for y, slots, vals in rows:
            i, x = np.append(slots, size), np.append(vals, 1.0)
            w = weight(i)
            g = (sigmoid(w @ x) - y) * x
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - s * w
            n[i] += g * g
    w = weight(np.arange(size + 1))
    return w[:size].astype(np.float32), float(w[size])


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", most: int = 6000,
          fold: tuple[int, int] | None = (5, 0)) -> tuple[np.ndarray, float]:
    """FTRL model from at most ``most`` labelled documents (the documented bound of the sample;
    their sparse vectors are the only rows the driver gets). No labels: an all-zero model."""
    sample = (training_rows(docs, labels, target, most, fold)
              .mapInPandas(vectors, "label int, order long, slots binary, vals binary")
              .orderBy(F.xxhash64("order"), "order", F.hash("slots")).collect())
    rows = [(float(r.label), np.frombuffer(bytes(r.slots), np.int32), np.frombuffer(bytes(r.vals), np.float32))
            for r in sample]
    return ftrl(rows, 1 << BITS)


def scorer(model):
    """Function for mapInPandas: (doc_id, text) to (doc_id, score)."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias = model.value
        for run in pieces(batches, RUN):
            total, n = np.zeros(len(run)), None
            for slots, starts, ends in streams(run):
                n = ends - starts if n is None else n
                total += sums_between(weights[slots], starts, ends)
            yield pd.DataFrame({"doc_id": run["doc_id"],
                                "score": sigmoid(bias + SCALE * total / np.maximum(n, 1))})
    return score


def quality_scores(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score) of every row; score is the probability of label 1.

    Null and empty texts get the bias's score; words are never cut and texts are read whole.
    Repeated rows get the same score; an empty table gives an empty result; other columns of
    ``docs`` are ignored. A null doc_id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS floats
    return texts(docs).mapInPandas(scorer(shared), "doc_id long, score double")


def keep_quality(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns as they are, whose text scores at least
    ``threshold``; the same cases as ``quality_scores``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in arrow_pieces(batches, RUN):
            column = batch.schema.get_field_index("text")
            frame = pd.DataFrame({"doc_id": np.arange(batch.num_rows),
                                  "text": [t or "" for t in batch.column(column).to_pylist()]})
            scored = pd.concat([pd.DataFrame({"doc_id": [], "score": []}), *scorer(shared)(iter([frame]))])
            good = np.zeros(batch.num_rows, bool)
            good[scored["doc_id"].to_numpy(np.int64)] = scored["score"].to_numpy(float) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)


def op8_quality_ftrl(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scores = quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
