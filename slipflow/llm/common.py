"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

MASK64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back with its schema:
    cuts the lineage, so a lost executor repeats only the last step."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_with(df: DataFrame, label: str, *measures: Column) -> tuple[DataFrame, dict]:
    """``staged``, and aggregates of its rows that are taken while they are written."""
    seen = Observation()
    out = staged(df.observe(seen, *measures), label)
    return out, seen.get


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), null texts as empty. Other columns of ``docs``, whatever their
    names, do not reach the operators."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def free_names(docs: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, with underscores behind those that ``docs`` has already (Spark does
    not tell names apart by case)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % modulus


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 (wraps)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class Words(defaultdict):
    """Word (bytes) -> small id, given out on first sight; ``words`` lists them by id. One instance
    serves one Arrow batch, so it holds no more words than the batch."""

    def __init__(self):
        super().__init__(count().__next__)
        self._words: list[bytes] = []

    @property
    def words(self) -> list[bytes]:
        if len(self._words) < len(self):
            self._words = list(self)
        return self._words

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))


def crcs(words: list[bytes]) -> np.ndarray:
    """crc32 per word, as uint64."""
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


_SHAPE = bytes(88 if 65 <= b <= 90 else 57 if 48 <= b <= 57 else 120 if 97 <= b <= 122 or b >= 128
               else b for b in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """Word shape: X capital, x other letter, 9 digit, symbols as they are; runs as one."""
    return _RUNS.sub(rb"\1", word.translate(_SHAPE))


def packed(batch: pd.DataFrame, lower: bool = True) -> tuple[Words, np.ndarray, np.ndarray]:
    """(words, ids, ends) of a batch of whole texts: ``ids`` holds all word ids one text after
    the other and ``ends[i]`` is where text i ends. Words are what stands between ASCII blanks;
    A-Z are lower-cased if asked for."""
    words, parts, ends, at = Words(), [], np.zeros(len(batch), np.int64), 0
    for i, text in enumerate(batch["text"]):
        raw = text.encode()
        ids = words.ids((raw.lower() if lower else raw).split())
        parts.append(ids)
        at += len(ids)
        ends[i] = at
    return words, np.concatenate(parts) if parts else np.zeros(0, np.int32), ends


def pieces(batches: Iterator[pd.DataFrame], most: int = 8_000_000, size: str | None = None) -> Iterator[pd.DataFrame]:
    """The batches cut into runs of whole texts of about ``most`` characters, so that memory
    follows the longest text and not the rows of a batch. ``size`` names a column of characters,
    where the text itself is not there."""
    for batch in batches:
        chars = batch[size] if size else batch["text"].str.len()
        group = np.cumsum(chars.to_numpy(np.int64, na_value=0)) // most
        for _, run in batch.groupby(group, sort=False):
            yield run


def arrow_pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same for Arrow batches, by the bytes of their ``text``; nothing is copied."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0)
        group = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64) // most
        edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else []
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def sums_between(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of values[starts[i]:ends[i]] for each i (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, np.float64)
    np.cumsum(values, out=total[1:])
    return total[ends] - total[starts]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
