"""Phrases of two to five words that occur together far more often than their parts, by prefix-free
parsing.

A text is a stream of words with a break wherever a piece ends. A window of ``WINDOW`` tokens whose
hash ``MODULUS`` divides is a trigger. Triggers cut the stream into chunks that overlap by one window:
a chunk begins with a trigger and ends with the next one, so where texts repeat, their chunks are
the same whatever stands around them, and no chunk begins another. The distinct chunks with the
number of their parses are the dictionary, and phrases are counted in it, weighted. A phrase of at
most ``WINDOW`` + 1 words that begins before a chunk's last window lies in that chunk as a whole; one
that begins in the last window is the next chunk's. So every occurrence counts once.

Words are counted while the texts are parsed. One pass over the dictionary counts the pairs of words
that both reach the least count. A second cuts it down to its runs, the stretches of three words or
more all of whose pairs reach the count. Phrases of three words are counted in the runs, which are then
cut down by these in the same way for the phrases of four, and again for those of five: a phrase is
only counted if both phrases of one word less inside it reach the count. A word and its language stand
for 64 bits of hash from the pairs on, so a pair is told apart by 128 bits, and the phrases that reach
the count get their words back from the frequent words. What reaches the count is sent to the tasks as
a bit map of hashes (``bitmaps``): it may say yes wrongly, which costs a row, and never says no wrongly.

Skew. Batches count words and pairs before rows leave them and Spark all phrases once more before the
shuffle, so a common chunk, pair or phrase costs a row per task. The best phrases of a language are
taken in ``BUCKETS`` parts before they meet.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bit_map
from .common import Words, crcs, mix64, pieces, staged, staged_with, table

LONGEST = 5
WINDOW = LONGEST - 1
MODULUS = 32
LEAST, TOP = 100, 2000
BUCKETS = 16
SPARE = 16_000_000  # characters of chunks that a batch gathers before it counts

_BREAK = b"\n"
_MARK = b"\xff"  # a break inside a batch: no byte of UTF-8, and no blank
_TABLE = bytes(255 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b
               for b in range(256))
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[bytes]:
    """Words and breaks of a text, A-Z lower-cased."""
    return text.encode().translate(_TABLE).replace(_MARK, b" " + _MARK + b" ").split()


def triggers(hashes: np.ndarray, modulus: int = MODULUS) -> np.ndarray:
    """Where a window of a stream with these token hashes is a trigger."""
    n = len(hashes) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            rolled = rolled * _PRIME + hashes[i:i + n]
        return np.flatnonzero(mix64(rolled) % np.uint64(modulus) == 0)


def parse(batches: Iterator[pd.DataFrame], with_words: bool = False) -> Iterator[pd.DataFrame]:
    """(lang, text) to the distinct chunks of each run of whole texts: (lang, text, last, parses).
    ``last`` marks the end of a stream, whose last window counts as well. With words, the run's words
    and their occurrences follow as rows without a ``last``."""
    for run in pieces(batches):
        words, streams = Words(), [tokens(text) for text in run["text"]]
        parts = [words.ids(stream) for stream in streams]
        ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        cuts = triggers(crcs(words.words)[ids]) if words else np.zeros(0, np.int64)
        seen: Counter = Counter()
        start = 0
        for lang, stream in zip(run["lang"], streams):
            if stream:
                end = start + len(stream)
                # triggers whose whole window is this stream's
                own = cuts[np.searchsorted(cuts, start + 1):np.searchsorted(cuts, end - WINDOW, side="right")] - start
                at = [0, *own.tolist()]
                for a, b in zip(at, at[1:]):
                    seen[lang, b" ".join(stream[a:b + WINDOW]), False] += 1
                seen[lang, b" ".join(stream[at[-1]:]), True] += 1
                start = end
        if not seen:
            continue
        yield pd.DataFrame([(g, c.replace(_MARK, _BREAK).decode(), last, n) for (g, c, last), n in seen.items()],
                           columns=["lang", "text", "last", "parses"])
        if with_words:
            langs, lang = np.unique(run["lang"].to_numpy(object), return_inverse=True)
            at = np.flatnonzero(ids != words.get(_MARK, -1))
            counts = pd.Series(np.repeat(lang.astype(np.int64), [len(p) for p in parts])[at] * len(words)
                               + ids[at]).value_counts(sort=False)
            codes = counts.index.to_numpy()
            if len(codes):
                yield pd.DataFrame({"lang": langs[codes // len(words)], "last": None, "parses": counts.to_numpy(),
                                    "text": [words.words[i].decode() for i in (codes % len(words)).tolist()]},
                                   columns=["lang", "text", "last", "parses"])


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, text, last, parses): the distinct chunks of all texts, and without a ``last`` their words
    and occurrences; a null lang is ``und``."""
    streams = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                          F.coalesce(F.col("text"), F.lit("")).alias("text")).filter("text <> ''")
    found = streams.mapInPandas(lambda batches: parse(batches, True), "lang string, text string, last boolean, parses long")
    return found.groupBy("lang", "text", "last").agg(F.sum("parses").alias("parses"))


def hashes(words) -> np.ndarray:
    """64 bits of hash per word (str or bytes), the same in every process."""
    return pd.util.hash_array(np.array([*words, None], object)[:-1], categorize=False)


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases, given the keys of their first words, of their second words and so on."""
    out = parts[0]
    with np.errstate(over="ignore"):
        for part in parts[1:]:
            out = mix64(out * _PRIME + part)
    return out


class Chunks:
    """A batch of the dictionary as one array: ``ids`` of all tokens, ``key`` (hash of word and
    language), the chunk's weight, whether a phrase that begins there is the chunk's (``counted``), how
    many words from there on stand in one piece (``reach``), and that where it is counted (``room``)."""

    def __init__(self, batch: pd.DataFrame):
        self.words = Words()
        self.langs, lang = np.unique(batch["lang"].to_numpy(object), return_inverse=True)
        parts = pc.split_pattern(pa.array(batch["text"].to_numpy(object), pa.string()), " ")
        found = parts.flatten().dictionary_encode()
        self.words.ids([w.encode() for w in found.dictionary.to_pylist()])
        self.ids = found.indices.to_numpy(zero_copy_only=False)
        size = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int32)
        rows = np.repeat(np.arange(len(size), dtype=np.int32), size)
        at = np.arange(len(self.ids), dtype=np.int32)
        self.lang = lang.astype(np.int32)[rows]
        self.weight = batch["parses"].to_numpy(np.int64)[rows]
        own_end = ends - np.where(batch["last"].to_numpy(bool), 0, WINDOW).astype(np.int32)
        self.counted = at < own_end[rows]
        # the next break or the chunk's end bounds a phrase
        stop = np.where(self.ids == self.words.get(_BREAK, -1), at, np.int32(len(self.ids)))
        stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1] if len(stop) else stop, ends[rows])
        self.reach = stop - at  # 0 at a break
        self.room = np.where(self.counted, self.reach, np.int32(0))
        word, tongue = hashes(self.words.words), hashes(self.langs)
        self.key = np.zeros(len(self.ids), np.uint64)
        for part in blocks(len(self.ids)):
            self.key[part] = keys(word[self.ids[part]], tongue[self.lang[part]])


def blocks(n: int, size: int = 1 << 18) -> Iterator[slice]:
    """``n`` positions in parts, so that what is worked out on the way stays small."""
    return (slice(i, min(i + size, n)) for i in range(0, n, size))


def keys(word: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Hashes of words in their language, from the hashes of both."""
    return mix64(word ^ mix64(lang))


def gathered(batches: Iterator[pd.DataFrame], most: int = SPARE) -> Iterator[pd.DataFrame]:
    """Batches joined up to about ``most`` characters, so that more of what repeats meets."""
    held, size = [], 0
    for run in pieces(batches, most):
        held.append(run)
        size += int(run["text"].str.len().sum())
        if size >= most:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def pair_counter(words):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(first, second, f): the pairs of words that may both be frequent, by their keys."""
        for batch in gathered(batches):
            c = Chunks(batch)
            frequent = np.zeros(len(c.ids), bool)
            for part in blocks(len(c.ids)):
                frequent[part] = words.value.has(c.key[part])
            at = np.flatnonzero((c.room > 1) & frequent & np.append(frequent[1:], False))
            if not len(at):
                continue
            size = len(c.words)
            codes = (c.lang[at].astype(np.int64) * size + c.ids[at]) * size + c.ids[at + 1]
            order = np.argsort(codes)
            codes = codes[order]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            total = np.add.reduceat(c.weight[at][order], first)
            at = at[order[first]]
            yield pd.DataFrame({"first": c.key[at].view(np.int64), "second": c.key[at + 1].view(np.int64), "f": total})
    return run


def runs(key: np.ndarray, ok: np.ndarray, counted: np.ndarray, weight: np.ndarray, n: int) -> pa.RecordBatch:
    """(w, own, f): the keys ``w`` of the longest stretches of more than ``n`` words all of whose phrases
    of ``n`` words are ``ok``, and in how many of its first words a phrase that counts begins."""
    edge = np.diff(ok.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    before = np.append(0, np.cumsum(counted))
    own = before[end - 1] - before[start]  # longer phrases begin at start to end - 2
    start, end, own = start[own > 0], end[own > 0], own[own > 0]
    size = end - start + n - 1
    offsets = np.append(0, np.cumsum(size))
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(key[at].view(np.int64))),
         pa.array(own, pa.int32()), pa.array(weight[start], pa.int64())], ["w", "own", "f"])


RUNS = "w array<long>, own int, f long"


def runs_by_pairs(pairs):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs of the dictionary: what stands in frequent pairs and has three words or more."""
        for batch in gathered(b.to_pandas() for b in batches):
            c = Chunks(batch)
            ok = np.zeros(len(c.ids), bool)
            for part in blocks(len(c.ids)):
                at = part.start + np.flatnonzero(c.reach[part] > 1)
                ok[at] = pairs.value.has(joined([c.key[at], c.key[at + 1]]))
            yield runs(c.key, ok, c.counted, c.weight, 2)
    return run


def runs_by_phrases(phrases, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The runs cut down to what stands in frequent phrases of ``n`` words."""
        for batch in batches:
            w, own, f = (batch.column(batch.schema.get_field_index(x)) for x in ("w", "own", "f"))
            key = w.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            size = pc.list_value_length(w).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(key)) - (np.cumsum(size) - size)[rows]
            at = np.flatnonzero(place + n <= size[rows])
            ok = np.zeros(len(key), bool)
            ok[at] = phrases.value.has(joined([key[at + i] for i in range(n)]))
            yield runs(key, ok, place < own.to_numpy(zero_copy_only=False)[rows],
                       f.to_numpy(zero_copy_only=False)[rows], n)
    return run


def in_runs(found: DataFrame, n: int) -> DataFrame:
    """(w, f): the phrases of ``n`` words in runs of frequent phrases of one word less."""
    phrases = F.expr(f"transform(sequence(1, own), i -> slice(w, i, {n}))")
    return found.select(F.explode(phrases).alias("w"), "f").groupBy("w").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """((lang, n) with all word occurrences, (lang, phrase, words, f) of every word and phrase of at
    most ``LONGEST`` words with ``least`` occurrences or more)."""
    send = docs.sparkSession.sparkContext.broadcast

    def frequent(counts: DataFrame, hash_of, label: str):
        """The counts that reach the least, and a bit map of their hashes on its way to the tasks."""
        rows, seen = staged_with(counts.filter(F.col("f") >= least).withColumn("hash", hash_of), label,
                                 F.count(F.lit(1)).alias("n"))
        return rows, send(bit_map(rows, seen["n"]))

    parsed = staged(dictionary(docs), "chunks")
    chunks = parsed.filter("last IS NOT NULL")
    words = parsed.filter("last IS NULL").select("lang", F.col("text").alias("phrase"), F.col("parses").alias("f"))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often, sent = frequent(words, _word_key(), "often-words")
    pairs = (chunks.mapInPandas(pair_counter(sent), "first long, second long, f long").groupBy("first", "second")
             .agg(F.sum("f").alias("f")).select(F.array("first", "second").alias("w"), "f"))
    pairs, sent = frequent(pairs, _phrase_hash(), "often-pairs")
    phrases = pairs.select("w", "f")
    found = staged(chunks.mapInArrow(runs_by_pairs(sent), RUNS), "runs")
    for n in range(3, LONGEST + 1):
        longer, sent = frequent(in_runs(found, n), _phrase_hash(), f"often-{n}")
        phrases = phrases.unionByName(longer.select("w", "f"))
        if n < LONGEST:
            found = staged(found.mapInArrow(runs_by_phrases(sent, n), RUNS), "runs")
    every = often.select("lang", "phrase", F.lit(1).alias("words"), "f").unionByName(spelled(phrases, often))
    return totals, staged(every, "phrases")


def spelled(phrases: DataFrame, often: DataFrame) -> DataFrame:
    """(lang, phrase, words, f) of phrases given by the keys of their words."""
    each = phrases.select("w", "f", F.posexplode("w").alias("i", "hash")).join(often.drop("f"), "hash")
    of = F.transform(F.array_sort(F.collect_list(F.struct("i", "phrase"))), lambda x: x["phrase"])
    return each.groupBy("w", "f").agg(F.first("lang").alias("lang"), F.array_join(of, " ").alias("phrase")).select(
        "lang", "phrase", F.size("w").alias("words"), "f")


def _word_key():
    """``Chunks.key`` of a word."""
    return F.pandas_udf(lambda lang, word: pd.Series(keys(hashes(word), hashes(lang)).view(np.int64)),
                        "long")("lang", "phrase")


def _phrase_hash():
    """``joined`` of the keys in ``w``, which has as many in every row."""
    def of(w: pd.Series) -> pd.Series:
        if not len(w):
            return pd.Series([], dtype="int64")
        return pd.Series(joined(list(np.stack(w.to_list()).view(np.uint64).T)).view(np.int64))
    return F.pandas_udf(of, "long")("w")


#: floor(1000 * a * n / (l * r)) in decimals of up to 38 digits: exact while n is under 9 * 10^15.
SCORE = ("CAST(CAST(a AS DECIMAL(17,0)) * CAST(n * 1000 AS DECIMAL(20,0)) "
         "DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS LONG)")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    Candidates are phrases of two to five words within a piece with a >= ``least`` occurrences. Cut
    after its first words into parts with l and r occurrences, a phrase scores
    floor(1000 * a * n / (l * r)), n being all word occurrences of the language; its lowest-scoring
    cut counts, of equal ones the shortest first part. A candidate inside a longer candidate that
    occurs as often is dropped. Null and empty texts have no words; repeated rows count again; a
    null lang is ``und``; an empty table gives an empty result; other columns are ignored.
    """
    totals, every = phrase_counts(docs, least)
    known = every.select("lang", "phrase", "f")
    cands = every.filter("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"),
                                             F.split("phrase", " ", -1).alias("w"))
    # a longer phrase that occurs as often as one inside it does so at one word more, too
    inside = (cands.filter("words > 2").select("lang", F.col("a").alias("longer"), F.explode(F.array(
        F.array_join(F.slice("w", 1, F.col("words") - 1), " "),
        F.array_join(F.slice("w", 2, F.col("words") - 1), " "))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    left = cands.join(inside, ["lang", "phrase"], "left").filter("longer IS NULL OR longer < a").drop("longer")
    parts = left.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    parts = parts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                         F.array_join(F.slice("w", F.col("k") + 1, F.col("words")), " ").alias("rest"))
    scored = (parts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
              .join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
              .join(totals, "lang"))
    scored = scored.withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))
    some = (best.withColumn("part", part)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .filter(F.col("rank") <= top).drop("rank", "part"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, rid, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS pos
  FROM (SELECT lang, row_number() OVER () AS rid,
          regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS pieces FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (
    SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
    FROM (SELECT lang, ws, unnest([1, 2, 3, 4, 5]) AS m FROM w))),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (
  SELECT * FROM f WHERE m > 1 AND NOT EXISTS (
    SELECT 1 FROM f AS o WHERE o.lang = f.lang AND o.m > f.m AND 100 * o.f >= 100 * f.f
      AND contains(' ' || o.phrase || ' ', ' ' || f.phrase || ' '))),
k AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, m, unnest(range(1, m)) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, a, k.k, x.f AS l, y.f AS r, n,
    ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(ws[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(ws[k.k + 1:k.m], ' ') JOIN t ON t.lang = k.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM z WHERE rank <= 2000
"""
