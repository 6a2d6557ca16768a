"""Spelling variants of the words of a corpus by a variable-length gram index.

Words are padded with an end mark on both sides. A dictionary of grams of 2 to ``QMAX`` characters
is pruned by frequency: a gram is extended only where it occurs more than T times, and T is the
smallest power of two with which the dictionary keeps ``MOST_GRAMS`` entries at most, so it can be
sent to all tasks. A word is decomposed into the longest gram of the dictionary at each of its
positions. Which gram that is depends on the characters of the gram and, if the dictionary extends
it, on the one that follows: its *window*. An edit affects the grams whose window it touches and no
other, so of two grams with disjoint windows one edit affects at most one, the left one stays at
its distance from the word's beginning if the edit is behind its window, and the right one at its
distance from the end otherwise. Hence a word merges just two lists of the index, those of the
disjoint pair with the smallest frequencies, and every word at edit distance 1 is in one of them.
Such a pair always exists: windows have ``QMAX`` characters at most, and words six or more.

Scale and skew. Words are counted with map-side combine, so a frequent word costs a row per task.
The index has a row per word and position; lists are joined on a hash of gram and distance, and the
exact distance is a condition of the join, so only verified pairs leave it. Both sides come by plain
exchanges, which adaptive execution splits where one list is long. A word of k letters has at most
(2k + 1) times the alphabet's size near words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, staged_with, table, texts
from .line_dedup import LOWER, UPPER

QMIN, QMAX = 2, 5
MOST_GRAMS = 200_000
MIN_CHARS, MIN_COUNT, FACTOR = 6, 5, 5
BEGIN, END = "\x02", "\x03"
RUN = "[A-Za-z\u00C0-\u00FF]+"
SLIP = 199


def slipped(doc_id: Column, run: Column) -> Column:
    """The run with one code point deleted where ``SLIP`` divides the crc32 h of "doc_id:run"
    (the code point h modulo the length), else the run itself; so for a null id."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % SLIP == 0, F.concat(F.substring(run, F.lit(1), at),
                                          F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``min_chars`` code points or more with ``min_count`` occurrences or
    more. Words are runs of Latin letters, A-Z lower-cased, with the planted slips of ``slipped``."""
    runs = texts(docs).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.filter(F.char_length("run") >= min_chars).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    words = runs.select(slipped(F.col("doc_id"), F.col("run")).alias("word")).filter(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# --- the gram dictionary ---

def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: Counter = Counter()
        for word in batch["word"]:
            p = f"{BEGIN}{word}{END}"
            for q in range(QMIN, QMAX + 1):
                seen.update([p[i:i + q] for i in range(len(p) - q + 1)])
        yield pd.DataFrame({"gram": list(seen), "freq": list(seen.values())})


def gram_dictionary(vocabulary: DataFrame, most: int = MOST_GRAMS) -> tuple[dict[str, int], int]:
    """(frequency of every gram kept, T). A gram of more than ``QMIN`` characters is kept where the
    gram without its last character occurs more than T times; with a gram all its beginnings are
    kept. At most ``most`` grams longer than ``QMIN`` come to the driver."""
    counts = staged(vocabulary.select("word").mapInPandas(_count_grams, "gram string, freq long")
                    .groupBy("gram").agg(F.sum("freq").alias("freq")), "gram-counts")
    parent = counts.select(F.col("gram").alias("start"), F.col("freq").alias("parent"))
    longer = staged(counts.filter(F.char_length("gram") > QMIN)
                    .withColumn("start", F.expr("substring(gram, 1, char_length(gram) - 1)"))
                    .join(parent, "start").select("gram", "freq", "parent"), "gram-parents")
    # how many grams have a parent over 2^k occurrences: one row per power of two
    powers = longer.groupBy(F.floor(F.log2(F.col("parent"))).cast("int").alias("k")).count().collect()
    limit, above = 0, sum(r["count"] for r in powers)
    while above > most:
        above -= sum(r["count"] for r in powers if r["k"] == limit)
        limit += 1
    floor = (1 << limit) - 1  # parents with log2 >= limit have 2^limit occurrences or more
    kept = longer.filter(F.col("parent") > floor).select("gram", "freq").unionByName(
        counts.filter(F.char_length("gram") == QMIN))
    return {r["gram"]: r["freq"] for r in kept.toLocalIterator()}, floor


def decompose(word: str, grams: dict[str, int], floor: int) -> tuple[list[str], list[int]]:
    """(the longest gram of the dictionary at every position of the padded word, the end of its
    window)."""
    p = f"{BEGIN}{word}{END}"
    out, ends = [], []
    for s in range(len(p) - QMIN + 1):
        e = s + QMIN
        while e - s < QMAX and e < len(p) and p[s:e + 1] in grams:
            e += 1
        gram = p[s:e]
        out.append(gram)
        # one more character decided it, if the dictionary has extensions of this gram
        ends.append(min(e + (e - s < QMAX and grams.get(gram, 0) > floor), len(p)))
    return out, ends


def lists_to_merge(grams: list[str], ends: list[int], freq: dict[str, int]) -> tuple[int, int]:
    """Positions (left, right) of the pair of grams with disjoint windows whose lists are shortest."""
    cost = [freq.get(g, 0) for g in grams]
    best = (math.inf, 0, 0)
    for j in range(len(grams) - 1, 0, -1):
        for i in range(j):
            if ends[i] <= j and cost[i] + cost[j] < best[0]:
                best = (cost[i] + cost[j], i, j)
    if best[0] is math.inf:
        raise ValueError("a word needs more characters than the longest gram")
    return best[1], best[2]


def _decomposer(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, floor = shared.value
        for batch in batches:
            lists, left, right = [], [], []
            for word in batch["word"]:
                found, ends = decompose(word, grams, floor)
                i, j = lists_to_merge(found, ends, grams)
                lists.append(found)
                left.append(i)
                right.append(j)
            yield pd.DataFrame({"word": batch["word"], "n": batch["n"], "grams": lists, "left": left, "right": right})
    return run


def near_words(vocabulary: DataFrame, most_grams: int = MOST_GRAMS) -> DataFrame:
    """(word, other, n): all ordered pairs of words of ``vocabulary`` (word, n; distinct words of
    ``QMAX`` + 1 code points or more) that one inserted, deleted or replaced code point tells apart;
    n is the other word's."""
    spark = vocabulary.sparkSession
    shared = spark.sparkContext.broadcast(gram_dictionary(vocabulary, most_grams))
    cut = staged(vocabulary.mapInPandas(
        _decomposer(shared), "word string, n long, grams array<string>, left int, right int"), "gram-words")
    # distances from the beginning count up from 0, those from the end are negative
    ahead, behind = F.col("at"), F.col("at") - F.col("size")
    key = lambda gram, at: F.xxhash64(gram, at)
    index = (cut.select("word", "n", F.size("grams").alias("size"), F.posexplode("grams").alias("at", "gram"))
             .select("word", "n", F.explode(F.array(key(F.col("gram"), ahead), key(F.col("gram"), behind))).alias("key")))
    probe = cut.select(F.col("word").alias("mine"), F.explode(F.array(
        key(F.get("grams", F.col("left")), F.col("left")),
        key(F.get("grams", F.col("right")), F.col("right") - F.size("grams")))).alias("key"))
    near = ((F.abs(F.char_length("mine") - F.char_length("word")) <= 1)
            & (F.levenshtein("mine", "word", 1) == 1))
    pairs = probe.join(index, (probe["key"] == index["key"]) & near).select(
        F.col("mine").alias("word"), F.col("word").alias("other"), "n")
    # both lists may hold a word; one exchange by word serves this and the counts per word
    return pairs.repartition("word").groupBy("word", "other").agg(F.first("n").alias("n"))


def variant_groups(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                   factor: int = FACTOR, most_grams: int = MOST_GRAMS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus.

    Two words are near if one inserted, deleted or replaced code point tells them apart. The form of
    a word is its near word of the largest n (ties: the smallest in code-point order) if that n is
    ``factor`` times the word's or more, else null; the root is the last of its forms. Null and
    empty texts have no words; repeated rows count again; a null doc_id plants no slip; an empty
    table gives an empty result; other columns are ignored, whatever their names.
    """
    if min_chars <= QMAX:
        raise ValueError(f"words need more than {QMAX} characters for the index")
    words, seen = staged_with(word_counts(docs, min_chars, min_count), "words",
                              F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    best = near_words(words, most_grams).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.other")).alias("form"),
        F.when(-F.col("best.less") >= factor * F.col("n"), -F.col("best.less")).alias("form_n"))
    found = staged(found, "word-forms")
    roots = roots_of(found.filter("form IS NOT NULL").select("word", "form"),
                     steps=1 + int(math.log(max(seen["most"], 1), max(factor, 2))))
    return (found.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def roots_of(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): the last word of at most ``steps`` steps
    from form to form, which double with every round. n grows by the factor with each step, so
    ``steps`` is the logarithm of the largest n."""
    roots, done = forms.select("word", F.col("form").alias("root")), 1
    while done < steps:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = staged(roots.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")), "word-roots")
        done *= 2
    return roots


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all ``documents``."""
    return variant_groups(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH RECURSIVE r AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
c AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY ALL),
b AS (  -- UTF-8 bytes of "doc_id:run"
  SELECT *, flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END)) AS bytes
  FROM c),
h AS (  -- their crc32, bit by bit
  SELECT doc_id, run, n, xor(list_reduce(bytes, lambda crc, byte: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, byte)), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM b),
w AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6),
d AS (  -- every word with one code point left out, and whole
  SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM w),
e AS (SELECT word, n, left(word, pos - 1) || substr(word, pos + 1) AS less, pos FROM d),
p AS (
  SELECT x.word, y.word AS other, y.n FROM e x JOIN e y ON x.less = y.less AND x.pos = y.pos AND x.word <> y.word
  UNION SELECT e.word, w.word, w.n FROM e JOIN w ON e.less = w.word
  UNION SELECT w.word, e.word, e.n FROM e JOIN w ON e.less = w.word),
f AS (
  SELECT w.word, w.n, count(p.other) AS n_near, max(p.n) AS most, arg_min(p.other, (-p.n, p.other)) AS best
  FROM w LEFT JOIN p ON w.word = p.word GROUP BY w.word, w.n),
g AS (
  SELECT word, n, n_near, CASE WHEN most >= 5 * n THEN best END AS form,
    CASE WHEN most >= 5 * n THEN most END AS form_n FROM f),
z AS (
  SELECT word, word AS root, form AS next FROM g
  UNION ALL SELECT z.word, g.word, g.form FROM z JOIN g ON z.next = g.word)
SELECT g.word, g.form, z.root, g.n, g.n_near, g.form_n FROM g JOIN z ON g.word = z.word AND z.next IS NULL
"""
