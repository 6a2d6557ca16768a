"""Line deduplication: explode normalised lines, hash them, count the distinct documents of each
hash, drop the lines of repeated hashes and put the others together again by position.

Scale: lines travel as 128-bit hashes, never as text. The count is a min/max aggregation with
map-side combine, so a line that a third of all documents hold costs one row per task. The keys
found repeated are written as a table; joining them back has a plain exchange on both sides,
which adaptive execution splits when a key is hot. Texts are shuffled once, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, staged, table, texts

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def repeated_lines(rows: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, text_key, drop): positions of the lines to drop of each text that has some; ``rows``
    are (doc_id, text, text_key)."""
    lines = (rows.filter("doc_id IS NOT NULL")
             .select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
             .select("doc_id", "text_key", "pos", line_key(F.col("line")).alias("key"))
             .filter(F.char_length("key") >= min_chars)
             .select("doc_id", "text_key", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(7), F.col("key")).alias("h2")))
    if min_docs <= 2:  # two documents at least: the smallest and the largest id differ
        keys = (lines.groupBy("h1", "h2")
                .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
                .filter("first_doc < last_doc" if min_docs == 2 else "true"))
    else:
        keys = (lines.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2")
                .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= min_docs))
    keys = staged(keys.select("h1", "h2", "first_doc"), "line-keys")
    return (lines.join(keys, ["h1", "h2"]).filter("doc_id > first_doc")
            .groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("drop")))


def without(text: Column, drop: Column) -> Column:
    """The text without the lines at the positions in ``drop`` (null: the text itself)."""
    lines = F.split(text, "\n", -1)
    # array_except hashes, so this is linear in the lines of a text
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    return F.when(drop.isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as (doc_id, text, n_lines, n_dropped, kept_text).

    Lines whose key has ``min_chars`` code points or more and occurs in ``min_docs`` documents or
    more are dropped, but for those of the smallest doc_id that holds the key (that document keeps
    all its occurrences). Null and empty texts count as one empty line. Rows that repeat a doc_id
    are one document (each row is returned with its own lines). A row without doc_id keeps all its
    lines and is no witness for others. An empty table gives an empty result; other columns are
    ignored, whatever their names.
    """
    rows = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    drops = repeated_lines(rows, min_chars, min_docs)
    return (rows.join(drops, ["doc_id", "text_key"], "left")
            .select("doc_id", "text", F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
                    F.greatest(F.coalesce(F.size("drop"), F.lit(0)), F.lit(0)).cast("long").alias("n_dropped"),
                    without(F.col("text"), F.col("drop")).alias("kept_text")))


def drop_repeated_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with all its columns, ``text`` without the repeated lines and ``n_chars``, if there,
    counted anew where the text changed. The same rules and cases as ``dedup_lines``; a null text
    stays null."""
    rows = texts(docs).withColumn("text_key", F.xxhash64("text"))
    i, key, drop = free_names(docs, "_drop_id", "_drop_key", "_drop")
    drops = repeated_lines(rows, min_chars, min_docs).select(
        F.col("doc_id").alias(i), F.col("text_key").alias(key), F.col("drop").alias(drop))
    found = docs.join(drops, (docs["doc_id"].cast("long") == F.col(i))
                      & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(key)), "left")
    changed = F.col(drop).isNotNull()
    text = F.when(changed, without(docs["text"], F.col(drop))).otherwise(docs["text"])
    columns = [text.alias("text") if c == "text" else
               F.when(changed, F.char_length(text)).otherwise(docs[c]).cast(docs.schema[c].dataType).alias(c)
               if c == "n_chars" else docs[c] for c in docs.columns]
    return found.select(*columns)


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Line deduplication of the whole ``documents`` table."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
l AS (
  SELECT doc_id, rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (
  SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (
  SELECT k.*, coalesce(k.doc_id > r.first_doc, false) AS dropped
  FROM k LEFT JOIN r ON k.key = r.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM j GROUP BY rid, doc_id
"""
