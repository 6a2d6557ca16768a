"""Text decoding on read: one registry stores Latin-1 (ISO-8859-1) text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LATIN1 = "ISO-8859-1"


def decode_latin1(c: Column) -> Column:
    """Text of a Latin-1 encoded binary column (every byte is one character, never fails)."""
    return F.decode(c, LATIN1)


def read_latin1_text(spark, path: str):
    """Latin-1 text files, one row per line (``value``), blank lines and NUL bytes kept. The
    ``text`` source splits files into lines without decoding them, so the bytes of a line are
    intact and are decoded here; files are split and read in parallel."""
    return spark.read.text(path).select(decode_latin1(F.col("value").cast("binary")).alias("value"))
