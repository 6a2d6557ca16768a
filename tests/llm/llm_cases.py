"""Shared inputs of the operator tests."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("score", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("drop", T.StringType()), T.StructField("text_key", T.StringType()),
    T.StructField("label", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in ("_id", "_key", "_node", "_rows", "_drop", "_DROP_ID", "_drop_key")),
])

#: nulls, empty and blank texts, ties, repeated rows
ODD = [(None, None), (None, "a line of some length\nshort"), (1, None), (2, ""), (3, " \t\n "), (4, "word"),
       (5, "Word "), (5, "Word "), (5, "another text of the same id"), (6, "a line of some length\nshort"),
       (7, "A LINE OF SOME LENGTH\nother"), (8, "x" * 3000 + "\n" + "é ü 日本 " * 50)]
