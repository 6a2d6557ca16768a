"""Column helpers reproducing the text semantics of the original SQL and driver.

All helpers return built-in Column expressions (JVM side, whole-stage codegen); none is a UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus(*parts) -> Column:
    """String ``a + b`` of the original SQL: NULL if any part is NULL (Spark ``concat``).

    Python strings are literals, Columns are expressions.
    """
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def concat_blank_null(*parts: Column) -> Column:
    """``CONCAT(..)``: NULL parts count as empty text; never NULL."""
    return F.concat_ws("", *parts)


def blank_to_null(c: Column) -> Column:
    """``NULLIF(s, '')`` with trailing blanks ignored by the comparison."""
    return F.when(F.rtrim(c) == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def zero_to_null(c: Column) -> Column:
    """``NULLIF(n, 0)``."""
    return F.when(c == F.lit(0), F.lit(None)).otherwise(c)


def narrow_int_text(c: Column, width: int = 2) -> Column:
    """``CAST(n AS VARCHAR(width))``: a number that does not fit becomes ``'*'``; NULL stays NULL."""
    hi = 10 ** width - 1
    lo = -(10 ** (width - 1) - 1)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when((c > F.lit(hi)) | (c < F.lit(lo)), F.lit("*"))
            .otherwise(c.cast("string")))


def strip_first_char(c: Column) -> Column:
    """``STUFF(s, 1, 1, '')``: drop the first character; empty or NULL text gives NULL."""
    return F.when(F.length(c) >= 1, F.substring(c, 2, 2 ** 31 - 1))


def last_extension(c: Column) -> Column:
    """Text after the last dot; a name without a dot gives NULL (``'a.'`` gives ``''``)."""
    return F.when(c.contains("."), F.substring_index(c, ".", -1))


def replace_text(c: Column, search: str, repl: str, case_sensitive: bool = True) -> Column:
    """``REPLACE(s, search, repl)``; under a case-insensitive collation the search ignores case."""
    if case_sensitive or search.lower() == search.upper():
        return F.replace(c, F.lit(search), F.lit(repl))
    return F.regexp_replace(c, "(?i)" + re.escape(search), repl.replace("\\", "\\\\").replace("$", "\\$"))


def fold(c: Column, case_sensitive: bool) -> Column:
    return c if case_sensitive else F.lower(c)


def contains_text(c: Column, word: str, case_sensitive: bool = False) -> Column:
    """``s LIKE '%word%'`` (no wildcard characters in ``word``)."""
    w = word if case_sensitive else word.lower()
    return fold(c, case_sensitive).contains(F.lit(w))


def same_text(c: Column, value: str, case_sensitive: bool = False) -> Column:
    """``s = 'value'`` of the original database: trailing blanks ignored, case per collation."""
    v = value.rstrip(" ")
    v = v if case_sensitive else v.lower()
    return fold(F.rtrim(c), case_sensitive) == F.lit(v)


def any_word_pattern(words, case_sensitive: bool = False) -> str:
    """One Java regex matching any of ``words`` as a literal substring (words folded to lower
    case unless ``case_sensitive``; apply it to text folded the same way)."""
    ws = words if case_sensitive else [w.lower() for w in words]
    return "|".join(re.escape(w) for w in dict.fromkeys(ws))


def contains_any(c: Column, words, case_sensitive: bool = False) -> Column:
    """OR of ``s LIKE '%w%'`` over ``words``; NULL text gives NULL."""
    return fold(c, case_sensitive).rlike(any_word_pattern(words, case_sensitive))


def matched_words(c: Column, words, case_sensitive: bool = False) -> Column:
    """Array of the ``words`` contained in ``c`` (in list order); NULL text gives NULL."""
    arr = F.array(*[F.lit(w) for w in words])
    if case_sensitive:
        return F.filter(arr, lambda w: F.instr(c, w) > 0)
    low = F.lower(c)
    return F.filter(arr, lambda w: F.instr(low, F.lower(w)) > 0)


# The characters that Python's ``str.split`` takes as blanks.
PYTHON_BLANKS = (r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")


def first_token(c: Column) -> Column:
    """Python ``s.rsplit()[0]``: first token between Unicode blanks, NULL when there is none."""
    token = F.regexp_extract(c, f"([^{PYTHON_BLANKS}]+)", 1)
    return F.when(token != F.lit(""), token)
