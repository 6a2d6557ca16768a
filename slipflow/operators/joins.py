"""Join helpers: size-checked broadcast and a shuffle-free join on a constant condition."""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Dimension tables (folders, statuses, object types, departments, division settings) are
# broadcast only after a runtime check that they hold at most this many rows.
DIMENSION_ROW_LIMIT = 200_000


def row_count_at_most(df: DataFrame, limit: int) -> bool:
    """True when ``df`` has at most ``limit`` rows; reads at most ``limit + 1`` rows."""
    return df.limit(limit + 1).count() <= limit


_CHECKED: "weakref.WeakKeyDictionary[DataFrame, bool]" = weakref.WeakKeyDictionary()


def is_bounded(df: DataFrame, limit: int = DIMENSION_ROW_LIMIT) -> bool:
    """``row_count_at_most`` for a registry table, checked once per table object."""
    ok = _CHECKED.get(df)
    if ok is None:
        ok = _CHECKED[df] = row_count_at_most(df, limit)
    return ok


def dimension(df: DataFrame, limit: int = DIMENSION_ROW_LIMIT) -> DataFrame:
    """Broadcast hint for a registry lookup table when its row count is proven to be within
    ``limit`` (checked once per table object). Beyond the limit the table is returned unhinted,
    so Spark plans a shuffle join (and AQE may still switch to a broadcast from runtime sizes)."""
    return F.broadcast(df) if is_bounded(df, limit) else df


def key_text(c: Column, case_sensitive: bool) -> Column:
    """Join key for text compared under the registry collation (trailing blanks ignored)."""
    c = F.rtrim(c)
    return c if case_sensitive else F.lower(c)


# A constant-condition join inlines the matching rows as literals up to this many rows.
INLINE_ROW_LIMIT = 1_000


_INLINE: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def small_rows(df: DataFrame, limit: int = INLINE_ROW_LIMIT, *, cache_on: DataFrame | None = None,
               key=None) -> list | None:
    """The rows of ``df`` when there are at most ``limit`` (read once), else None. With
    ``cache_on`` (a registry table ``df`` is derived from) the answer is kept per ``key``."""
    if cache_on is not None:
        memo = _INLINE.setdefault(cache_on, {})
        if key not in memo:
            memo[key] = small_rows(df, limit)
        return memo[key]
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


_READ_HERE = object()


def join_on_constant(left: DataFrame, right: DataFrame, salt_buckets: int = 64,
                     inline_limit: int = INLINE_ROW_LIMIT, *, inline=_READ_HERE) -> DataFrame:
    """Inner join where every ``left`` row matches every ``right`` row (``JOIN .. ON col = 'P'``
    once ``right`` is filtered): ``left`` is repeated once per row of ``right``.

    Never planned as a cross or nested-loop join. When ``right`` is proven to hold at most
    ``inline_limit`` rows (normally one: a code is a key), those rows are read once and inlined
    as a literal array that each ``left`` row is exploded over (no join, no shuffle). Beyond the
    limit ``left`` rows get a salt in ``[0, salt_buckets)`` (a hash of the row, so retries give
    the same salt) and ``right`` rows are replicated once per salt, an equi-join on the salt
    that spreads the work over ``salt_buckets`` keys. ``inline`` passes the result of an earlier
    ``small_rows`` call (rows, or None for too many); by default it is read here.
    """
    small = small_rows(right, inline_limit) if inline is _READ_HERE else inline
    if small is not None:
        fields = right.schema.fields
        if not small:  # nothing matches the constant condition: no rows
            return left.select(*left.columns, *[F.lit(None).cast(f.dataType).alias(f.name)
                                                for f in fields]).where(F.lit(False))
        rows = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields])
                         for r in small])
        exploded = left.withColumn("_r", F.explode(rows))
        return exploded.select(*left.columns, *[F.col(f"_r.{f.name}").alias(f.name) for f in fields])
    l2 = left.withColumn("_k", F.pmod(F.xxhash64(*left.columns), F.lit(salt_buckets)).cast("int"))
    r2 = right.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
    return l2.join(r2, "_k").drop("_k")
