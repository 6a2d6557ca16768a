"""Extraction ranges: every row once, like sizes, heavy and missing keys apart."""

import random

import pytest
from pyspark.sql import functions as F

from slipflow.sources.ranges import key_bounds, part_of, plan_ranges, range_predicates
from slipflow.sources.registry import jdbc_options


def sizes(spark, keys, parts, later=()):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    predicates = plan_ranges(df, "k", parts)
    every = df.unionByName(spark.createDataFrame([(k,) for k in later], "k long")) if later else df
    number, hits = part_of("k", predicates)
    rows = every.select(number.alias("part"), hits.alias("hits"), "k").collect()
    assert all(r["hits"] == 1 for r in rows) and len(rows) == len(keys) + len(later)
    out = [0] * len(predicates)
    for r in rows:
        out[r["part"]] += 1
    assert out[-1] == sum(r["k"] is None for r in rows)
    return out, predicates


def test_skewed_keys_give_like_parts(spark):
    rng = random.Random(1)
    keys = [int(rng.paretovariate(0.6)) for _ in range(20_000)]
    out, _ = sizes(spark, keys, 16)
    ones = sum(k == 1 for k in keys)
    assert max(out) <= max(ones, 1.35 * len(keys) / 16)
    # equal widths would put nearly all of them into the first part
    width = (max(keys) - min(keys)) / 16
    assert sum(k < min(keys) + width for k in keys) > 0.95 * len(keys)


def test_a_heavy_value_stands_alone(spark):
    keys = [7] * 5000 + list(range(-500, 500)) * 3 + [None] * 400
    out, predicates = sizes(spark, keys, 10)
    assert "k >= 7 AND k < 8" in predicates and out[predicates.index("k >= 7 AND k < 8")] == 5003
    assert out[-1] == 400 and predicates[-1] == "k IS NULL"


def test_rows_that_came_later_are_read(spark):
    sizes(spark, list(range(100)), 5, later=[-10**12, 10**12, None, 50])


@pytest.mark.parametrize("keys", [[], [None, None], [5], [5] * 50, [2**62, -2**62]])
def test_few_keys(spark, keys):
    sizes(spark, keys, 4, later=[1, None])


def test_predicates():
    assert range_predicates("c", [3, 9]) == ["c < 3", "c >= 3 AND c < 9", "c >= 9", "c IS NULL"]
    assert range_predicates("c", []) == ["c IS NOT NULL", "c IS NULL"]
    with pytest.raises(ValueError):
        range_predicates("c", [3, 3])


def test_bounds_are_few_numbers(spark):
    df = spark.range(10_000).select((F.col("id") * 3).alias("k"))
    assert key_bounds(df, "k", 1) == [] and len(key_bounds(df, "k", 8)) == 7


def test_predicates_replace_bounds_given_by_hand():
    opts = jdbc_options("jdbc:x", "docs", predicates=["a < 3", "a >= 3", "a IS NULL"])
    assert "partitionColumn" not in opts and opts["dbtable"].startswith("(SELECT DocumentID")
    with pytest.raises(ValueError, match="predicates"):
        jdbc_options("jdbc:x", "docs", predicates=[])
