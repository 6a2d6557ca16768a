"""The skew-proof numbering equals a plain row_number, including hot and NULL groups."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipflow.operators.numbering import number_rows


def data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # one hot group holding about a third of the rows, many small ones, some NULL groups
        g = "hot" if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else f"g{rnd.randrange(40)}")
        rows.append((g, rnd.randrange(50) if rnd.random() > 0.1 else None, i))
    schema = T.StructType([T.StructField("g", T.StringType()), T.StructField("k", T.IntegerType()),
                           T.StructField("id", T.LongType())])
    return spark.createDataFrame(rows, schema)


def order():
    return [F.col("k").desc_nulls_last(), F.col("id").asc()]


def as_map(df, col="rn"):
    return {r["id"]: r[col] for r in df.select("id", col).collect()}


def test_split_equals_window_grouped(spark):
    df = data(spark)
    want = as_map(number_rows(df, ["g"], order(), "rn", strategy="window"))
    for n in (3, 8, 17):
        got = as_map(number_rows(df, ["g"], order(), "rn", strategy="split", num_slices=n))
        assert got == want


def test_split_equals_window_global_zero_based(spark):
    df = data(spark, n=1000, seed=3)
    want = as_map(number_rows(df, [], order(), "rn", start=0, strategy="window"))
    got = as_map(number_rows(df, [], order(), "rn", start=0, strategy="split", num_slices=6))
    assert got == want and sorted(got.values()) == list(range(1000))


def test_auto_switches_to_split_for_hot_group(spark):
    df = data(spark, n=2000, seed=11)
    want = as_map(number_rows(df, ["g"], order(), "rn", strategy="window"))
    # a bound below the hot group's size forces the split plan
    got = as_map(number_rows(df, ["g"], order(), "rn", strategy="auto", single_task_rows=100))
    assert got == want


def test_numbers_are_contiguous_per_group(spark):
    df = data(spark, n=1500, seed=5)
    out = number_rows(df, ["g"], order(), "rn", start=0, strategy="split", num_slices=5)
    agg = out.groupBy("g").agg(F.min("rn").alias("lo"), F.max("rn").alias("hi"), F.count("*").alias("n"),
                               F.countDistinct("rn").alias("d")).collect()
    for r in agg:
        assert r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"]


def test_auto_splits_only_hot_groups(spark):
    """With a bound between the small groups and the hot one, only the hot group is split."""
    df = data(spark, n=2500, seed=13)
    want = as_map(number_rows(df, ["g"], order(), "rn", start=0, strategy="window"))
    out = number_rows(df, ["g"], order(), "rn", start=0, strategy="auto", single_task_rows=200)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_pos" in plan and "parquet" in plan and "Union" in plan   # hot rows read from staged slices
    assert as_map(out) == want


def test_auto_global_numbering_above_bound_is_split(spark):
    df = data(spark, n=800, seed=17)
    want = as_map(number_rows(df, [], order(), "rn", start=0, strategy="window"))
    assert as_map(number_rows(df, [], order(), "rn", start=0, single_task_rows=100)) == want


def test_staged_and_unstaged_input_give_same_numbers(spark):
    df = data(spark, n=2000, seed=23)
    want = as_map(number_rows(df, ["g"], order(), "rn", strategy="window"))
    for stage in (False, True):
        for kw in (dict(strategy="auto"), dict(strategy="auto", single_task_rows=150), dict(strategy="split")):
            assert as_map(number_rows(df, ["g"], order(), "rn", stage_input=stage, **kw)) == want


def test_hot_split_uses_one_full_shuffle(spark):
    df = data(spark, n=2500, seed=29)
    want = as_map(number_rows(df, ["g"], order(), "rn", start=0, strategy="window"))
    for n in (3, 16):
        out = number_rows(df, ["g"], order(), "rn", start=0, single_task_rows=200, num_slices=n)
        assert as_map(out) == want
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]  # final plan
    # the one range shuffle ran in the slicing job; the final plan reads the staged slices and
    # numbers rows inside them without a second shuffle of full rows
    assert "slices-" in plan and "rangepartitioning" not in plan
    assert not any("hashpartitioning(" in ln and "_slice" in ln and "id#" in ln for ln in plan.splitlines())


def test_global_split_many_slices(spark):
    df = data(spark, n=1200, seed=31)
    want = as_map(number_rows(df, [], order(), "rn", strategy="window"))
    assert as_map(number_rows(df, [], order(), "rn", single_task_rows=50, num_slices=11)) == want


def test_many_groups_split_variant(spark, monkeypatch):
    """The split plan for many groups (window per slice, broadcast per-slice offsets)."""
    from slipflow.operators import numbering
    monkeypatch.setattr(numbering, "FEW_GROUPS", 0)
    df = data(spark, n=2000, seed=37)
    want = as_map(number_rows(df, ["g"], order(), "rn", strategy="window"))
    for kw in (dict(strategy="split", num_slices=7), dict(single_task_rows=150)):
        assert as_map(number_rows(df, ["g"], order(), "rn", **kw)) == want
