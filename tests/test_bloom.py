"""Reconciliation with a Bloom filter: the filter is planned, less is shuffled, the same rows."""

import pytest
from pyspark.sql import functions as F

from slipflow.operators import reconcile


@pytest.fixture()
def tables(spark, tmp_path):
    man = spark.range(400).select(
        F.when(F.col("id") % 9 > 0, F.concat(F.lit(" 0 M/"), F.col("id"))).alias("landing_path"),
        F.lit("M").alias("DepartmentName"), F.col("id").alias("record_num"))
    names = F.when(F.col("id") % 11 > 0, F.concat(F.lit(" 0 M/"), F.col("id") * 2))
    landed = spark.range(60_000).select(names.alias("landing_path"))
    landed.unionByName(landed.where("landing_path < ' 0 M/2'")).write.parquet(str(tmp_path / "landed"))
    return man, spark.read.parquet(str(tmp_path / "landed"))


def shuffled(df):
    """Rows that all exchanges of a plan that has run have written."""
    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().apply("shuffleRecordsWritten").value() if kind == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))
    return walk(df._jdf.queryExecution().executedPlan())


def test_filter_is_planned_and_less_is_shuffled(spark, tables):
    man, landed = tables
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    with reconcile.settings(spark, conf):
        plain = reconcile.fetch_status(reconcile.write_stage(man, "m"), landed)
        reduced = reconcile.fetch_status(reconcile.written_manifest(man), landed)
        assert "might_contain" in reduced._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" not in plain._jdf.queryExecution().optimizedPlan().toString()
        want, got = sorted(map(tuple, plain.collect()), key=str), sorted(map(tuple, reduced.collect()), key=str)
        assert got == want and {r[-1] for r in got} == {"OK", "FILE NOT FOUND"}
        assert shuffled(reduced) < shuffled(plain) / 10
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def test_reduced_status_is_the_status(spark, tables):
    man, landed = tables
    before = spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")
    got = reconcile.fetch_status_reduced(man, landed, larger_than="1")
    want = reconcile.fetch_status(man, landed)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 400
    assert reconcile.fetch_status_reduced(man, landed.limit(0), larger_than="1").where("status = 'OK'").count() == 0
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") == before
