"""A registry stored by contract key: no exchange under join and window, hot buckets split."""

import re

import pytest
from pyspark.sql import functions as F

from slipflow.config import FIXTURE
from slipflow.operators import priority
from slipflow.sources.stored import load_stored, store_by_contract
from test_skew import HOT, hot_registry, ranks


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    reg = hot_registry(spark)
    store_by_contract(reg, FIXTURE, path, 8)
    return reg, load_stored(spark, path, FIXTURE), path


def ranking(reg):
    return priority.rank_input(priority.prioritised_documents(reg, FIXTURE))


def test_join_and_window_have_no_exchange(spark, stored):
    reg, kept, _ = stored
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the small contracts would be broadcast
    try:
        plan = priority.rank_documents(ranking(kept), strategy="window")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin [RootObjectID" in plan and "Window [row_number" in re.sub(r"#\d+L?", "", plan)
    assert "Exchange hashpartitioning" not in plan and "SelectedBucketsCount: 8 out of 8" in plan


def test_numbers_are_equal_and_hot_buckets_split(spark, stored):
    reg, kept, _ = stored
    want = ranks(priority.rank_documents(ranking(reg), strategy="window"))
    assert ranks(priority.rank_documents(ranking(kept), strategy="window")) == want
    sizes = ranking(reg).groupBy(*priority.CONTRACT_KEYS).count().orderBy(F.desc("count")).take(2)
    assert sizes[0]["RootObjectID"] == HOT
    got = priority.rank_documents(ranking(kept), single_task_rows=sizes[1]["count"], num_slices=6,
                                  **priority.ranking_parts(kept, FIXTURE))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_pos" in plan and "Union" in plan and "LeftAnti" in plan
    assert ranks(got) == want
    # the hot documents are read without their buckets: as many tasks as there are splits of the files
    docs = kept.plain_docs.where(F.col("RootObjectID") == HOT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert docs.rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_and_layout(spark, stored):
    reg, kept, path = stored
    assert kept.docs.drop("ContractCode").exceptAll(reg.docs).count() == 0 and kept.docs.count() == reg.docs.count()
    assert kept.stored_contracts.count() == priority.contract_side(reg, FIXTURE).count()
    files = spark.read.parquet(f"{path}/docs").select(F.input_file_name()).distinct().count()
    assert files <= 8  # one file a bucket
    with pytest.raises(ValueError, match="collation"):
        load_stored(spark, path, FIXTURE.with_(case_sensitive=True))
