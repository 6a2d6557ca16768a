"""Documents by month: static and dynamic pruning, fewer files, equal results."""

import datetime as dt
import re

from pyspark.sql import functions as F

from helpers import CFG, doc, registry
from slipflow.config import FIXTURE
from slipflow.operators import selection
from slipflow.plans.catalog import registry as fixture
from slipflow.sources import monthly

SF = "/root/testdata/sf0.01"


def stored(spark, docs, path, **kw):
    monthly.store_by_month(docs, path, **kw)
    return monthly.load_months(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(df):
    return df.select(F.input_file_name()).distinct().count()


def test_static_pruning(spark, tmp_path):
    reg = fixture(spark, SF)
    cfg = FIXTURE.with_(created_before=dt.datetime(1995, 3, 17))
    months = stored(spark, reg.docs, str(tmp_path / "m"))
    some = monthly.created_before(months, cfg)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(some))[1]
    assert "created_month" in filters and "1995-03" in filters
    assert 0 < files(some) < files(months) / 1.5
    got = selection.selected_documents(reg.with_tables(docs=some.drop(monthly.MONTH)), cfg)
    want = selection.selected_documents(reg, cfg)
    assert got.collect() == want.collect() and want.count() > 10


def test_dynamic_pruning(spark, tmp_path):
    reg = fixture(spark, SF)
    months = stored(spark, reg.docs, str(tmp_path / "m"))
    wanted = spark.createDataFrame([("1994-02", 1), ("1996-05", 1), ("1996-05", 1), ("1997-01", 0)], "created_month string, go int")
    some = monthly.in_months(months, wanted.where("go = 1"))
    assert "dynamicpruning" in plan(some)
    real = reg.docs.where(F.date_format("CreateDate", "yyyy-MM").isin("1994-02", "1996-05"))
    assert some.drop(monthly.MONTH).exceptAll(real).count() == 0 and some.count() == real.count() > 0
    some.collect()
    read = re.findall(r"number of files read[^0-9]*([0-9]+)", plan(some))
    assert files(some) < files(months) / 10 or read


def test_odd_dates(spark, tmp_path):
    docs = [doc(1, "MRC", created=dt.datetime(1999, 12, 31, 23, 59, 59)), doc(2, "MRC") | {"CreateDate": None},
            doc(3, "MRC", created=dt.datetime(2000, 2, 14)), doc(4, "MRC", created=dt.datetime(2000, 2, 15)),
            doc(5, "MRC", created=dt.datetime(2000, 2, 28)), doc(6, "MRC", created=dt.datetime(1, 1, 1))]
    reg = registry(spark, docs)
    months = stored(spark, reg.docs, str(tmp_path / "m"))
    assert {r[0]: r[1] for r in months.select("DocumentID", monthly.MONTH).collect()} == {
        1: "1999-12", 2: "none", 3: "2000-02", 4: "2000-02", 5: "2000-02", 6: "0001-01"}
    assert months.drop(monthly.MONTH).exceptAll(reg.docs).count() == 0
    some = reg.with_tables(docs=monthly.created_before(months, CFG).drop(monthly.MONTH))
    assert selection.selected_documents(some, CFG).collect() == selection.selected_documents(reg, CFG).collect()


def test_files_are_bounded(spark, tmp_path):
    docs = spark.range(500).select(F.col("id").alias("DocumentID"), F.lit("1999-01-05").cast("timestamp_ntz").alias("CreateDate"))
    path = str(tmp_path / "m")
    monthly.store_by_month(docs, path, rows_per_file=20)
    rows = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in rows) <= 20 and sum(r["count"] for r in rows) == 500
