"""A pointer publishes whole runs only."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from helpers import CFG, doc, registry
from slipflow.operators import manifest
from slipflow.plans import job, publish

TIME = dt.datetime(2021, 8, 4, 14)


def reg_of(spark, n=6):
    return registry(spark, [doc(i, "MRC", dept=1 + (i == 3), created=dt.datetime(1999, 1, 1 + i)) for i in range(1, n + 1)],
                    divisions=[dict(DivisionID=d, Version=None, Server="http://s", WorkSpace="w", DocumentDocLibrary="L",
                                    DocumentPath="p") for d in (1, 2)])


def ids(df):
    return sorted(r[0] for r in df.select("DocumentID").collect())


def test_run_that_dies_between_two_writes_changes_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    assert publish.current(spark, base) is None
    with pytest.raises(ValueError, match="no run"):
        publish.read_current(spark, base, "manifest")
    folder = job.run_published(spark, reg_of(spark), CFG, base, "run-1", run_time=TIME)
    assert folder.endswith("/runs/run-1") and publish.current(spark, base) == "run-1"
    before = {n: publish.read_current(spark, base, n).collect() for n in job.OUTPUTS}
    assert ids(publish.read_current(spark, base, "manifest")) == [1, 2, 3, 4, 5, 6]

    def die(*_):
        raise KeyboardInterrupt("killed")
    with monkeypatch.context() as m:  # after the selection and the manifest, before the summary
        m.setattr(job.reconcile, "fetch_summary", die)
        with pytest.raises(KeyboardInterrupt):
            job.run_published(spark, reg_of(spark, 4), CFG, base, "run-2", run_time=TIME)
    assert os.path.exists(f"{base}/runs/run-2/manifest/_SUCCESS")
    assert publish.current(spark, base) == "run-1"
    assert {n: publish.read_current(spark, base, n).collect() for n in job.OUTPUTS} == before
    with pytest.raises(ValueError, match="not complete"):
        publish.publish(spark, base, "run-2", job.OUTPUTS)
    # the rerun writes the same folder whole and publishes it
    job.run_published(spark, reg_of(spark, 4), CFG, base, "run-2", run_time=TIME)
    assert publish.current(spark, base) == "run-2"
    assert ids(publish.read_current(spark, base, "manifest")) == [1, 2, 3, 4]
    assert ids(spark.read.parquet(f"{base}/runs/run-1/manifest")) == [1, 2, 3, 4, 5, 6]
    with pytest.raises(ValueError, match="published"):
        job.run_published(spark, reg_of(spark), CFG, base, "run-2", run_time=TIME)
    assert not [n for n in os.listdir(base) if n.startswith(".CURRENT-")]


def test_rerun_gives_the_same_rows_a_file(spark, tmp_path):
    def written(base):
        job.run_published(spark, reg_of(spark), CFG, base, "r", run_time=TIME)
        files = [(os.path.relpath(os.path.dirname(os.path.join(d, f)), base), os.path.join(d, f))
                 for d, _, names in os.walk(f"{base}/runs/r") for f in sorted(names) if f.endswith((".parquet", ".txt"))]
        return [(where, spark.read.parquet(f).collect() if f.endswith(".parquet") else spark.read.text(f).collect())
                for where, f in files]
    assert written(str(tmp_path / "a")) == written(str(tmp_path / "b"))


def laid(spark, names, rows):
    df = spark.createDataFrame([(d, i, 0) for d in names for i in range(rows)], "DepartmentName string, record_num long, "
                               "folder_num int")
    return manifest.sink_layout(df)


def test_departments_are_replaced_alone(spark, tmp_path):
    base = str(tmp_path)

    def first(folder):
        publish.write_departments(laid(spark, ["A", "", "B"], 30), f"{folder}/manifest", 7)
        return ["manifest"]
    publish.run_and_publish(spark, base, "one", first)
    sizes = spark.read.parquet(f"{base}/runs/one/manifest").groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in sizes) <= 7 and sum(r["count"] for r in sizes) == 90
    publish.amend_departments(spark, base, "two", laid(spark, ["B", "C"], 4), rows_per_file=7)
    count = lambda df: {r[0]: r[1] for r in df.groupBy("DepartmentName").count().collect()}
    assert count(publish.read_current(spark, base, "manifest")) == {"A": 30, "": 30, "B": 4, "C": 4}
    assert count(spark.read.parquet(f"{base}/runs/one/manifest")) == {"A": 30, "": 30, "B": 30}


def test_names_of_runs():
    for bad in ("", "../x", "a/b", ".x"):
        with pytest.raises(ValueError):
            publish.run_folder("/x", bad)
