"""The whole run end to end on the sf0.001 fixture registry written in the deployment layout."""

import datetime as dt
import os

from slipflow.config import FIXTURE
from slipflow.plans import job
from slipflow.sources.fixtures import fixture_registry
from slipflow.sources.registry import Registry, load_parquet


def test_job_end_to_end(spark, tmp_path):
    reg = fixture_registry(spark, "/root/testdata/sf0.001")
    for name in Registry.table_names():
        reg.table(name).write.parquet(str(tmp_path / "registry" / f"{name}.parquet"))
    loaded = load_parquet(spark, str(tmp_path / "registry"))
    cfg = FIXTURE.with_(folder_size=10)

    # a first run without a landing folder: every document is reported as not found
    out = job.run(spark, loaded, cfg, str(tmp_path / "run0"), run_time=dt.datetime(2021, 8, 4, 14))
    assert out["selected"].count() == 37 and out["manifest"].count() == 37
    assert {r["status"] for r in out["status"].collect()} == {"FILE NOT FOUND"}

    # land the first three files of every department, then reconcile again
    landing = tmp_path / "landing"
    first = [r["landing_path"] for r in out["manifest"].where("record_num < 3 AND landing_path IS NOT NULL").collect()]
    for rel in first:
        os.makedirs(landing / os.path.dirname(rel), exist_ok=True)
        (landing / rel).write_bytes(b"%PDF")
    out = job.run(spark, loaded, cfg, str(tmp_path / "run1"), landing_root=str(landing),
                  run_time=dt.datetime(2021, 8, 4, 14))
    ok = out["status"].where("status = 'OK'").count()
    assert ok == len(first)
    summary = {(r["DepartmentName"], r["status"]): r["documents"] for r in out["summary"].collect()}
    assert sum(v for (d, s), v in summary.items() if s == "OK") == ok
    lines = [r["value"] for r in out["log"].collect()]
    assert len(lines) == 37 + out["manifest"].select("DepartmentName").distinct().count()
    assert os.path.isdir(tmp_path / "run1" / "manifest")
    # one folder per department key; '' and a name of digits come back as they were
    folders = [p for p in os.listdir(tmp_path / "run1" / "manifest") if p.startswith("department_key=d")]
    names = {r["DepartmentName"] for r in out["manifest"].select("DepartmentName").distinct().collect()}
    assert len(folders) == len(names) and {"", "007"} & names
    assert dict(out["manifest"].dtypes)["DepartmentName"] == "string"
    assert dict(out["manifest"].dtypes)["folder_num"] == "bigint"
    assert os.path.isdir(tmp_path / "run1" / " 04-08-21 14PM.txt")


def test_job_command_line(spark, tmp_path):
    reg = fixture_registry(spark, "/root/testdata/sf0.001")
    for name in Registry.table_names():
        reg.table(name).write.parquet(str(tmp_path / "registry" / f"{name}.parquet"))
    job.main(["--registry", str(tmp_path / "registry"), "--out", str(tmp_path / "run"),
              "--inception-after", "1995-07-01", "--created-before", "2000-02-15", "--folder-size", "10"])
    assert spark.read.parquet(str(tmp_path / "run" / "selected")).count() == 37
    assert spark.read.parquet(str(tmp_path / "run" / "manifest")).count() == 37


def test_job_on_two_registries(spark, tmp_path):
    """Two halves of the documents, the second without an optional column."""
    for source in ("registry_a", "registry_b"):
        reg = fixture_registry(spark, "/root/testdata/sf0.001", source)
        for name in Registry.table_names():
            table = reg.table(name).drop("UserName") if source == "registry_b" else reg.table(name)
            table.write.parquet(str(tmp_path / source / f"{name}.parquet"))
    job.main([*[x for s in ("registry_a", "registry_b") for x in ("--registry", f"{s}={tmp_path / s}")],
              "--out", str(tmp_path / "run"), "--inception-after", "1995-07-01",
              "--created-before", "2000-02-15", "--folder-size", "10"])
    rows = spark.read.parquet(str(tmp_path / "run" / "selected")).select("DocumentID", "Source").collect()
    assert len(rows) == 37
    assert {(r["DocumentID"] % 2, r["Source"]) for r in rows} == {(0, "registry_a"), (1, "registry_b")}
    assert spark.read.parquet(str(tmp_path / "run" / "manifest")).count() == 37
