"""Landed-file inventory (binaryFile listing), fetch status, summary and log lines."""

import datetime as dt
import os

from pyspark.sql import types as T

from slipflow.operators import reconcile
from slipflow.sources.inventory import landed_inventory

MAN_SCHEMA = T.StructType([
    T.StructField("DepartmentName", T.StringType()), T.StructField("record_num", T.LongType()),
    T.StructField("filename", T.StringType()), T.StructField("landing_path", T.StringType()),
    T.StructField("UniqueMarketRef", T.StringType()),
])


def test_fetch_status_against_landed_files(spark, tmp_path):
    rows = [("Marine", 0, "1_7_FAC.pdf", " 0 Marine/0 - 1_7_FAC.pdf", "U1"),
            ("Marine", 1, "2_7_FAC.pdf", " 0 Marine/1 - 2_7_FAC.pdf", "U2"),
            ("Aviation", 0, "3_7_POL.pdf", " 0 Aviation/0 - 3_7_POL.pdf", None),
            ("Aviation", 1, None, None, "U4")]
    man = spark.createDataFrame(rows, MAN_SCHEMA)
    for rel in (" 0 Marine/0 - 1_7_FAC.pdf", " 0 Aviation/0 - 3_7_POL.pdf", "notes.txt"):
        p = tmp_path / rel
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(b"%PDF-1.4")
    inv = landed_inventory(spark, str(tmp_path), suffix=".pdf")
    assert sorted(r["landing_path"] for r in inv.collect()) == [" 0 Aviation/0 - 3_7_POL.pdf",
                                                              " 0 Marine/0 - 1_7_FAC.pdf"]
    by_folder = landed_inventory(spark, str(tmp_path), suffix=".pdf", folders=[" 0 Marine", " 0 Aviation"])
    assert sorted(r["landing_path"] for r in by_folder.collect()) == sorted(r["landing_path"] for r in inv.collect())
    status = {r["filename"]: r["status"] for r in reconcile.fetch_status(man, inv).collect()}
    assert status == {"1_7_FAC.pdf": "OK", "2_7_FAC.pdf": "FILE NOT FOUND", "3_7_POL.pdf": "OK",
                      None: "FILE NOT FOUND"}
    assert sorted(r["record_num"] for r in reconcile.missing_files(man, inv).collect()) == [1, 1]
    summary = {(r["DepartmentName"], r["status"]): r["documents"]
               for r in reconcile.fetch_summary(reconcile.fetch_status(man, inv)).collect()}
    assert summary == {("Marine", "OK"): 1, ("Marine", "FILE NOT FOUND"): 1, ("Aviation", "OK"): 1,
                       ("Aviation", "FILE NOT FOUND"): 1}

    log = reconcile.run_log_lines(reconcile.fetch_status(man, inv), dt.datetime(2021, 8, 4, 14, 10))
    lines = {(r["DepartmentName"], r["record_num"]): r["line"] for r in log.collect()}
    assert lines[("Marine", -1)] == "Marine 2" and lines[("Aviation", -1)] == "Aviation 2"
    assert lines[("Aviation", 1)] == " , FILE NOT FOUND  , U4"
    assert lines[("Marine", 0)] == "1_7_FAC.pdf , OK , U1"
    assert lines[("Marine", 1)] == "2_7_FAC.pdf , FILE NOT FOUND  , U2"
    assert lines[("Aviation", 0)] == "3_7_POL.pdf , OK , "
    assert {r["log_file"] for r in log.collect()} == {" 04-08-21 14PM.txt"}


def test_write_run_log_keeps_order(spark, tmp_path):
    rows = [("B", 1, "b1.pdf", "x", "U"), ("A", 0, "a0.pdf", "y", "U"), ("B", 0, "b0.pdf", "z", "U")]
    man = spark.createDataFrame(rows, MAN_SCHEMA)
    inv = man.select("landing_path")
    log = reconcile.run_log_lines(reconcile.fetch_status(man, inv), dt.datetime(2021, 8, 4, 9, 0))
    out = tmp_path / "log"
    reconcile.write_run_log(log, str(out))
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    lines = [ln for p in parts for ln in (out / p).read_text().splitlines()]
    assert lines == ["A 1", "a0.pdf , OK , U", "B 2", "b0.pdf , OK , U", "b1.pdf , OK , U"]
