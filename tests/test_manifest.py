"""Folders, numbering, file names, rejected rows and counts of the batch manifest."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from slipflow.operators import manifest

SEL_SCHEMA = T.StructType([
    T.StructField("DocumentID", T.LongType()), T.StructField("RootObjectID", T.LongType()),
    T.StructField("Reference", T.StringType()), T.StructField("DocumentFileType", T.StringType()),
    T.StructField("DepartmentName", T.StringType()), T.StructField("CreateDate", T.TimestampNTZType()),
    T.StructField("DocumentFileURL", T.StringType()), T.StructField("UniqueMarketRef", T.StringType()),
])


def selected(spark, rows):
    return spark.createDataFrame(rows, SEL_SCHEMA)


def test_folder_counts(spark):
    """E4: 1, 300, 301 and 601 rows at size 300 give 1, 1, 2 and 3 folders."""
    base = dt.datetime(1999, 1, 1)
    rows = []
    for dept, n in (("A", 1), ("B", 300), ("C", 301), ("D", 601)):
        rows += [(i + 1000 * ord(dept), 7, "FAC 1", "pdf", dept, base + dt.timedelta(minutes=i), "u", "m")
                 for i in range(n)]
    man = manifest.batch_manifest(selected(spark, rows), 300)
    folders = {r["DepartmentName"]: r["n"] for r in
               man.groupBy("DepartmentName").agg(F.countDistinct("folder_num").alias("n")).collect()}
    assert folders == {"A": 1, "B": 1, "C": 2, "D": 3}
    sizes = manifest.folder_sizes(man).collect()
    assert max(r["documents"] for r in sizes) <= 300
    # record_num is contiguous from 0 per department, in creation order
    for dept, n in (("C", 301), ("D", 601)):
        nums = [r["record_num"] for r in man.where(F.col("DepartmentName") == dept)
                .orderBy("record_num").collect()]
        assert nums == list(range(n))


def test_file_name_and_landing_path(spark):
    rows = [(12, 7, "FAC 12", "pdf", "Marine", dt.datetime(1999, 1, 2), "http://u", "UMR1"),
            (11, 7, " a b", "PDF", "Marine", dt.datetime(1999, 1, 1), "http://v", None),
            (13, 7, "   ", "pdf", "Marine", dt.datetime(1999, 1, 3), "http://w", "UMR3"),
            (14, 7, "x", "pdf", None, None, "http://z", "UMR4")]
    man = manifest.batch_manifest(selected(spark, rows), 300)
    got = {r["DocumentID"]: r for r in man.collect()}
    assert set(got) == {11, 12, 13}                    # no department: not batched
    assert got[11]["filename"] == "11_7_a.PDF" and got[11]["record_num"] == 0
    assert got[12]["landing_path"] == " 0 Marine/1 - 12_7_FAC.pdf"
    assert got[13]["filename"] is None and got[13]["landing_path"] is None
    rejected = {r["DocumentID"]: r["reason"] for r in manifest.rejected_rows(man).collect()}
    assert rejected == {11: "market reference missing", 13: "file name cannot be built"}
    odd = [(1, 7, None, "pdf", "", None, "u", "m"), (2, 7, "FAC\u00a0123", "pdf", "007", None, "u", "m"),
           (3, 7, "\u2003\u00a0x y", "pdf", "", None, "u", "m"), (4, 7, "\u00a0", "pdf", "", None, "u", "m")]
    got = {r["DocumentID"]: r for r in manifest.batch_manifest(selected(spark, odd), 300).collect()}
    assert (got[1]["reason"], got[4]["reason"]) == ("file name part missing", "file name cannot be built")
    assert got[2]["filename"] == "2_7_" + "FAC\u00a0123".split()[0] + ".pdf"
    assert got[3]["filename"] == "3_7_" + "\u2003\u00a0x y".split()[0] + ".pdf"
    keys = {r["k"] for r in spark.createDataFrame([("",), ("007",), ("7",), ("d",)], "n string").select(
        manifest.department_key(F.col("n")).alias("k")).collect()}
    assert len(keys) == 4 and "" not in keys


def test_creation_order_puts_missing_dates_last(spark):
    rows = [(1, 7, "r", "pdf", "A", None, "u", "m"),
            (2, 7, "r", "pdf", "A", dt.datetime(1999, 5, 1), "u", "m"),
            (3, 7, "r", "pdf", "B", dt.datetime(1999, 1, 1), "u", "m")]
    got = {r["DocumentID"]: r["position"] for r in manifest.creation_order(selected(spark, rows)).collect()}
    assert got == {3: 0, 2: 1, 1: 2}
    first = [r["DocumentID"] for r in manifest.first_documents(selected(spark, rows), 2).collect()]
    assert first == [3, 2]


def test_group_counts_drop_missing_department_and_nulls(spark):
    """D1 and Q16: NULL department dropped from per-column counts; totals count every row."""
    rows = [(1, 7, None, "pdf", "A", None, "u", "m"), (2, 7, "r", "pdf", "A", None, "u", None),
            (3, 7, "r", "pdf", None, None, "u", "m")]
    sel = selected(spark, rows)
    counts = manifest.department_column_counts(sel).collect()
    assert len(counts) == 1 and counts[0]["Reference"] == 1 and counts[0]["UniqueMarketRef"] == 1
    assert counts[0]["DocumentID"] == 2
    assert manifest.manifest_totals(sel).first()["documents"] == 3
    totals = {r["DepartmentName"]: r["documents"] for r in manifest.department_totals(sel).collect()}
    assert totals == {"A": 2, None: 1}
    assert [r["DepartmentName"] for r in manifest.department_list(sel).collect()] == [None, "A"]
