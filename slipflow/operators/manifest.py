"""Batch manifest: creation order, per-department numbering, fixed-size folders, counts.

The original driver sorted the selection by creation date and walked each department with a
Python loop, numbering documents 0.. and putting every ``folder_size`` of them into one folder.
Here that is one distributed numbering (``number_rows``) partitioned by department, with no
loop over departments and nothing collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_token, plus
from .numbering import number_rows
from .priority import TIE_BREAK

MANIFEST_COLUMNS = ["DepartmentName", "record_num", "folder_num", "folder_name", "filename",
                    "landing_path", "DocumentFileURL", "UniqueMarketRef", "DocumentID", "reason"]


def creation_order_keys(columns: list[str]) -> list[Column]:
    """Creation date ascending with missing dates last, document id, then the tie-break columns
    that the rows have."""
    return [F.col("CreateDate").asc_nulls_last(), F.col("DocumentID").asc(),
            *[F.col(c).asc_nulls_first() for c in TIE_BREAK if c in columns]]


def creation_order(selected: DataFrame, *, strategy: str = "auto", max_rows: int | None = None) -> DataFrame:
    """Every selected document with its 0-based position in creation order (one global index,
    computed without moving all rows into one partition). ``max_rows``: a proven bound on the
    selection's size (``priority.registry_row_bound``), if known."""
    return number_rows(selected, [], creation_order_keys(selected.columns), "position", start=0, strategy=strategy,
                       max_rows=max_rows)


def first_documents(selected: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` documents in creation order (top-k; Spark plans TakeOrderedAndProject)."""
    return selected.orderBy(*creation_order_keys(selected.columns)).limit(n)


def folder_number(record_num: Column, folder_size: int) -> Column:
    """``record_num // folder_size``."""
    return F.call_function("div", record_num, F.lit(folder_size)).cast("long")


def landing_file_name(doc_id: Column, root_id: Column, reference: Column, file_type: Column) -> Column:
    """``{doc}_{root}_{ref}.{type}`` from the first token of each part; NULL when a part has no
    token (the original driver stopped with an error there)."""
    return plus(first_token(doc_id.cast("string")), "_", first_token(root_id.cast("string")), "_",
                first_token(reference.cast("string")), ".", first_token(file_type))


def batch_manifest(selected: DataFrame, folder_size: int, *, strategy: str = "auto",
                   max_rows: int | None = None, **numbering) -> DataFrame:
    """Per department: ``record_num`` 0.. in creation order, ``folder_num``, the folder name
    ``" {folder_num} {dept}"``, the landing file name and path ``{folder}/{record_num} - {file}``.

    Documents without a department are not batched (the per-department loop never reached
    them). Rows whose file name cannot be built keep a NULL name and path, with the first ``reason``
    found (see rejected_rows).
    ``max_rows``: a proven bound on the selection's size (``priority.registry_row_bound``);
    ``numbering`` passes further options to ``number_rows``.
    """
    rows = selected.where(F.col("DepartmentName").isNotNull())
    numbered = number_rows(rows, ["DepartmentName"], creation_order_keys(rows.columns), "record_num", start=0,
                           strategy=strategy, max_rows=max_rows, **numbering)
    folder = folder_number(F.col("record_num"), folder_size)
    fname = landing_file_name(F.col("DocumentID"), F.col("RootObjectID"), F.col("Reference"),
                              F.col("DocumentFileType"))
    out = numbered.withColumns({"folder_num": folder, "filename": fname}).withColumn(
        "folder_name", plus(" ", F.col("folder_num").cast("string"), " ", F.col("DepartmentName")))
    out = out.withColumn("landing_path", plus(F.col("folder_name"), "/", F.col("record_num").cast("string"),
                                              " - ", F.col("filename")))
    parts = [F.col(c).isNull() for c in ("DocumentID", "RootObjectID", "Reference", "DocumentFileType")]
    reason = (F.when(parts[0] | parts[1] | parts[2] | parts[3], F.lit("file name part missing"))
              .when(F.col("filename").isNull(), F.lit("file name cannot be built"))
              .when(F.col("UniqueMarketRef").isNull(), F.lit("market reference missing")))
    return out.withColumn("reason", reason).select(*MANIFEST_COLUMNS)


def batch_orders(orders: DataFrame, folder_size: int, *, strategy: str = "auto") -> DataFrame:
    """The same numbering on orders grouped by priority (five groups: every group is huge).
    ``orders`` is a table scan, so its row count (Parquet footers) bounds every group."""
    bound = orders.count() if strategy == "auto" else None
    numbered = number_rows(orders.select("o_orderpriority", "o_orderkey", "o_orderdate"),
                           ["o_orderpriority"],
                           [F.col("o_orderdate").asc_nulls_last(), F.col("o_orderkey").asc()],
                           "record_num", start=0, strategy=strategy, max_rows=bound)
    return numbered.withColumn("folder_num", folder_number(F.col("record_num"), folder_size))


def folder_sizes(manifest: DataFrame, group: str = "DepartmentName") -> DataFrame:
    """Documents per (group, folder); never more than the folder size."""
    return manifest.groupBy(group, "folder_num").agg(F.count(F.lit(1)).alias("documents"))


def department_list(selected: DataFrame) -> DataFrame:
    """Distinct departments, sorted (missing department kept once, first)."""
    return selected.select("DepartmentName").distinct().orderBy(F.col("DepartmentName").asc_nulls_first())


def department_totals(selected: DataFrame) -> DataFrame:
    """Rows per department (the count printed at the top of each department's log)."""
    return selected.groupBy("DepartmentName").agg(F.count(F.lit(1)).alias("documents"))


def manifest_totals(selected: DataFrame) -> DataFrame:
    """Total rows, missing values included."""
    return selected.agg(F.count(F.lit(1)).alias("documents"))


def department_column_counts(selected: DataFrame) -> DataFrame:
    """Per department, the non-NULL count of every other column; rows without a department
    are left out (grouping drops missing keys)."""
    others = [c for c in selected.columns if c != "DepartmentName"]
    return (selected.where(F.col("DepartmentName").isNotNull()).groupBy("DepartmentName")
            .agg(*[F.count(F.col(c)).alias(c) for c in others]))


def rejected_rows(manifest: DataFrame) -> DataFrame:
    """Manifest rows that need a look, with the first reason found: a part of the file name is NULL
    (the original driver wrote the text ``None`` there and fetched on; here NULL stays NULL), a
    part has no token (the driver stopped there), or the market reference is missing."""
    return (manifest.where(F.col("reason").isNotNull())
            .select("DocumentID", "DepartmentName", "record_num", "reason"))


def department_key(name: Column) -> Column:
    """A folder key of a department name that is never empty and keeps every name apart."""
    return F.concat(F.lit("d"), F.hex(F.encode(name, "UTF-8")))


def sink_layout(manifest: DataFrame) -> DataFrame:
    """The manifest as its file sink wants it: clustered by department and folder range, sorted,
    with the partition key ``department_key`` beside the name. Files follow the bytes: a range
    task holds many folders of a department, or several small departments."""
    keyed = manifest.withColumn("department_key", department_key(F.col("DepartmentName")))
    return keyed.repartitionByRange("department_key", "folder_num", "record_num") \
        .sortWithinPartitions("department_key", "folder_num", "record_num")
