"""Reconcile the manifest with the files that landed: status per document, summary, log.

The original job fetched every document in one sequential loop and printed ``OK`` or
``FILE NOT FOUND`` per file. The transport stays outside Spark; what Spark does is the
bookkeeping: list what landed (``sources.inventory``), match it to the manifest, count
outcomes and render the log lines, all as joins and aggregations.
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LOG_NOT_FOUND, LOG_OK, RUN_STAMP_FORMAT
from ..functions.text import plus
from .manifest import department_key
from .numbering import write_stage


def _match_key(on: str):
    """``on`` as text; a row without it gets a key of its own that no landed file has, so such
    rows neither match nor meet in one partition."""
    return F.coalesce(F.concat(F.lit("="), F.col(on).cast("string")),
                      F.concat(F.lit("?"), F.xxhash64("DepartmentName", "record_num").cast("string")))


def fetch_status(manifest: DataFrame, landed: DataFrame, on: str = "landing_path") -> DataFrame:
    """Every manifest row with ``status`` OK (its ``on`` is among the landed ones) or FILE NOT
    FOUND. ``landed`` is a landed-file inventory (``on`` = ``landing_path``, relative to the
    landing root) or a table of fetch results with another column of the manifest; it may repeat
    keys, and a row of the manifest without a landing path is never OK.

    Both sides grow with the data: one left join on the key (Spark or AQE switch to a broadcast
    only from measured sizes).
    """
    keys = (landed.select(F.concat(F.lit("="), F.col(on).cast("string")).alias("_key"))
            .where(F.col("_key").isNotNull()).distinct().withColumn("_landed", F.lit(True)))
    ok = F.col("_landed").isNotNull() & F.col("landing_path").isNotNull()
    return (manifest.withColumn("_key", _match_key(on)).join(keys, "_key", "left")
            .withColumn("status", F.when(ok, F.lit(LOG_OK)).otherwise(F.lit(LOG_NOT_FOUND)))
            .drop("_key", "_landed"))


def written_manifest(manifest: DataFrame) -> DataFrame:
    """``manifest`` as a written table with a filter that every row meets (record numbers are never
    missing): a scan that Spark builds a Bloom filter of in a join."""
    return write_stage(manifest, "manifest-keys").where(F.col("record_num") >= 0)


def fetch_status_reduced(manifest: DataFrame, landed: DataFrame, on: str = "landing_path",
                         larger_than: str = "10GB") -> DataFrame:
    """``fetch_status`` for a table of fetch results far larger than the manifest, such as those of all
    runs: a Bloom filter of the manifest's keys drops most of its rows in the scan, before they are
    counted once and shuffled. The filter may let a row through that no document has, which the join
    then leaves out, and loses none.

    Spark plans the filter where the results' files have more bytes than ``larger_than`` and the
    manifest's key columns at most ``CREATION_BYTES``, unless the join needs no exchange. It does so
    when the query runs, so the result is written before the session's settings are put back.
    """
    spark = manifest.sparkSession
    rows = written_manifest(manifest)
    with settings(spark, {f"{_BLOOM}.enabled": "true", f"{_BLOOM}.applicationSideScanSizeThreshold": larger_than,
                          f"{_BLOOM}.creationSideThreshold": CREATION_BYTES}):
        return write_stage(fetch_status(rows, landed, on), "status")


_BLOOM = "spark.sql.optimizer.runtime.bloomFilter"
CREATION_BYTES = "256MB"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def missing_files(manifest: DataFrame, landed: DataFrame, on: str = "landing_path") -> DataFrame:
    """Manifest rows with no landed file (left anti join)."""
    keys = landed.select(F.concat(F.lit("="), F.col(on).cast("string")).alias("_key"))
    keyed = manifest.withColumn("_key", F.when(F.col("landing_path").isNotNull(), _match_key(on)).otherwise(
        F.concat(F.lit("?"), F.xxhash64("DepartmentName", "record_num").cast("string"))))
    return keyed.join(keys, "_key", "left_anti").drop("_key")


def fetch_summary(status: DataFrame) -> DataFrame:
    """Outcome counts per department."""
    return status.groupBy("DepartmentName", "status").agg(F.count(F.lit(1)).alias("documents"))


def landed_departments(manifest: DataFrame, departments: DataFrame, landed: DataFrame,
                       others: DataFrame) -> DataFrame:
    """Per department of ``departments``: its manifest rows, how many of its folders hold a landed
    file and the bytes of those, and how many hold one of ``others``. ``landed`` and ``others`` are
    listings of a tree with a folder per department key and, in it, one per landing folder."""
    def folders(files: DataFrame) -> DataFrame:
        part = lambda name: F.regexp_extract("landing_path", f"(?:^|/){name}=([^/]+)/", 1)
        return files.groupBy(part("department_key").alias("department_key"), part("folder_num").alias("_folder")) \
            .agg(F.sum("length").alias("_bytes"))

    rows = manifest.groupBy("DepartmentName").agg(F.count(F.lit(1)).alias("documents"))
    found = folders(landed).groupBy("department_key").agg(
        F.count(F.lit(1)).alias("landed_folders"), F.sum("_bytes").alias("landed_bytes"))
    rest = folders(others).groupBy("department_key").agg(F.count(F.lit(1)).alias("other_folders"))
    joined = (departments.join(rows, "DepartmentName", "left")
              .withColumn("department_key", department_key(F.col("DepartmentName")))
              .join(found, "department_key", "left").join(rest, "department_key", "left"))
    counts = ("documents", "landed_folders", "landed_bytes", "other_folders")
    return joined.select("DepartmentName", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])


def run_stamp(run_time: _dt.datetime):
    """Log file stamp: day-month-year, 24h hour and AM/PM (e.g. ``03-12-26 21PM``)."""
    return F.date_format(F.lit(run_time.isoformat(sep=" ")).cast("timestamp_ntz"), RUN_STAMP_FORMAT)


def run_log_lines(status: DataFrame, run_time: _dt.datetime) -> DataFrame:
    """The run log as rows: a header ``"{dept} {count}"`` per department (``record_num`` -1) and
    one line per document. ``status`` is read twice, for the lines and for the counts: pass a
    written table (``numbering.write_stage``), not a long plan. Nothing is collected."""
    umr = F.coalesce(F.col("UniqueMarketRef"), F.lit(""))
    fname = F.coalesce(F.col("filename"), F.lit(""))
    doc_line = (F.when(F.col("status") == LOG_OK, F.concat(fname, F.lit(" , OK , "), umr))
                .otherwise(F.concat(fname, F.lit(" , FILE NOT FOUND  , "), umr)))
    docs = status.select("DepartmentName", F.col("record_num").cast("long"), doc_line.alias("line"))
    headers = (status.groupBy("DepartmentName").agg(F.count(F.lit(1)).alias("_n"))
               .select("DepartmentName", F.lit(-1).cast("long").alias("record_num"),
                       plus(F.col("DepartmentName"), " ", F.col("_n").cast("string")).alias("line")))
    return docs.unionByName(headers).withColumn(
        "log_file", log_file_name(run_time))


def log_file_name(run_time: _dt.datetime):
    """Name of the run's log: a blank, the run stamp, ``.txt`` (the original name begins with a blank)."""
    return F.concat(F.lit(" "), run_stamp(run_time), F.lit(".txt"))


def write_run_log(log: DataFrame, path: str) -> None:
    """Write the log as text, one line per row, ordered by department then record (header
    first). The global sort is range-partitioned, so many tasks write consecutive part files
    whose concatenation in name order is the whole log; no single task holds it."""
    (log.orderBy(F.col("DepartmentName").asc_nulls_first(), F.col("record_num").asc())
     .select("line").write.mode("overwrite").text(path))
