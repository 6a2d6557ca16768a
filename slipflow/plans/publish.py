"""Runs published by one pointer: readers see a whole run or the one before it, never a part.

A run writes all its outputs below a folder of its own, ``runs/{run_id}``, and only when the last
one is there a small file, ``CURRENT``, is made to name it: written beside and renamed over the old
one, which the file system does in one step. A run that dies between two writes leaves a folder that
no pointer names; the last published run stays as it is. Starting the run again under the same id
writes the folder anew. A published run's folder is never written again but by ``amend_departments``,
which replaces whole departments of a manifest in a new run.

Everything goes through Hadoop's file systems, so the base folder may be in any store that Spark
reaches. Renaming is a single step on HDFS and local disks; a store that renames by copying gets the
pointer as one small object, which is replaced as a whole as well.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"
_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def run_folder(base: str, run_id: str) -> str:
    if not _ID.fullmatch(run_id):
        raise ValueError(f"{run_id!r} cannot name a run")
    return f"{base.rstrip('/')}/runs/{run_id}"


def current(spark: SparkSession, base: str) -> str | None:
    """Id of the published run below ``base``, None before the first one."""
    jvm, pointer, files = _files(spark, f"{base.rstrip('/')}/{POINTER}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text.strip()


def publish(spark: SparkSession, base: str, run_id: str, outputs: list[str]) -> None:
    """Make ``run_id`` the current run. Every one of ``outputs`` must be complete (Spark's success
    mark) below its folder; otherwise nothing changes."""
    folder, base = run_folder(base, run_id), base.rstrip("/")
    for name in outputs:
        _, mark, files = _files(spark, f"{folder}/{name}/_SUCCESS")
        if not files.exists(mark):
            raise ValueError(f"output {name!r} of run {run_id!r} is not complete")
    jvm, pointer, files = _files(spark, f"{base}/{POINTER}")
    beside = jvm.org.apache.hadoop.fs.Path(f"{base}/.{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(f"{run_id}\n", "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    overwrite = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = overwrite
    context.rename(context.makeQualified(beside), context.makeQualified(pointer), options)


def read_current(spark: SparkSession, base: str, name: str) -> DataFrame:
    """An output of the published run."""
    run_id = current(spark, base)
    if run_id is None:
        raise ValueError(f"no run is published below {base!r}")
    return spark.read.parquet(f"{run_folder(base, run_id)}/{name}")


def run_and_publish(spark: SparkSession, base: str, run_id: str, write: Callable[[str], list[str]]) -> str:
    """Call ``write`` with the run's folder; it writes the outputs and returns their names. Then the
    run is published. A run that is published already is not written again."""
    if current(spark, base) == run_id:
        raise ValueError(f"run {run_id!r} is published; a new run needs a new id")
    folder = run_folder(base, run_id)
    publish(spark, base, run_id, write(folder))
    return folder


def write_departments(manifest: DataFrame, path: str, rows_per_file: int = 1_000_000, *, only: bool = False) -> None:
    """Write a manifest in its sink layout (``manifest.sink_layout``), partitioned by the department's
    key, at most ``rows_per_file`` rows a file. With ``only`` just the departments of ``manifest`` are
    replaced (dynamic partition overwrite) and the others stay."""
    (manifest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only else "static")
     .option("maxRecordsPerFile", rows_per_file).partitionBy("department_key").parquet(path))


def amend_departments(spark: SparkSession, base: str, run_id: str, amended: DataFrame, name: str = "manifest",
                      rows_per_file: int = 1_000_000) -> str:
    """Publish a new run whose manifest is the current one with the departments of ``amended`` (in sink
    layout) replaced. The other outputs of the current run are not carried over; readers of them keep
    the run they began with."""
    def write(folder: str) -> list[str]:
        path = f"{folder}/{name}"
        before = read_current(spark, base, name)
        columns = [F.col(c).cast(amended.schema[c].dataType).alias(c) for c in amended.columns]
        write_departments(before.select(*columns), path, rows_per_file)
        write_departments(amended, path, rows_per_file, only=True)
        return [name]
    return run_and_publish(spark, base, run_id, write)
