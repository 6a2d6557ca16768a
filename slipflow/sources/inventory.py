"""Landed-file inventory: which files exist under a landing root, read with Spark's
``binaryFile`` source (the ``content`` column is never selected, so file bytes are not read).

Many folders are listed by tasks, but Spark's driver then holds one file status per listed file.
So this serves one range of folders at a time (``folders``); for whole runs of many millions of
files the input of reconciliation is a table of fetch results (``reconcile.fetch_status``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_inventory(spark: SparkSession, root: str, suffix: str | None = None,
                     folders: list[str] | None = None) -> DataFrame:
    """``landing_path`` (relative to ``root``), ``path``, ``length``, ``modificationTime`` of
    every file below ``root`` (optionally only names ending in ``suffix``).

    ``folders`` (names below ``root``, e.g. the manifest's distinct folder names) lists only those
    folders; with many folders Spark lists them in parallel on the executors."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    paths = [f"{root.rstrip('/')}/{f}" for f in folders] if folders else [root]
    files = reader.load(paths).select("path", "length", "modificationTime")
    base = root.rstrip("/") + "/"
    if base.startswith("file:"):
        base = base[len("file:"):]
    pos = F.instr(F.col("path"), F.lit(base))
    rel = F.when(pos > 0, F.substring(F.col("path"), pos + F.lit(len(base)), F.lit(2 ** 31 - 1)))
    return files.select(rel.alias("landing_path"), "path", "length", "modificationTime")
