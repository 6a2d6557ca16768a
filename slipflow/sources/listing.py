"""A data source that lists landed files in tasks: ``spark.read.format("landed_files")``.

Its partitions are folders. The driver sees the names of the folders one level below the root and
nothing of the files; every task lists its folders with all below them and returns a row per file,
in Arrow batches. So a run of many millions of files costs the driver its folder names only, and a
lost executor's folders are listed again.

Options: ``path`` (the root: a local path or an address that pyarrow's file systems know, such as
``s3://``, ``hdfs://``, ``gs://``), ``suffix`` (only names that end so) and ``tasks`` (at most so
many partitions, 1000 by default). Names are taken as Spark's own file sources take them: what
begins with a dot, or with an underscore and holds no equals sign, is not listed, nor is a copy in
progress. Empty files are listed, which Spark's file sources leave out: a document whose fetch gave
no bytes has landed all the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "landing_path string, path string, length bigint, modificationTime timestamp"
ROWS_PER_BATCH = 10_000


def is_listed(name: str) -> bool:
    """Whether Spark's file sources see a file or folder of this name."""
    hidden = name.startswith(".") or (name.startswith("_") and "=" not in name)
    return not hidden and not name.endswith("._COPYING_")


def _resolve(root: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path in it, what stands before that path in Spark's addresses)."""
    if "://" not in root and not root.startswith("file:"):
        return fs.LocalFileSystem(), root.rstrip("/") or "/", "file:"
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].strip("/"), "file:"
    files, path = fs.FileSystem.from_uri(root)
    path = path.rstrip("/")
    before = root.rstrip("/")
    return files, path, before[:-len(path)] if path and before.endswith(path) else before + "/"


@dataclass
class Folders(InputPartition):
    """Folders below the root; ``deep`` is false for the root itself, whose own files alone count."""

    names: list[str]
    deep: bool = True


class LandedReader(DataSourceReader):
    def __init__(self, root: str, suffix: str, tasks: int):
        self.root, self.suffix, self.tasks = root, suffix, max(1, tasks)

    def partitions(self) -> list[InputPartition]:
        files, path, _ = _resolve(self.root)
        names = sorted(x.base_name for x in files.get_file_info(fs.FileSelector(path))
                       if x.type == fs.FileType.Directory and is_listed(x.base_name))
        dealt = min(self.tasks, len(names))
        return [Folders([""], deep=False)] + [Folders(names[k::dealt]) for k in range(dealt)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        files, path, before = _resolve(self.root)
        schema = pa.schema([("landing_path", pa.string()), ("path", pa.string()), ("length", pa.int64()),
                            ("modificationTime", pa.timestamp("us", tz="UTC"))])
        rows: list[tuple] = []
        todo = [f"{path.rstrip('/')}/{n}" if n else path for n in partition.names]
        while todo:
            for x in files.get_file_info(fs.FileSelector(todo.pop())):
                if not is_listed(x.base_name):
                    continue
                if x.type == fs.FileType.Directory:
                    if partition.deep:
                        todo.append(x.path)
                elif x.type == fs.FileType.File and x.base_name.endswith(self.suffix):
                    # whole milliseconds, as Spark's file status has them
                    at = None if x.mtime_ns is None else x.mtime_ns // 1_000_000 * 1_000
                    rows.append((x.path[len(path.rstrip("/")) + 1:], before + x.path, x.size, at))
                    if len(rows) >= ROWS_PER_BATCH:
                        yield _batch(rows, schema)
                        rows = []
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class LandedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandedReader:
        if "path" not in self.options:
            raise ValueError("landed_files needs the root as its path")
        return LandedReader(self.options["path"], self.options.get("suffix", ""), int(self.options.get("tasks", 1000)))


def list_landed(spark: SparkSession, root: str, suffix: str | None = None, tasks: int = 1000) -> DataFrame:
    """``landing_path`` (relative to ``root``), ``path``, ``length``, ``modificationTime`` of every
    file below ``root``, listed in tasks; the rows of ``inventory.landed_inventory`` and, beside
    them, the empty files."""
    spark.dataSource.register(LandedFiles)
    reader = spark.read.format("landed_files").option("tasks", tasks)
    if suffix:
        reader = reader.option("suffix", suffix)
    return reader.load(root)
